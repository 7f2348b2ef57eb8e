"""Published models: what is loaded scores like what was fitted."""

import pytest
from pyspark.sql import functions as F

from riskweft.plans import experiments as ex, models as md, production as pd_, published as pub
from riskweft.session import stage, staging_path
from riskweft.operators import splitting as sp
from riskweft.sources.contract import FEATURES
from riskweft.streaming import monitor as st

GROUPS = ("round1",)


@pytest.fixture(scope="module")
def panel(spark):
    def h(i, n):
        return F.pmod(F.xxhash64("id", F.lit(i)), F.lit(n))

    cols = [(h(i, 3) + 1).cast("int").alias(c) if c in ("X2", "X3", "X4") else (h(i, 1000) / 10).cast("double").alias(c) for i, c in enumerate(FEATURES)]
    df = spark.range(300).select(F.col("id").alias("row_id"), *cols)
    return stage(sp.stratified_split(df.withColumn("Y", F.expr("int(X1 + X12 / 2 > 100)"))))


def scorer(panel, spec, native=False):
    builder = ex.a3_builder(groups=GROUPS)
    if native:
        built = stage(ex.part(builder(panel), "train"))
        columns, categorical = md.raw_and_native([c for c in built.columns if c not in ex.KEEP])
        return pd_.Scorer(None, md.fit(spec, built, columns, categorical=categorical), 0.4, ex.a3_builder(groups=GROUPS, carry=("row_id",)))
    prep, data = ex.prepared_splits(panel, builder)
    return pd_.Scorer(prep, md.fit(spec, ex.part(data, "train"), prep.output_columns), 0.4, ex.a3_builder(groups=GROUPS, carry=("row_id",)))


SPECS = {
    "linear": (md.ModelSpec("logistic_regression", "balanced", {"max_iter": 10}, "balanced"), False),
    "boosted": (md.ModelSpec("xgboost", params={"n_estimators": 4}, weighting=2.0), False),
    "native": (md.ModelSpec("catboost", params={"iterations": 4, "depth": 3}), True),
    "prior": (md.ModelSpec(md.DUMMY), False),
}


@pytest.mark.parametrize("name", list(SPECS))
def test_loaded_scores_equal_fitted_ones(spark, panel, name):
    fitted, folder, records = scorer(panel, *SPECS[name]), staging_path(spark, "model"), panel.drop("Y", "split")
    pub.publish(spark, folder, fitted, records, GROUPS)
    loaded = pub.load(spark, folder)
    want = {r["row_id"]: tuple(r) for r in fitted.predict(records).collect()}
    assert {r["row_id"]: tuple(r) for r in loaded.predict(records).collect()} == want and len(want) == 300
    assert loaded.scorer.model.spec == fitted.model.spec and loaded.scorer.threshold == 0.4


def test_unfinished_and_changed_folders_are_refused(spark, panel, monkeypatch):
    fitted, folder, records = scorer(panel, *SPECS["boosted"]), staging_path(spark, "model"), panel.drop("Y", "split")
    with pytest.raises(RuntimeError, match="no finished model"):
        pub.load(spark, folder)
    with monkeypatch.context() as patch:
        # The write dies before the marker.
        patch.setattr(pub, "MARKER", "not a schema")
        with pytest.raises(Exception):
            pub.publish(spark, folder, fitted, records, GROUPS)
    with pytest.raises(RuntimeError, match="no finished model"):
        pub.load(spark, folder)
    pub.publish(spark, folder, fitted, records, GROUPS)
    with pytest.raises(FileExistsError):
        pub.publish(spark, folder, fitted, records, GROUPS)
    spark.createDataFrame([("x", 0, 1.0)], pub.TABLES["borders"]).write.mode("append").parquet(f"{folder}/borders")
    with pytest.raises(RuntimeError, match="borders"):
        pub.load(spark, folder)


def test_other_columns_are_refused_and_streams_score_alike(spark, panel):
    fitted, folder, records = scorer(panel, *SPECS["boosted"]), staging_path(spark, "model"), panel.drop("Y", "split")
    pub.publish(spark, folder, fitted, records, GROUPS)
    loaded = pub.load(spark, folder)
    other = pub.Published(pd_.Scorer(loaded.scorer.prep, loaded.scorer.model, 0.4, ex.a3_builder(groups=("round1", "bill"), carry=("row_id",))), loaded.column_hash)
    with pytest.raises(ValueError, match="differ"):
        other.predict(records)
    path, out = staging_path(spark, "in"), staging_path(spark, "out")
    records.write.parquet(path)
    loaded.predict_stream(st.read_stream(spark, path, records.schema), out, staging_path(spark, "cp")).awaitTermination()
    assert spark.read.parquet(out).exceptAll(fitted.predict(records)).isEmpty() and spark.read.parquet(out).count() == 300
