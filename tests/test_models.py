import pytest
from pyspark.sql import functions as F

from riskweft.operators import diagnostics as dg, features as fe, scoring as sc, splitting as sp
from riskweft.plans import experiments as ex, models as md, production as pd_
from riskweft.session import stage, staging_path
from riskweft.sources import tables as tb
from riskweft.sources.contract import FEATURES
from riskweft.streaming import monitor as st

LOGISTIC = md.ModelSpec("logistic_regression", "balanced", {"max_iter": 10}, "balanced")


@pytest.fixture(scope="module")
def panel600(spark):
    def h(i, n):
        return F.pmod(F.xxhash64("id", F.lit(i)), F.lit(n))

    cols = [
        (h(i, 3) + 1).cast("int").alias(c) if c in ("X2", "X3", "X4") else (h(i, 1000) / 10).cast("double").alias(c) for i, c in enumerate(FEATURES)
    ]
    df = spark.range(600).select(F.col("id").alias("row_id"), *cols)
    return stage(sp.stratified_split(df.withColumn("Y", F.expr("int(X1 + X12 / 2 > 100)"))))


@pytest.fixture(scope="module")
def prepared(panel600):
    prep, data = ex.prepared_splits(panel600, ex.a3_builder(groups=("round1",)))
    return prep.output_columns, stage(ex.part(data, "train").drop("split")), stage(ex.part(data, "validation").drop("split"))


def test_registry_of_models():
    assert list(md.candidate_ladder()) == ["dummy_classifier", "logistic_regression", "decision_tree", "random_forest"]
    assert len(md.variant_specs()) == 16 and len(md.param_grid("logistic_regression")) == 18
    assert md.sample_params(md.SEARCH_SPACES["xgboost"], 18) == md.sample_params(md.SEARCH_SPACES["xgboost"], 18)
    with pytest.raises(ValueError):
        md.param_grid("dummy_classifier")
    with pytest.raises(ValueError):
        md.ModelSpec("nope")
    with pytest.raises(ValueError, match="unsupported"):
        md.refit({"model": "CatBoostClassifier", "hyperparameters": {}}, None, [])


def test_logistic_learns(spark, prepared):
    columns, train, validation = prepared
    fitted = md.fit(LOGISTIC, train, columns)
    assert sc.rank_metrics(sc.fold_scores(fitted.score(validation), label="Y")).first()["roc_auc"] > 0.9


def test_oof_scores_every_row_once_and_resumes(spark, panel600):
    built = stage(ex.part(ex.a3_builder(groups=("round1",))(panel600), "train").drop("split"))
    store = tb.FoldStore(spark, staging_path(spark, "folds"))
    first = stage(ex.oof_scores(built, LOGISTIC, 3, store=store))
    assert first.count() == first.select("row_index").distinct().count() == built.count() and store.finished() == {0, 1, 2}
    again = ex.oof_scores(built, LOGISTIC, 3, store=tb.FoldStore(spark, store.path))
    assert again.exceptAll(first).isEmpty()
    with pytest.raises(AssertionError):
        ex.require_one_score(first.where("fold > 0"), built)


def test_hard_negatives_are_negatives(spark):
    df = spark.createDataFrame([(0, 0, 0.9), (1, 0, 0.2), (2, 1, 0.99), (3, 1, 0.8)], "row_index bigint, y_true int, oof_score double")
    marked = ex.with_hard_negatives(df).collect()
    assert not any(r[n] for r in marked for n in dg.HARD_SHARES if r["y_true"] == 1)
    assert [r["is_hard_negative"] for r in sorted(marked, key=lambda r: r["row_index"])] == [True, False, False, False]


def test_segments(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (3,)], "n int").select("n", *[F.expr(f"int(n > {i})").alias(f"X{6 + i}") for i in range(6)])
    got = {r["n"]: r["segment"] for r in ex.with_segment(df).collect()}
    assert got == {0: "no_delay", 1: "light_delay", 2: "light_delay", 3: "recurrent_delay"}


def test_holdout_is_scored_once(spark, panel600):
    built = stage(ex.a3_builder(groups=("round1",))(panel600))
    path = staging_path(spark, "manifest")
    tb.write_manifest(built, path)
    config = pd_.FrozenConfig(md.ModelSpec("catboost", params={"iterations": 2, "depth": 2}), "A3", 0.4)
    marker = pd_.AccessMarker(spark, staging_path(spark, "marker"))
    out = pd_.holdout_evaluation(built, tb.read_manifest(spark, path), config, config, marker)
    assert out["predictions"].count() == 90 and out["gate_status"].first()["access"] == 1
    with pytest.raises(RuntimeError, match="already"):
        marker.enter()
    assert marker.enter(allow_recovery=True) == 2
    with pytest.raises(RuntimeError, match="threshold"):
        pd_.validate_freeze(config, pd_.FrozenConfig(config.spec, "A3", 0.5))


def test_stream_scores_equal_batch(spark, panel600):
    prep, data = ex.prepared_splits(panel600, ex.a3_builder(groups=("round1",)))
    model = md.fit(LOGISTIC, ex.part(data, "train"), prep.output_columns)
    scorer = pd_.Scorer(prep, model, 0.5, lambda d: fe.behavioral_features(d, ("round1",)))
    records = panel600.drop("Y", "split")
    path, out = staging_path(spark, "in"), staging_path(spark, "out")
    records.write.parquet(path)
    scorer.predict_stream(st.read_stream(spark, path, records.schema), out, staging_path(spark, "cp")).awaitTermination()
    streamed = spark.read.parquet(out)
    assert streamed.count() == 600 and streamed.exceptAll(scorer.predict(records)).isEmpty()


def test_local_contributions_are_ranked(spark, prepared):
    columns, train, validation = prepared
    fitted = md.fit(LOGISTIC, train, columns)
    rows = pd_.local_contributions(fitted, validation, {c: 0.0 for c in columns}, 3).collect()
    by_row = {}
    for r in sorted(rows, key=lambda r: r["position"]):
        by_row.setdefault(r["row_id"], []).append(abs(r["contribution"]))
    assert all(len(v) == 3 and v == sorted(v, reverse=True) for v in by_row.values())
