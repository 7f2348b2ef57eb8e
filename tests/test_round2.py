"""Names of any kind, streams on folders, objectives, penalties by fold, stores without row reads."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweft import session as ss
from riskweft.functions.rowmath import quoted
from riskweft.operators import neighbours as nn, prep as pp, quality as q
from riskweft.plans import experiments as ex, models as md, production as pd_
from riskweft.sources.tables import FoldStore
from riskweft.streaming import monitor as st

NAMES = ["a-b", "a b", "a.b", "a'b", "a`b", "a", "b"]


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(1)
    rows = [[float(x) for x in rng.integers(0, 9, len(NAMES))] + [i % 2] for i in range(60)]
    return rows, spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ["row_id", *NAMES, "Y"])


def test_statistics_of_odd_names(odd):
    rows, df = odd
    found = {r["feature"]: r for r in q.descriptive_stats(df, NAMES).collect()}
    for i, name in enumerate(NAMES):
        values = np.array([r[i] for r in rows])
        assert found[name]["mean"] == pytest.approx(values.mean()) and found[name]["p50"] == pytest.approx(np.median(values))
    assert q.missing_table(df, NAMES).count() == 0 and q.duplicate_summary(df, NAMES).first()["duplicate_rows"] >= 0
    assert {r["feature"] for r in q.rate_by_bin(df, NAMES).collect()} == set(NAMES)
    audit = q.feature_audit(df.drop("Y"), "odd").first()
    assert audit["columns"] == len(NAMES) and audit["constant_columns"] == 0


def test_a_dot_in_a_category_can_be_fitted(spark):
    df = spark.createDataFrame([(i, 0.5 if i % 3 else 1.5, float(i), i % 2) for i in range(40)], "row_id long, k double, v double, Y int")
    df = df.withColumn("k", F.col("k").cast("string"))
    prep = pp.fit_preparation(df)
    assert "k_0.5" in prep.output_columns
    out = pp.transform(prep, df)
    fitted = md.fit(md.ModelSpec("decision_tree", params={"max_depth": 3, "min_samples_leaf": 1}), out, prep.output_columns)
    assert fitted.score(out, ["row_id"]).count() == 40


def test_many_categories_fit(spark):
    df = spark.createDataFrame([(i, f"c{i % 130}", i % 2) for i in range(520)], "row_id long, c string, Y int")
    fitted = md.fit(md.ModelSpec("catboost", params={"iterations": 1, "depth": 2}), df, ["c"], categorical=["c"])
    assert fitted.score(df, ["row_id"]).count() == 520


@pytest.mark.parametrize("parts", [1, 3])
def test_streams_read_files_and_folders(spark, tmp_path, parts):
    days = spark.range(240).select((F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).cast("timestamp_ntz").alias("ts"), F.col("id").alias("v"))
    path = f"{tmp_path}/events.parquet"
    days.repartition(parts).write.parquet(path)
    events = spark.read.parquet(path)
    make = lambda df: st.quality_stream(df, "ts", F.col("v") % 10 == 0, F.col("v") < 0, F.lit(False))
    out = f"{tmp_path}/out"
    st.drain(make(st.read_stream(spark, st.table_glob(path), events.schema)), out, f"{tmp_path}/checkpoint")
    closed = spark.read.parquet(out)
    assert closed.count() < 10
    every = st.close_windows(closed, events, make, "ts")
    assert sorted((r["period_start"], r["rows"], r["missing"]) for r in every.collect()) == sorted((r["period_start"], r["rows"], r["missing"]) for r in make(events).collect())
    assert every.count() == 10


def test_folds_are_finished_when_their_write_is(spark, tmp_path):
    store = FoldStore(spark, f"{tmp_path}/folds")
    assert store.finished() == set()
    empty = spark.createDataFrame([], FoldStore.COLUMNS)
    store.save(2, empty)
    (tmp_path / "folds" / "fold=0").mkdir()
    assert store.finished() == {2}


def test_cascade_bands_of_close_shares(spark):
    oof = spark.range(1000).select((F.col("id") / 1000).alias("oof_score"))
    low, high = ex.cascade_bands(oof, (0.28, 0.29))
    assert low[1] != high[1] and low[2] < high[2]


def test_hard_negative_baseline_goes_by_f1(spark):
    """A few certain hits have the best precision, many good ones the best F1."""
    rows = [(i, 1, 0.9) for i in range(62)] + [(100 + i, 1, 0.5) for i in range(30)] + [(200 + i, 0, 0.5) for i in range(5)] + [(300 + i, 0, 0.1) for i in range(60)]
    scores = spark.createDataFrame([("baseline", *r) for r in rows] + [("refit", *r) for r in rows], "experiment string, row_id long, label int, score double")
    first = ex.search_all(scores.where("experiment = 'baseline'"), objective="f1").first()["threshold"]
    other = ex.search_all(scores.where("experiment = 'refit'"), objective="precision").first()["threshold"]
    assert first <= 0.5 < other


def test_permutation_of_every_column(odd):
    _, df = odd
    fitted = md.fit(md.ModelSpec("logistic_regression", params={"max_iter": 5}), df, NAMES)
    found = pd_.permutation_importance(fitted, df, NAMES).collect()
    assert {r["feature"] for r in found} == set(NAMES)


def test_mixed_widths_are_refused(spark):
    df = spark.createDataFrame([(1, 0, [1.0, 2.0]), (2, 1, [1.0])], "vec_id long, label int, embedding array<double>")
    with pytest.raises(ValueError, match="between 1 and 2"):
        nn.standardize_array(df, "embedding", ("vec_id", "label"))


def test_staged_tables_can_be_dropped(spark):
    kept = ss.stage(spark.range(3))
    assert kept.count() == 3
    assert ss.drop_staged(spark) > 0
    with pytest.raises(Exception):
        spark.read.parquet(kept.inputFiles()[0]).count()


def test_quoting():
    assert quoted("a`b") == "`a``b`"
