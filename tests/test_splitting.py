import pytest
from pyspark.sql import functions as F

from riskweft.operators import splitting as sp


def frame(spark, n=100, every=2, start=1000):
    return spark.range(start, start + n).select(F.col("id").alias("row_id"), (F.col("id") % every == 0).cast("int").alias("Y"))


def as_map(df, value):
    return {r["row_id"]: r[value] for r in df.collect()}


def test_exact_sizes_and_prevalence(spark):
    out = sp.stratified_split(frame(spark))
    got = {r["split"]: (r["rows"], r["positive_rate"]) for r in sp.summarize_splits(out, 23).collect()}
    assert {k: v[0] for k, v in got.items()} == {"train": 70, "validation": 15, "test": 15}
    assert got["train"][1] == 0.5 and all(abs(v[1] - 0.5) <= 0.05 for v in got.values())
    sp.require_disjoint(out)


def test_split_does_not_depend_on_partitions(spark):
    df = frame(spark, 2000, 5)
    a = as_map(sp.stratified_split(df.repartition(3)), "split")
    b = as_map(sp.stratified_split(df.repartition(7, "Y")), "split")
    assert a == b and a != as_map(sp.stratified_split(df, seed=7), "split")


def test_cuts_equal_plain_ranks(spark):
    df = frame(spark, 30000, 4)
    folds = as_map(sp.stratified_folds(df, 5), "fold")
    ranked = sp.rank_in_class(df, "row_id", "Y", sp.SEED).collect()
    sizes = {y: sum(r["Y"] == y for r in ranked) for y in (0, 1)}
    for y in (0, 1):
        assert sorted(r["rank"] for r in ranked if r["Y"] == y) == list(range(sizes[y]))
    for r in ranked:
        expected = sum(sizes[r["Y"]] * i // 5 <= r["rank"] for i in range(1, 5))
        assert folds[r["row_id"]] == expected


def test_fold_sizes_differ_by_one(spark):
    df = frame(spark, 103, 3)
    counts = [r["count"] for r in sp.stratified_folds(df, 3).groupBy("Y", "fold").count().where("Y = 1").collect()]
    assert max(counts) - min(counts) <= 1 and len(counts) == 3


def test_resampling(spark):
    df = frame(spark, 1000, 10)
    under = sp.resample(df, 2.0, "undersampling").groupBy("Y").count().collect()
    assert {r["Y"]: r["count"] for r in under} == {1: 100, 0: 200}
    over = sp.resample(df, 1.5, "oversampling")
    assert {r["Y"]: r["count"] for r in over.groupBy("Y").count().collect()} == {1: 600, 0: 900}
    assert sorted(map(tuple, over.collect())) == sorted(map(tuple, sp.resample(df.repartition(5), 1.5, "oversampling").collect()))
    with pytest.raises(ValueError, match="unsupported"):
        sp.resample(df, 1.0, "other")


def test_weights(spark):
    assert sp.pos_weight("balanced", 4, 2) == 2.0 and sp.pos_weight("light", 4, 2) == 1.5 and sp.pos_weight(3, 4, 2) == 3.0
    with pytest.raises(ValueError):
        sp.pos_weight("odd", 4, 2)
    grid = [r[0] for r in sp.pos_weight_grid(frame(spark, 100, 5)).collect()]
    assert grid == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]


def test_input_checks(spark):
    with pytest.raises(ValueError, match="sum to 1"):
        sp.stratified_split(frame(spark), train=0.7, validation=0.2, test=0.2)
    with pytest.raises(ValueError, match="binary"):
        sp.stratified_split(frame(spark).withColumn("Y", F.lit(1)))
    shared = frame(spark, 4).withColumn("split", F.lit("train")).unionByName(frame(spark, 2).withColumn("split", F.lit("test")))
    with pytest.raises(ValueError, match="overlap"):
        sp.require_disjoint(shared)
