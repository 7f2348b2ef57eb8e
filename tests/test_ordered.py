import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweft.operators import ordered as od


@pytest.fixture()
def small_ranges(monkeypatch):
    monkeypatch.setattr(od, "ROWS_PER_RANGE", 7)


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(3)
    data = {"a": np.round(rng.lognormal(0, 3, 400), 1), "b": rng.integers(0, 9, 300).astype(float), "c": np.array([5.0])}
    rows = [(g, float(v)) for g, vs in data.items() for v in vs] + [("a", None)]
    return data, spark.createDataFrame(rows, "g string, v double")


def test_quantiles_match_numpy(spark, values, small_ranges):
    data, df = values
    probs = {"q0": 0.0, "q1": 0.1, "q5": 0.5, "q9": 0.93, "q10": 1.0}
    for r in od.exact_quantiles(df, ["g"], "v", probs).collect():
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(data[r["g"]], p), rel=1e-12)


def test_ungrouped_quantiles(spark, values, small_ranges):
    data, df = values
    row = od.exact_quantiles(df, [], "v", {"m": 0.5}).first()
    assert row["m"] == pytest.approx(np.median(np.concatenate(list(data.values()))))


def test_running_totals_do_not_depend_on_ranges(spark, values, monkeypatch):
    _, df = values
    folded = od.fold_values(df.where("v is not null"), ["g"], "v", {"n": F.lit(1)})
    results = []
    for size in (3, 50, 10**6):
        out = od.running_totals(od.in_ranges(folded, ["g"], "v", size), ["g"], ["v"], ["n"], F.col("_range"))
        results.append(sorted((r["g"], r["v"], r["cum_n"]) for r in out.collect()))
    assert results[0] == results[1] == results[2]


def test_ranges_cut_groups(spark, values):
    _, df = values
    folded = od.fold_values(df.where("v is not null"), ["g"], "v", {"n": F.lit(1)})
    ranged = od.in_ranges(folded, ["g"], "v", 10).withColumnRenamed("_range", "r")
    sizes = {(r["g"], r["r"]): r["count"] for r in ranged.groupBy("g", "r").count().collect()}
    assert len([k for k in sizes if k[0] == "a"]) > 5 and max(sizes.values()) <= 40


def test_average_ranks_and_hot_keys(spark, small_ranges):
    rows = [(i, 1.0 if i % 3 == 0 else float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, v double")
    ranks = od.average_ranks(df, [], "v")
    joined = od.attach_by_value(df, ranks, ["v"], "rows", hot_share=0.1).orderBy("id").collect()
    import pandas as pd

    expected = pd.Series([v for _, v in rows]).rank().tolist()
    assert [r["avg_rank"] for r in joined] == expected
