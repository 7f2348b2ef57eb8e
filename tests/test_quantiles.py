"""Quantiles by bracketing beside numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweft.operators import quantiles as qu
from riskweft.session import stage

PROBS = {"q0": 0.0, "q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q999": 0.999, "q1": 1.0}


@pytest.fixture(scope="module")
def numbers(spark):
    r = np.random.default_rng(1)
    n = 20_000
    columns = {
        "wide": r.normal(size=n) * 10.0 ** r.integers(-8, 9, size=n), "few": r.integers(0, 3, size=n).astype(float), "one": np.full(n, 4.25),
        "hot": np.where(r.random(n) < 0.4, 0.0, r.normal(size=n)), "holes": np.where(r.random(n) < 0.9, np.nan, r.random(n)), "none": np.full(n, np.nan),
    }
    rows = [[None if np.isnan(x) else float(x) for x in row] for row in zip(*columns.values())]
    df = stage(spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5))
    return df, {c: x[~np.isnan(x)] for c, x in columns.items()}


def check(found, columns, probs=PROBS):
    for name, values in columns.items():
        for q, p in probs.items():
            want = None if not len(values) else np.quantile(values, p)
            assert found[name][q] == want or abs(found[name][q] - want) <= 1e-12 * max(1, abs(want)), (name, q)


def test_against_numpy(numbers):
    df, columns = numbers
    check(qu.bracketed_quantiles(df, {c: F.col(c) for c in columns}, PROBS), columns)


def test_a_sketch_that_misses_widens_its_bracket(numbers):
    df, columns = numbers
    calls = []

    def wrong(table, values, shares):
        calls.append(sorted(values))
        found = qu.percentile_sketch(table, values, shares)
        # Every point is far off, so that only the whole range of a column can hold the rank.
        return {c: (n, low, high, points and [high] * len(points)) for c, (n, low, high, points) in found.items()}

    probs = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    check(qu.bracketed_quantiles(df, {c: F.col(c) for c in columns}, probs, wrong), columns, probs)
    assert len(calls) > 2 and "none" not in calls[1] and set(calls[-1]) <= set(calls[0])


def test_small_tables(spark):
    df = spark.createDataFrame([(1.0, 7), (3.0, None), (None, 9)], "a double, b int")
    found = qu.bracketed_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, {"m": 0.5, "lo": 0.1})
    assert found == {"a": {"m": 2.0, "lo": 1.2}, "b": {"m": 8.0, "lo": pytest.approx(7.2)}}
    assert qu.bracketed_quantiles(df.where("false"), {"a": F.col("a")}, {"m": 0.5}) == {"a": {"m": None}}
    assert qu.quantile_table(df.where("a > 2"), {"a": F.col("a"), "b": F.col("b")}, {"m": 0.5}).collect() == [("a", 3.0)]


def test_only_cells_inside_brackets_are_shuffled(numbers, monkeypatch):
    df, columns = numbers
    folded = []
    real = qu.fold_values
    monkeypatch.setattr(qu, "fold_values", lambda rows, *a: folded.append(rows) or real(rows, *a))
    qu.bracketed_quantiles(df, {"wide": F.col("wide")}, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    inside = folded[0].count()
    assert len(folded) == 1 and 0 < inside < 3 * 3 * qu.MARGIN / qu.ACCURACY * len(columns["wide"])
    plan = real(folded[0], ["place"], "value", {"n": F.lit(1)})._jdf.queryExecution().executedPlan().toString()
    # The filter on brackets comes before the only exchange, and nothing is unpivoted.
    assert plan.count("Exchange") == 1 and "Expand" not in plan and plan.index("Exchange") < plan.index("Generate")
