"""Exact quantiles of many columns by bracketing.

A mergeable sketch gives, in one aggregate over all columns, two values around
each wanted rank. A scan counts the values below each bracket, and another folds
the values inside it; only those, a small share of the cells, are shuffled. The
wanted value stands in the folded table at the wanted rank less the count below.
A bracket that does not hold the rank is widened, in the end to the whole range
of the column, so the result never depends on how good the sketch was.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskweft.operators.ordered import fold_values, in_ranges, running_totals
from riskweft.session import stage

#: The sketch is off by at most 1 / ACCURACY of the ranks; a bracket reaches MARGIN times as far to both sides.
ACCURACY = 2000
MARGIN = 2.0
#: Factor by which a bracket that missed grows.
WIDER = 16.0

Sketch = Callable[[DataFrame, dict[str, Column], dict[str, list[float]]], dict[str, tuple[int, float, float, list[float]]]]


def percentile_sketch(df: DataFrame, values: dict[str, Column], shares: dict[str, list[float]]) -> dict[str, tuple[int, float, float, list[float]]]:
    """(rows, least, greatest, value near each share) of each column, without nulls: one row of aggregates."""
    cells = []
    for i, (name, x) in enumerate(values.items()):
        points = F.expr("array(" + ", ".join(f"{s!r}d" for s in shares[name]) + ")")
        cells += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"a{i}"), F.max(x).alias(f"z{i}"), F.percentile_approx(x, points, ACCURACY).alias(f"q{i}")]
    row = df.agg(*cells).first()
    return {name: (row[f"n{i}"], row[f"a{i}"], row[f"z{i}"], row[f"q{i}"]) for i, name in enumerate(values)}


def _wanted_ranks(n: int, probs: dict[str, float]) -> dict[int, float]:
    """Whole ranks that the interpolated quantiles need, each with its share."""
    ranks = {}
    for p in probs.values():
        place = (n - 1) * p
        for r in (math.floor(place), math.ceil(place)):
            ranks[r] = p
    return ranks


def _brackets(n: int, low: float, high: float, points: list[float], probs: Sequence[float], margin: float) -> list[tuple[float, float]]:
    """One bracket for each prob from the sketch's values at prob - margin and prob + margin."""
    out = []
    for i, p in enumerate(probs):
        out.append((low if p - margin <= 0 else points[2 * i], high if p + margin >= 1 else points[2 * i + 1]))
    return out


def bracketed_quantiles(df: DataFrame, values: dict[str, Column], probs: dict[str, float], sketch: Sketch = percentile_sketch) -> dict[str, dict[str, float | None]]:
    """Linear-interpolation quantiles of each column's non-null values, by name; None without values.

    values are expressions of one type of number; the driver holds a few numbers
    for each of them. Every pass reads only the columns that are still open.
    """
    cells = {name: x.cast("double") for name, x in values.items()}
    at: dict[str, dict[int, float]] = {}
    sizes: dict[str, int] = {}
    open_ = list(values)
    margin = MARGIN / ACCURACY
    order = sorted(set(probs.values()))
    while open_:
        shares = [s for p in order for s in (max(0.0, p - margin), min(1.0, p + margin))]
        facts = sketch(df, {n: cells[n] for n in open_}, {n: shares for n in open_})
        brackets: list[tuple[str, float, float]] = []
        for name in open_:
            n, low, high, points = facts[name]
            sizes[name] = n
            at.setdefault(name, {})
            if n:
                brackets += [(name, *b) for b in dict.fromkeys(_brackets(n, low, high, points, order, margin))]
        found = _inside(df, cells, brackets, {name: _wanted_ranks(sizes[name], probs) for name in open_ if sizes[name]})
        for name, ranks in found.items():
            at[name] |= ranks
        open_ = [n for n in open_ if any(r not in at[n] for r in _wanted_ranks(sizes[n], probs)) and sizes[n]]
        margin *= WIDER
    return {name: {q: _between(at[name], sizes[name], p) for q, p in probs.items()} for name in values}


def _between(ranks: dict[int, float], n: int, p: float) -> float | None:
    if not n:
        return None
    place = (n - 1) * p
    low, high = ranks[math.floor(place)], ranks[math.ceil(place)]
    return low + (high - low) * (place - math.floor(place))


def _inside(df: DataFrame, cells: dict[str, Column], brackets: list[tuple[str, float, float]], wanted: dict[str, dict[int, float]]) -> dict[str, dict[int, float]]:
    """Values at the wanted ranks that lie inside a bracket of their column."""
    if not brackets:
        return {}
    counts = [F.count_if(cells[name] < F.lit(low)).alias(f"b{i}") for i, (name, low, _) in enumerate(brackets)]
    below = df.agg(*counts).first()
    hits = F.array(*[
        F.when((cells[name] >= F.lit(low)) & (cells[name] <= F.lit(high)), F.struct(F.lit(i).alias("place"), cells[name].alias("value")))
        for i, (name, low, high) in enumerate(brackets)
    ])
    # Rows outside all brackets end here, before the shuffle.
    rows = df.select(F.explode(F.array_compact(hits)).alias("hit")).select("hit.place", "hit.value")
    folded = stage(fold_values(rows, ["place"], "value", {"n": F.lit(1)}), "brackets")
    placed = running_totals(in_ranges(folded, ["place"], "value"), ["place"], ["value"], ["n"], F.col("_range"))
    # One row for each column, bracket and wanted rank.
    asked = [(i, r, r - below[f"b{i}"]) for i, (name, _, _) in enumerate(brackets) for r in wanted[name] if r >= below[f"b{i}"]]
    if not asked:
        return {}
    ranks = df.sparkSession.createDataFrame(asked, "place int, rank bigint, inner bigint")
    hit = placed.join(F.broadcast(ranks), "place").where((F.col("cum_n") - F.col("n") <= F.col("inner")) & (F.col("inner") < F.col("cum_n")))
    out: dict[str, dict[int, float]] = {}
    for r in hit.select("place", "rank", "value").collect():
        out.setdefault(brackets[r["place"]][0], {})[r["rank"]] = r["value"]
    return out


def quantile_table(df: DataFrame, columns: dict[str, Column], probs: dict[str, float], name: str = "feature") -> DataFrame:
    """(feature, one column per quantile): one row for each column that has values."""
    found = bracketed_quantiles(df, columns, probs)
    rows = [(c, *q.values()) for c, q in found.items() if None not in q.values()]
    return df.sparkSession.createDataFrame(rows, f"{name} string, " + ", ".join(f"{q} double" for q in probs))
