"""Order statistics without a global sort: running totals, ranks, exact quantiles.

The pattern is the same everywhere. Equal values are folded first (partial
aggregation collapses a hot value to one row), the folded table is cut into
key ranges, the range totals - a bounded table - are summed up, and the exact
result is local running total + range offset. No task ever sees more than one
range of one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweft.functions.rowmath import quoted
from riskweft.session import stage

# A range holds about this many folded rows, so their number follows from the count.
ROWS_PER_RANGE = 500_000


def fold_values(df: DataFrame, by: Sequence[str], value: str, measures: dict[str, Column]) -> DataFrame:
    """One row per (group, distinct value) with summed measures. Stage it where several passes follow."""
    return df.groupBy(*by, value).agg(*[F.sum(c).alias(n) for n, c in measures.items()])


def in_ranges(folded: DataFrame, by: Sequence[str], value: str, rows_per_range: int | None = None) -> DataFrame:
    """Add _range: neighbouring values of a group share one, and none holds much more than rows_per_range rows.

    Spark's range partitioning draws the borders; results do not depend on them.
    The table is written, so that every later pass sees the same numbers.
    """
    ranges = max(1, -(-folded.count() // (rows_per_range or ROWS_PER_RANGE)))
    if ranges == 1:
        return folded.withColumn("_range", F.lit(0))
    return stage(folded.repartitionByRange(ranges, *by, value).withColumn("_range", F.spark_partition_id()), "ranges")


def running_totals(folded: DataFrame, by: Sequence[str], order: Sequence[str], measures: Sequence[str], range_of: Column) -> DataFrame:
    """Add cum_<measure>, the inclusive ascending running total within each group."""
    names = [c for c in folded.columns if c != "_range"]
    ranged = folded.withColumn("_range", range_of)
    keys = [*by, "_range"]
    totals = ranged.groupBy(*keys).agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, *[F.coalesce(F.sum(f"_t_{m}").over(before), F.lit(0)).alias(f"_o_{m}") for m in measures])
    local = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.select("*", *[F.sum(m).over(local).alias(f"_l_{m}") for m in measures])
    return summed.join(offsets, keys).select(*names, *[(F.col(f"_l_{m}") + F.col(f"_o_{m}")).alias(f"cum_{m}") for m in measures])


def folded_quantiles(folded: DataFrame, by: Sequence[str], value: str, count: str, probs: dict[str, float]) -> DataFrame:
    """Linear-interpolation quantiles per group from a folded (by, value, count) table.

    Also gives distinct_values, the number of folded rows of the group.
    """
    placed = running_totals(in_ranges(folded, by, value), by, [value], [count], F.col("_range"))
    sizes = folded.groupBy(*by).agg(F.sum(count).alias("_size"), F.count(F.lit(1)).alias("distinct_values"))
    if by:
        placed = placed.join(sizes, list(by))
    else:
        placed = placed.select("*", *[sizes.select(c).scalar().alias(c) for c in ("_size", "distinct_values")])
    cum, own = F.col(f"cum_{count}"), F.col(count)

    def at(rank: Column) -> Column:
        return F.max(F.when((cum - own <= rank) & (rank < cum), F.col(value).cast("double")))

    parts = []
    for name, p in probs.items():
        place = (F.col("_size") - 1) * F.lit(float(p))
        parts += [at(F.floor(place)).alias(f"_lo_{name}"), at(F.ceil(place)).alias(f"_hi_{name}")]
    wide = placed.groupBy(*by).agg(F.max("_size").alias("_size"), F.max("distinct_values").alias("distinct_values"), *parts)

    def between(name: str, p: float) -> Column:
        place = (F.col("_size") - 1) * F.lit(float(p))
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return low + (high - low) * (place - F.floor(place))

    return wide.select(*by, "distinct_values", *[between(n, p).alias(n) for n, p in probs.items()])


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Linear-interpolation quantiles of the non-null values, one row per group.

    The built-in percentile keeps every distinct value of a group in one buffer;
    here a group is spread over ranges and only the rows that hold a wanted
    rank reach the final aggregate.
    """
    folded = stage(fold_values(df.where(F.col(value).isNotNull()), by, value, {"_n": F.lit(1)}), "folded")
    return folded_quantiles(folded, by, value, "_n", probs).drop("distinct_values")


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), name: str = "feature", value: str = "value") -> DataFrame:
    """(keep..., feature, value) with every value as a double."""
    numbers = [F.col(quoted(c)).cast("double").alias(c) for c in columns]
    return df.select(*map(quoted, keep), *numbers).unpivot(list(map(quoted, keep)), list(map(quoted, columns)), name, value)


def average_ranks(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by, value, rows, avg_rank): mean rank of each distinct value, ties sharing their mean."""
    folded = stage(fold_values(df, by, value, {"_n": F.lit(1)}), "folded")
    placed = running_totals(in_ranges(folded, by, value), by, [value], ["_n"], F.col("_range"))
    return placed.select(*by, value, F.col("_n").alias("rows"), (F.col("cum__n") - (F.col("_n") - 1) / 2).alias("avg_rank"))


def attach_by_value(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], count: str, hot_share: float = 0.001) -> DataFrame:
    """Join rows to a lookup that is unique on keys, with hot keys taken out of the shuffle.

    count is the number of rows per key. Keys with more than hot_share of all
    rows - by arithmetic at most 1/hot_share of them - are joined by
    broadcast; the others, none of them large, are joined by shuffle.
    """
    total = lookup.agg(F.sum(count)).scalar()
    is_hot = F.col(count) > total * hot_share
    values = [c for c in lookup.columns if c not in keys]
    hot = lookup.where(is_hot)
    cold = lookup.where(~is_hot)
    by_broadcast = rows.join(F.broadcast(hot), list(keys))
    rest = rows.join(F.broadcast(hot.select(*keys)), list(keys), "left_anti").join(cold, list(keys))
    names = [*rows.columns, *[c for c in values if c != count]]
    return by_broadcast.select(*names).unionByName(rest.select(*names))
