"""Ordered target statistics: nominal columns as numbers, for trees.

A training row's number is the smoothed label mean of the rows of its category
that stand before it in the order of a portable hash of the row key, so no row
sees its own label. Rows with the same key stand at one place. A row to be scored
gets the mean over all training rows of its category; a category that training
has not seen gets the prior. Null is a category of its own.

Categories stay in a table, however many there are; the driver receives the
prior only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from riskweft.functions.rowmath import quoted
from riskweft.operators.ordered import in_ranges, running_totals
from riskweft.operators.splitting import hash_order
from riskweft.session import stage
from riskweft.sources.contract import SEED

#: Weight of the prior, in rows.
SMOOTHING = 1.0


def category(value: Column) -> Column:
    """The value as text; null and the empty text differ."""
    return F.when(value.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), value.cast("string")))


def smoothed(total: Column, count: Column, prior: float, weight: float) -> Column:
    return (total + F.lit(weight * prior)) / (count + F.lit(weight))


def _long(df: DataFrame, columns: Sequence[str], *keep: Column) -> DataFrame:
    """(keep..., place, category): one narrow row for each nominal column."""
    cells = F.array(*[category(F.col(quoted(c))) for c in columns])
    return df.select(*keep, F.posexplode(cells).alias("place", "category"))


@dataclass(frozen=True)
class TargetStatistics:
    """(place, category, total, count) of the training rows, and what an unseen category gets."""

    columns: tuple[str, ...]
    table: DataFrame
    prior: float
    weight: float = SMOOTHING

    def coded(self, column: str) -> str:
        """Name of the column that transform adds for this one; other columns keep theirs."""
        return f"_target_{self.columns.index(column)}" if column in self.columns else column

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """df and its coded columns. Spark broadcasts a small table by its own size check and shuffles a large one."""
        for i, c in enumerate(self.columns):
            known = self.table.where(F.col("place") == i).select(
                F.col("category").alias(f"_category_{i}"), smoothed(F.col("total"), F.col("count"), self.prior, self.weight).alias(f"_target_{i}")
            )
            df = df.withColumn(f"_category_{i}", category(F.col(quoted(c)))).join(known, f"_category_{i}", "left").drop(f"_category_{i}")
            df = df.withColumn(f"_target_{i}", F.coalesce(f"_target_{i}", F.lit(self.prior)))
        return df


def ordered_statistics(
    train: DataFrame, columns: Sequence[str], label: str = "Y", key: str = "row_id", seed: int = SEED, weight: float = SMOOTHING, prior: float | None = None,
) -> DataFrame:
    """(key, _target_0, _target_1, ...): the statistic of each nominal column before the row, one row per key."""
    if prior is None:
        prior = train.agg(F.avg(F.col(quoted(label)).cast("double")).alias("p")).first()["p"]
    rows = _long(train, columns, F.col(quoted(key)).alias("key"), F.col(quoted(label)).cast("bigint").alias("y"))
    folded = rows.groupBy("place", "category", "key").agg(F.sum("y").alias("total"), F.count(F.lit(1)).alias("count"))
    folded = stage(folded.withColumn("order", hash_order("key", seed)), "target-rows")
    # Ranges follow from the number of rows, so a hot category is spread over as many as it fills.
    placed = running_totals(in_ranges(folded, ["place", "category"], "order"), ["place", "category"], ["order", "key"], ["total", "count"], F.col("_range"))
    before = smoothed(F.col("cum_total") - F.col("total"), F.col("cum_count") - F.col("count"), prior, weight)
    wide = placed.select("key", "place", before.alias("value")).groupBy("key")
    return wide.agg(*[F.max(F.when(F.col("place") == i, F.col("value"))).alias(f"_target_{i}") for i in range(len(columns))])


def fit_target_statistics(
    train: DataFrame, columns: Sequence[str], label: str = "Y", key: str = "row_id", seed: int = SEED, weight: float = SMOOTHING,
) -> tuple[TargetStatistics, DataFrame]:
    """Statistics for scoring, and the training table with its nominal columns replaced by what stands before each row."""
    prior = train.agg(F.avg(F.col(quoted(label)).cast("double")).alias("p")).first()["p"]
    rows = _long(train, columns, F.col(quoted(label)).cast("bigint").alias("y"))
    table = stage(rows.groupBy("place", "category").agg(F.sum("y").alias("total"), F.count(F.lit(1)).alias("count")), "target-table")
    values = ordered_statistics(train, columns, label, key, seed, weight, prior).withColumnRenamed("key", "_key")
    joined = train.join(values, F.col(quoted(key)).eqNullSafe(F.col("_key")))
    place = {c: i for i, c in enumerate(columns)}
    coded = joined.select(*[F.col(f"_target_{place[c]}").alias(c) if c in place else F.col(quoted(c)) for c in train.columns])
    return TargetStatistics(tuple(columns), table, prior, weight), stage(coded, "target-coded")
