"""Helpers shared by the text operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweft.session import stage

#: A word of the contracts: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Low bits of a hash that name a cell of a filter; a filter has a fixed size, whatever it is filled with.
CELL_BITS = 24

#: Bits of a hash that name a cell when rows are removed; the cells are broadcast.
REMOVAL_BITS = 19

#: Parts that a running total is cut into before it is ordered; each part is a window group of its own.
PARTS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_mod(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo parts; a null key is taken as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def running_start(df: DataFrame, group: list[str], part: str, order: list[Column], value: str, out: str) -> DataFrame:
    """Sum of value over all rows of the group before this one.

    Rows stand by part and then by order. No window sees more than one part of a
    group, or one row for each part, so a group with a third of all rows is
    spread over as many tasks as it has parts.
    """
    totals = df.groupBy(*group, part).agg(F.sum(value).alias("__total"))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*group, part, F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(*group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return rows.join(bases, [*group, part]).withColumn(out, F.col("__base") + F.col("__inside")).drop("__base", "__inside")


def keep_others(docs: DataFrame, gone: DataFrame, doc: Column, tie: Column) -> DataFrame:
    """docs without the rows whose (doc, tie) is in gone, which has columns of these names.

    Only rows in a cell of such a key meet the exact join; the others stay where
    they are. The broadcast table has 2 ** REMOVAL_BITS rows at most. A row is
    kept in one struct, so its column names do not matter.
    """
    row = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("row")
    cell = F.shiftrightunsigned("tie", 64 - REMOVAL_BITS).alias("cell")
    rows = docs.select(row, doc.alias("doc"), tie.alias("tie")).select("*", cell)
    gone = stage(gone.select("doc", "tie").distinct(), "gone")
    cells = F.broadcast(stage(gone.select(cell).distinct(), "gone-cells"))
    near = rows.join(cells, "cell", "left_semi").join(gone, ["doc", "tie"], "left_anti")
    return rows.join(cells, "cell", "left_anti").select("row.*").unionByName(near.select("row.*"))


def cell_filter(hashes: DataFrame) -> np.ndarray:
    """Which cells the values of a one-column table of hashes fall into.

    At most one row for each cell comes to the driver. A filter that is full
    lets everything pass, so what it is used for must hold without it.
    """
    (name,) = hashes.columns
    cells = np.zeros(1 << CELL_BITS, bool)
    named = hashes.select(F.col(name).bitwiseAND((1 << CELL_BITS) - 1).cast("int").alias("cell")).distinct()
    cells[named.toArrow()["cell"].to_numpy()] = True
    return np.packbits(cells)


def passes(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes fall into a cell of the filter."""
    cell = hashes.view(np.uint64) & np.uint64((1 << CELL_BITS) - 1)
    return (packed[(cell >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (cell & np.uint64(7)).astype(np.uint8))) & np.uint8(1) > 0


def passing(batch: pa.RecordBatch, packed: np.ndarray, column: str) -> pa.RecordBatch:
    return batch.filter(pa.array(passes(packed, batch.column(column).to_numpy())))
