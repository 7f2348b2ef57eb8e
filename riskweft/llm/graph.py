"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.session import stage


def components(edges: DataFrame) -> DataFrame:
    """edges a, b (long, no nulls) -> node, component: the smallest node that links reach. Nodes without an edge are absent.

    Each round hangs the larger neighbours of a node on its smallest one, then
    the smaller ones; it ends when nothing changes, after about the logarithm
    of the longest path. A round is written to the shared folder, and only a
    count and a checksum come to the driver.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        now = stage(small.distinct(), "edges")
        mark = _mark(now)
        if mark == seen:
            roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
        seen = mark


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
