"""Deterministic splits, folds, resampling and class weights.

Rows are ordered by a portable hash of their key, so every result depends only
on (key, seed), never on partitioning. Cutting a stratum at given ranks needs
no ranking of the data: counts per hash bucket locate the cuts, whole buckets
are assigned by lookup, and only the few buckets that straddle a cut are ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskweft.functions.rowmath import quoted
from riskweft.sources.contract import SEED

BUCKET_DIGITS = 3  # hex digits of the hash: 4096 buckets per stratum
SPLITS = ("train", "validation", "test")


def hash_order(key: Column | str, seed: int) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def _hashed(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.withColumn("_h", hash_order(key, seed)).withColumn("_b", F.substring("_h", 1, BUCKET_DIGITS))


def _bucket_table(hashed: DataFrame, label: str) -> DataFrame:
    """(label, bucket, first rank, last rank + 1, class size, rows in all): at most 2 x 4096 rows."""
    counts = hashed.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(label)
    return counts.select(
        F.col(label).alias("_label"), F.col("_b").alias("_bucket"),
        (F.sum("_n").over(order) - F.col("_n")).alias("_lo"),
        F.sum("_n").over(order).alias("_hi"),
        F.sum("_n").over(whole).alias("_class"),
    )


def class_sizes(df: DataFrame, label: str) -> tuple[int, int]:
    """(negatives, positives); refuses anything but a 0/1 label with both classes."""
    row = df.agg(
        F.count_if(F.col(label) == 0).alias("neg"),
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    if row["neg"] + row["pos"] != row["n"] or not row["neg"] or not row["pos"]:
        raise ValueError("label must be binary 0/1 with both classes present")
    return row["neg"], row["pos"]


def cut_by_hash(df: DataFrame, key: str, label: str, seed: int, uppers: Callable[[Column, Column], Sequence[Column]], piece: str) -> DataFrame:
    """Number each row by the rank interval it falls into within its class.

    uppers(label, class size) gives increasing exclusive rank bounds; a row of
    rank r gets the count of bounds <= r.
    """
    hashed = _hashed(df, key, seed)
    table = _bucket_table(hashed, label)
    bounds = uppers(F.col("_label"), F.col("_class"))
    names = [f"_u{i}" for i in range(len(bounds))]
    table = table.select("*", *[b.cast("bigint").alias(n) for b, n in zip(bounds, names)])

    def interval(rank: Column) -> Column:
        result = F.lit(0)
        for n in names:
            result = result + F.when(F.col(n) <= rank, 1).otherwise(0)
        return result

    # Proven bound for the broadcast: two classes times 4096 buckets.
    placed = hashed.join(
        F.broadcast(table.withColumn("_first", interval(F.col("_lo"))).withColumn("_last", interval(F.col("_hi") - 1))),
        (F.col(label) == F.col("_label")) & (F.col("_b") == F.col("_bucket")),
    )
    inside = placed.where("_first = _last").select(*map(quoted, df.columns), F.col("_first").alias(piece))
    within = Window.partitionBy(label, "_b").orderBy("_h", key)
    straddling = (
        placed.where("_first <> _last")
        .withColumn("_rank", F.col("_lo") + F.row_number().over(within) - 1)
        .select(*map(quoted, df.columns), interval(F.col("_rank")).alias(piece))
    )
    return inside.unionByName(straddling)


def rank_in_class(df: DataFrame, key: str, label: str, seed: int, rank: str = "rank") -> DataFrame:
    """Dense 0-based rank of every row within its class in hash order."""
    hashed = _hashed(df, key, seed)
    table = _bucket_table(hashed, label)
    within = Window.partitionBy(label, "_b").orderBy("_h", key)
    joined = hashed.join(F.broadcast(table), (F.col(label) == F.col("_label")) & (F.col("_b") == F.col("_bucket")))
    return joined.select(*map(quoted, df.columns), (F.col("_lo") + F.row_number().over(within) - 1).alias(rank))


def split_sizes(n: int, train: float = 0.70, validation: float = 0.15, test: float = 0.15) -> tuple[int, int, int]:
    if abs(train + validation + test - 1.0) > 1e-9:
        raise ValueError("train, validation and test fractions must sum to 1")
    held = validation + test
    n_train = int(n * train + 1e-9)
    rest = n - n_train
    n_test = -int(-(rest * test / held) // 1)
    return n_train, rest - n_test, n_test


def stratified_split(
    df: DataFrame, key: str = "row_id", label: str = "Y", train: float = 0.70, validation: float = 0.15, test: float = 0.15,
    seed: int = SEED, split: str = "split",
) -> DataFrame:
    """Add a split column with exact total sizes and class shares kept to within one row."""
    negatives, positives = class_sizes(df, label)
    n_train, n_validation, _ = split_sizes(negatives + positives, train, validation, test)
    n = negatives + positives
    pos_train = int(positives * n_train / n + 0.5)
    pos_validation = int(positives * n_validation / n + 0.5)
    cuts = {1: (pos_train, pos_train + pos_validation)}
    neg_train = n_train - pos_train
    cuts[0] = (neg_train, neg_train + n_validation - pos_validation)
    if min(neg_train, n_validation - pos_validation) < 0 or cuts[0][1] > negatives or cuts[1][1] > positives:
        raise ValueError("too few rows of one class for these fractions")

    def uppers(lab: Column, _size: Column) -> list[Column]:
        return [F.when(lab == 1, cuts[1][i]).otherwise(cuts[0][i]) for i in range(2)]

    pieces = cut_by_hash(df, key, label, seed, uppers, "_piece")
    names = F.array(*[F.lit(s) for s in SPLITS])
    return pieces.withColumn(split, F.get(names, F.col("_piece"))).drop("_piece")


def summarize_splits(df: DataFrame, features: int, label: str = "Y", split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(features).alias("features"), F.avg(label).alias("positive_rate")
    )


def split_overlap(df: DataFrame, key: str = "row_id", split: str = "split") -> DataFrame:
    """Keys that occur in more than one split; empty when the splits are disjoint."""
    return df.groupBy(key).agg(F.min(split).alias("first_split"), F.max(split).alias("last_split")).where(
        "first_split <> last_split"
    )


def require_disjoint(df: DataFrame, key: str = "row_id", split: str = "split") -> None:
    if not split_overlap(df, key, split).isEmpty():
        raise ValueError("splits overlap")


def stratified_folds(df: DataFrame, k: int, key: str = "row_id", label: str = "Y", seed: int = SEED, fold: str = "fold") -> DataFrame:
    """Add a fold number 0..k-1; class counts per fold differ by at most one."""
    def uppers(_lab: Column, size: Column) -> list[Column]:
        return [F.floor(size * i / k) for i in range(1, k)]

    return cut_by_hash(df, key, label, seed, uppers, fold)


def undersample(df: DataFrame, ratio: float, key: str = "row_id", label: str = "Y", seed: int = SEED) -> DataFrame:
    """All positives and round(positives * ratio) negatives, without replacement."""
    negatives, positives = class_sizes(df, label)
    wanted = min(negatives, round(positives * ratio))
    pieces = cut_by_hash(df, key, label, seed, lambda lab, size: [F.when(lab == 1, size).otherwise(F.lit(wanted))], "_piece")
    return pieces.where("_piece = 0").drop("_piece")


def draw_position(draw: Column, size: int, seed: int) -> Column:
    """Deterministic uniform position 0..size-1 for draw number i (60 bits of a portable hash)."""
    digits = F.substring(hash_order(draw, seed), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(size))


def oversample(df: DataFrame, ratio: float, key: str = "row_id", label: str = "Y", seed: int = SEED) -> DataFrame:
    """All negatives and max(positives, round(negatives / ratio)) positives drawn with replacement."""
    spark: SparkSession = df.sparkSession
    negatives, positives = class_sizes(df, label)
    wanted = max(positives, round(negatives / ratio))
    # Draws are folded to a multiplicity per position before they meet the data.
    draws = (
        spark.range(wanted).select(draw_position(F.col("id"), positives, seed).alias("_rank")).groupBy("_rank").agg(F.count(F.lit(1)).alias("_times"))
    )
    ranked = rank_in_class(df.where(F.col(label) == 1), key, label, seed, "_rank")
    copies = ranked.join(draws, "_rank").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
    return copies.select(*map(quoted, df.columns)).unionByName(df.where(F.col(label) == 0))


def resample(df: DataFrame, ratio: float, strategy: str, **kwargs) -> DataFrame:
    if strategy == "undersampling":
        return undersample(df, ratio, **kwargs)
    if strategy == "oversampling":
        return oversample(df, ratio, **kwargs)
    raise ValueError(f"unsupported sampling strategy: {strategy}")


def class_weight(label: Column, mode: str | float | None, negatives: int, positives: int) -> Column:
    """Row weight for a weighting mode: None, balanced, manual_light, or a positive weight (also 'light')."""
    if mode is None or mode == "none":
        return F.lit(1.0)
    if mode in ("balanced", "balanced_subsample", "balanced_sample_weight"):
        n = negatives + positives
        return F.when(label == 1, n / (2.0 * positives)).otherwise(n / (2.0 * negatives))
    if mode == "manual_light":
        return F.when(label == 1, 2.0).otherwise(1.0)
    return F.when(label == 1, pos_weight(mode, negatives, positives)).otherwise(1.0)


def pos_weight(mode: str | float, negatives: int, positives: int) -> float:
    if isinstance(mode, (int, float)):
        return float(mode)
    balanced = negatives / positives
    if mode in ("balanced", "scale_balanced"):
        return balanced
    if mode == "light":
        return (1.0 + balanced) / 2.0
    raise ValueError(f"unknown positive-weight strategy: {mode}")


def pos_weight_grid(df: DataFrame, label: str = "Y") -> DataFrame:
    """Distinct positive weights {1, .5r, .75r, r, 1.25r, 1.5r} with r = negatives/positives."""
    ratio = df.agg(F.try_divide(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).alias("r"))
    grid = F.array(F.lit(1.0), *[F.bround(F.col("r") * f, 6) for f in (0.5, 0.75, 1.0, 1.25, 1.5)])
    return ratio.select(F.explode(F.array_sort(F.array_distinct(grid))).alias("scale_pos_weight"))
