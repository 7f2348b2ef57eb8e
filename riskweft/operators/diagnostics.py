"""Error, separability and reconciliation diagnostics."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from riskweft.operators.ordered import attach_by_value, average_ranks, long_form
from riskweft.operators.quality import moments
from riskweft.operators.quantiles import bracketed_quantiles
from riskweft.sources.contract import SEMANTIC_NAMES

CONTRASTS = (("FP_vs_TP", "FP", "TP"), ("TP_vs_FN", "TP", "FN"))
HARD_SHARES = {"top_5pct": 0.05, "top_10pct": 0.10, "top_20pct": 0.20}


def error_contrast(df: DataFrame, features: Sequence[str], outcome: str = "outcome") -> DataFrame:
    """Per contrast and feature: moments and quartiles of both sides and the standardised mean difference.

    One wide aggregate by outcome, one exact-quantile pass, then joins of
    tables with one row per (outcome, feature).
    """
    numbers = df.where(F.col(outcome) != "TN").select(outcome, *[F.col(c).cast("double").alias(c) for c in features])
    stats = moments(numbers, features, [outcome])
    parts = {(o, f): F.when(F.col(outcome) == o, F.col(f)) for o in dict.fromkeys(x for c in CONTRASTS for x in c[1:]) for f in features}
    found = bracketed_quantiles(numbers, parts, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    quartiles = df.sparkSession.createDataFrame(
        [(*key, *q.values()) for key, q in found.items()], f"`{outcome}` string, feature string, q25 double, q50 double, q75 double"
    )
    sides = stats.join(quartiles, [outcome, "feature"], "left")
    spark = df.sparkSession
    frame = spark.createDataFrame(
        [(name, left, right, f, SEMANTIC_NAMES.get(f, f)) for name, left, right in CONTRASTS for f in features],
        "comparison string, left_label string, right_label string, feature string, semantic_name string",
    )

    def side(tag: str) -> DataFrame:
        return sides.select(
            F.col(outcome).alias(f"{tag}_label"), "feature",
            *[F.col(c).alias(f"_{tag}_{c}") for c in ("count", "mean", "std", "q25", "q50", "q75")],
        )

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0))

    joined = frame.join(side("left"), ["left_label", "feature"], "left").join(side("right"), ["right_label", "feature"], "left")
    left_mean, right_mean = zero("_left_mean"), zero("_right_mean")
    left_std, right_std = F.col("_left_std"), F.col("_right_std")
    # A side with fewer than two rows has no deviation; the difference is then 0.
    pooled = F.coalesce(F.sqrt((left_std * left_std + right_std * right_std) / 2), F.lit(0.0))
    difference = right_mean - left_mean
    table = joined.select(
        "comparison", "feature", "semantic_name", "left_label", "right_label",
        F.coalesce("_left_count", F.lit(0)).alias("left_count"), F.coalesce("_right_count", F.lit(0)).alias("right_count"),
        left_mean.alias("left_mean"), right_mean.alias("right_mean"),
        F.when(F.col("right_label") == "TP", right_mean).otherwise(left_mean).alias("mean_tp"),
        F.when(F.col("left_label") == "FP", left_mean).otherwise(0.0).alias("mean_fp"),
        zero("_left_q50").alias("median_left"), zero("_right_q50").alias("median_right"),
        zero("_left_std").alias("std_left"), zero("_right_std").alias("std_right"),
        F.abs(difference).alias("absolute_mean_difference"),
        F.when(pooled > 1e-12, difference / pooled).otherwise(0.0).alias("standardized_mean_difference"),
        *[zero(f"_{s}_{q}").alias(f"{q}_{s}") for s in ("left", "right") for q in ("q25", "q50", "q75")],
    )
    return table.orderBy("comparison", F.desc(F.abs("standardized_mean_difference")), "feature")


def predictions_wide(df: DataFrame, models: Sequence[str], key: str = "row_id", label: str = "label", value: str = "predicted") -> DataFrame:
    """(key, label, one column per model) from a long table with one row per key and model."""
    cells = [F.max(F.when(F.col("model") == m, F.col(value))).alias(m) for m in models]
    return df.groupBy(key).agg(F.max(label).alias(label), *cells)


OVERLAP = ("shared_fp", "exclusive_fp_a", "exclusive_fp_b", "shared_fn", "exclusive_fn_a", "exclusive_fn_b")


def error_overlap(wide: DataFrame, models: Sequence[str], label: str = "label") -> DataFrame:
    """Shared and exclusive errors of each model pair, all pairs in one aggregate."""
    truth = F.col(label) == 1
    cells = []
    for a, b in combinations(models, 2):
        hit_a, hit_b = F.col(a) == 1, F.col(b) == 1
        fp_a, fp_b, fn_a, fn_b = ~truth & hit_a, ~truth & hit_b, truth & ~hit_a, truth & ~hit_b
        counts = (fp_a & fp_b, fp_a & ~fp_b, fp_b & ~fp_a, fn_a & fn_b, fn_a & ~fn_b, fn_b & ~fn_a)
        cells.append(F.struct(
            F.lit(a).alias("model_a"), F.lit(b).alias("model_b"), *[F.count_if(c).alias(n) for n, c in zip(OVERLAP, counts)]
        ))
    return wide.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def score_correlation(scores: DataFrame, models: Sequence[str], key: str = "row_id", label: str = "label") -> DataFrame:
    """Pearson and Spearman correlation of each model pair from a long score table."""
    ranks = average_ranks(scores, ["model"], "score")
    ranked = attach_by_value(scores.select(key, label, "model", "score"), ranks, ["model", "score"], "rows")
    cells = [F.max(F.when(F.col("model") == m, F.col(v))).alias(f"{v}_{m}") for m in models for v in ("score", "avg_rank")]
    wide = ranked.groupBy(key).agg(*cells)
    pairs = [
        F.struct(
            F.lit(a).alias("model_a"), F.lit(b).alias("model_b"),
            F.corr(f"score_{a}", f"score_{b}").alias("pearson"), F.corr(f"avg_rank_{a}", f"avg_rank_{b}").alias("spearman"),
        )
        for a, b in combinations(models, 2)
    ]
    return wide.agg(F.array(*pairs).alias("cells")).select(F.inline("cells"))


def is_diverse(correlation: DataFrame, overlap: DataFrame, max_correlation: float = 0.995, min_exclusive: int = 50) -> DataFrame:
    """One row (mean_pearson, largest_exclusive, diverse)."""
    largest = overlap.agg(F.max(F.greatest(*[c for c in OVERLAP if c.startswith("exclusive")]))).scalar()
    mean = F.col("mean_pearson")
    return correlation.agg(F.avg("pearson").alias("mean_pearson")).select(
        mean, largest.alias("largest_exclusive"), ((mean < max_correlation) | (largest > min_exclusive)).alias("diverse")
    )


def duplicate_groups(df: DataFrame, features: Sequence[str], label: str = "Y") -> DataFrame:
    """Groups of equal feature rows with more than one member, and those with both labels."""
    groups = df.groupBy(*features).agg(F.count(F.lit(1)).alias("n"), F.min(label).alias("lo"), F.max(label).alias("hi"))
    return groups.agg(
        F.count_if(F.col("n") > 1).alias("exact_duplicate_feature_groups"),
        F.count_if((F.col("n") > 1) & (F.col("lo") != F.col("hi"))).alias("conflicting_label_duplicate_groups"),
    )


PERCENTILES = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}


def score_overlap(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Class percentiles and how far each class reaches past the other's median; one row."""
    found = bracketed_quantiles(df, {name: F.when(F.col(label) == c, F.col(score)) for c, name in ((0, "negative"), (1, "positive"))}, PERCENTILES)
    cells = {f"{name}_{p}": v for name, q in found.items() for p, v in q.items()}
    wide = df.sparkSession.createDataFrame([tuple(cells.values())], ", ".join(f"{c} double" for c in cells))
    negative, positive = F.col(label) == 0, F.col(label) == 1
    high, low = wide.select("positive_p50").scalar(), wide.select("negative_p50").scalar()
    shares = df.agg(
        F.try_divide(F.count_if(negative & (F.col(score) >= high)), F.count_if(negative)).alias("negative_above_positive_median"),
        F.try_divide(F.count_if(positive & (F.col(score) <= low)), F.count_if(positive)).alias("positive_below_negative_median"),
    )
    return wide.select("*", *[shares.select(c).scalar().alias(c) for c in shares.columns])


def hard_negative_cutoffs(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row: the exact upper quantiles of the negative scores, one column per definition."""
    found = bracketed_quantiles(df, {score: F.when(F.col(label) == 0, F.col(score))}, {n: 1.0 - q for n, q in HARD_SHARES.items()})[score]
    return df.sparkSession.createDataFrame([tuple(found.values())], ", ".join(f"{n} double" for n in found))


def hard_negative_masks(df: DataFrame, label: str = "label", score: str = "score", cutoffs: DataFrame | None = None) -> DataFrame:
    """Add one boolean column per definition; positives are never marked."""
    cutoffs = hard_negative_cutoffs(df, label, score) if cutoffs is None else cutoffs
    return df.select("*", *[
        ((F.col(label) == 0) & (F.col(score) >= cutoffs.select(n).scalar())).alias(n) for n in HARD_SHARES
    ])


def hard_negative_analysis(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(definition, score_cutoff, hard_negative_count, negative_percentage, mean_score, median_score)."""
    marked = hard_negative_masks(df, label, score).where(F.col(label) == 0)
    names = F.array_compact(F.array(*[F.when(F.col(n), F.lit(n)) for n in HARD_SHARES]))
    members = marked.select(F.explode(names).alias("definition"), F.col(score).alias("score"))
    negatives = df.agg(F.count_if(F.col(label) == 0)).scalar()
    stats = members.groupBy("definition").agg(
        F.min("score").alias("score_cutoff"), F.count(F.lit(1)).alias("hard_negative_count"), F.avg("score").alias("mean_score")
    )
    found = bracketed_quantiles(marked, {n: F.when(F.col(n), F.col(score)) for n in HARD_SHARES}, {"median_score": 0.5})
    medians = df.sparkSession.createDataFrame([(n, q["median_score"]) for n, q in found.items()], "definition string, median_score double")
    return stats.join(medians, "definition").select(
        "definition", "score_cutoff", "hard_negative_count", (F.col("hard_negative_count") / negatives).alias("negative_percentage"),
        "mean_score", "median_score",
    )


def precision_needed(recall: Column, target_f1: float = 0.65) -> Column:
    """Precision that gives target_f1 at this recall; null where no precision can."""
    return F.try_divide(F.lit(target_f1) * recall, 2 * recall - F.lit(target_f1))


def metric_rows(df: DataFrame, metrics: Sequence[str], keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    return df.select(*keep, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(list(keep), list(metrics), "metric", value)


def metric_difference(left: DataFrame, right: DataFrame, left_name: str, right_name: str, difference: str, keep: Sequence[str] = ()) -> DataFrame:
    """Join two (keep..., metric, value) tables; difference = right - left."""
    a = left.withColumnRenamed("value", left_name)
    b = right.withColumnRenamed("value", right_name)
    return a.join(b, [*keep, "metric"]).withColumn(difference, F.col(right_name) - F.col(left_name))


def reproduction_check(actual: DataFrame, expected: DataFrame, tolerance: float = 0.01, keep: Sequence[str] = ()) -> DataFrame:
    """PASS where the absolute difference is within the tolerance, else REVIEW."""
    table = metric_difference(expected, actual, "reference", "reproduced", "_d", keep)
    gap = F.abs("_d")
    return table.select(
        *keep, "metric", "reproduced", "reference", gap.alias("absolute_difference"),
        F.when(gap <= tolerance, "PASS").otherwise("REVIEW").alias("status"),
    )
