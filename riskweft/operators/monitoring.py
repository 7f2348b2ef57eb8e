"""Batch monitoring: data quality, drift, prediction drift, realised performance, alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweft.functions.rowmath import quoted
from riskweft.operators.ordered import fold_values, in_ranges, long_form, running_totals
from riskweft.operators.quality import edges_below, literal_edges
from riskweft.operators.quantiles import bracketed_quantiles
from riskweft.operators.scoring import evaluate, share
from riskweft.session import stage
from riskweft.sources.contract import GATES

FLOOR = 1e-6


def quality_by_period(df: DataFrame, period: str, missing: Column, invalid: Column, broken: Column) -> DataFrame:
    """(period, rows, missing_rate, invalid_rate, schema_failure_rate)."""
    def rate(condition: Column) -> Column:
        return F.count_if(condition) / F.count(F.lit(1))

    return df.groupBy(period).agg(
        F.count(F.lit(1)).alias("rows"), rate(missing).alias("missing_rate"), rate(invalid).alias("invalid_rate"), rate(broken).alias("schema_failure_rate")
    )


def psi(df: DataFrame, columns: Sequence[str], is_current: Column, bins: int = 10, floor: float = FLOOR) -> DataFrame:
    """(feature, psi): population stability over quantile bins of the baseline rows.

    Values beyond the baseline range fall into the outer bins; an empty share
    counts as floor.
    """
    now = F.coalesce(is_current.cast("int"), F.lit(0))
    values = {c: F.col(quoted(c)).cast("double") for c in columns}
    found = bracketed_quantiles(df, {c: F.when(now == 0, v) for c, v in values.items()}, {f"e{i}": i / bins for i in range(1, bins)})
    cells = []
    for c, points in found.items():
        if None not in points.values():
            bin_ = edges_below(values[c], literal_edges(list(dict.fromkeys(points.values()))))
            cells.append(F.when(values[c].isNotNull(), F.struct(F.lit(c).alias("feature"), bin_.alias("bin"), (1 - now).alias("base"), now.alias("now"))))
    if not cells:
        return df.sparkSession.createDataFrame([], "feature string, psi double")
    # Summed in the task: what is shuffled is one row for each feature and bin.
    placed = df.select(F.inline(F.array_compact(F.array(*cells))))
    binned = placed.groupBy("feature", "bin").agg(F.sum("base").alias("base"), F.sum("now").alias("now"))
    whole = Window.partitionBy("feature")
    p = F.greatest(F.col("base") / F.sum("base").over(whole), F.lit(floor))
    q = F.greatest(F.col("now") / F.sum("now").over(whole), F.lit(floor))
    parts = binned.select("feature", ((q - p) * F.ln(q / p)).alias("part"))
    return parts.groupBy("feature").agg(F.sum("part").alias("psi"))


def ks_distance(df: DataFrame, columns: Sequence[str], is_current: Column) -> DataFrame:
    """(feature, ks): largest gap between the two empirical distribution functions."""
    rows = long_form(df.withColumn("_now", is_current.cast("int")), columns, ["_now"]).where("value is not null")
    folded = stage(fold_values(rows, ["feature"], "value", {"base": 1 - F.col("_now"), "now": F.col("_now")}), "folded")
    placed = running_totals(in_ranges(folded, ["feature"], "value"), ["feature"], ["value"], ["base", "now"], F.col("_range"))
    totals = folded.groupBy("feature").agg(F.sum("base").alias("n_base"), F.sum("now").alias("n_now"))
    gap = F.abs(share(F.col("cum_base"), F.col("n_base")) - share(F.col("cum_now"), F.col("n_now")))
    return placed.join(totals, "feature").groupBy("feature").agg(F.max(gap).alias("ks"))


def prediction_drift(df: DataFrame, period: str, score: str, threshold: float, bins: int = 10) -> DataFrame:
    """(period, bin, rows, positives): score histogram per period over [0, 1] and the predicted positives in it."""
    place = F.least(F.lit(bins - 1), F.floor(F.col(score) * bins)).cast("int")
    return df.groupBy(period, place.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(score) >= threshold).alias("positives")
    )


def positive_rate(drift: DataFrame, period: str) -> DataFrame:
    return drift.groupBy(period).agg(F.sum("rows").alias("rows"), (F.sum("positives") / F.sum("rows")).alias("predicted_positive_rate"))


def realised_performance(predictions: DataFrame, labels: DataFrame, key: str, period: str, threshold: float) -> DataFrame:
    """Metrics per period of the predictions whose label has arrived."""
    known = predictions.join(labels, key)
    return evaluate(known, threshold, [period]).select(
        period, "tn", "fp", "fn", "tp", "roc_auc", "f1_binary", "f1_macro", "recall_positive", "precision_positive"
    )


def gate_breaches(performance: DataFrame, period: str) -> DataFrame:
    """(period, metric, value, gate, below) for the three gated metrics."""
    def row(metric: str, column: str, gate: float) -> Column:
        value = F.col(column)
        return F.struct(F.lit(metric).alias("metric"), value.alias("value"), F.lit(gate).alias("gate"), F.coalesce(value < gate, F.lit(True)).alias("below"))

    cells = F.array(
        row("roc_auc", "roc_auc", GATES["roc_auc"]), row("recall", "recall_positive", GATES["recall"]), row("f1_macro", "f1_macro", GATES["f1"])
    )
    return performance.select(period, F.inline(cells))


def persistent_alerts(breaches: DataFrame, period: str, runs: int = 3) -> DataFrame:
    """Runs of at least so many consecutive periods below the gate; isolated dips drop out."""
    order = Window.partitionBy("metric").orderBy(period)
    island = F.count_if(~F.col("below")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        breaches.withColumn("_island", island).where("below").groupBy("metric", "_island")
        .agg(F.min(period).alias("first_period"), F.max(period).alias("last_period"), F.count(F.lit(1)).alias("periods"), F.min("value").alias("worst"))
        .where(F.col("periods") >= runs).drop("_island")
    )
