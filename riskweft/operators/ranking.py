"""Candidate comparison, gates and selection. Inputs are metric tables with one row per candidate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweft.operators.scoring import first_by, gate_status, passes_gates, with_metrics
from riskweft.sources.contract import GATES, SEED

BASELINE = "dummy_classifier"


def _descending(names: Sequence[str]) -> list[Column]:
    return [F.desc(n) for n in names]


def _column(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def comparison(df: DataFrame, f1: str = "f1") -> DataFrame:
    """Add passes_gates on the named kind of F1 and sort by gates, f1, AUC, recall, precision, accuracy."""
    gated = df.withColumn("passes_gates", passes_gates(F.col("roc_auc"), F.col("recall"), F.col(f1)))
    return gated.orderBy(*_descending(["passes_gates", "f1", "roc_auc", "recall", "precision", "accuracy"]), "model_name")


def best_result(df: DataFrame, f1: str = "f1") -> DataFrame:
    return comparison(df, f1).limit(1)


def promising(df: DataFrame, limit: int = 3) -> DataFrame:
    return df.where(F.col("model_name") != BASELINE).orderBy(*_descending(["roc_auc", "f1", "recall", "precision"]), "model_name").limit(limit)


FAMILY_ORDER = ("constrained_max_f1", "average_precision", "roc_auc", "constrained_precision")


def promising_families(df: DataFrame, limit: int = 4) -> DataFrame:
    """Best row per family without the baseline, then the best families."""
    kept = df.where(F.col("model_family") != BASELINE)
    best = first_by(kept, ["model_family"], [*[F.col(c) for c in FAMILY_ORDER], F.col("variant_name")])
    return best.orderBy(*_descending(FAMILY_ORDER), "model_family").limit(limit)


def best_eligible(df: DataFrame, order: Sequence[str] = ("f1_binary", "recall", "precision", "roc_auc"), tie: str = "experiment") -> DataFrame:
    """Best row with AUC and recall inside the gates, else the best of all rows."""
    ok = F.coalesce((F.col("roc_auc") >= GATES["roc_auc"]) & (F.col("recall") >= GATES["recall"]), F.lit(False))
    return df.orderBy(F.desc(ok), *_descending(order), tie).limit(1)


def rerank(df: DataFrame) -> DataFrame:
    """Metrics from the counts, the gates, and a rank for validation rows that pass all of them."""
    metrics = with_metrics(df.select("round", "experiment", "model", "selection_source", "auc", "tn", "fp", "fn", "tp"))
    auc_ok = F.coalesce(F.col("auc") >= GATES["roc_auc"], F.lit(False))
    recall_ok, f1_ok = F.col("recall_positive") >= GATES["recall"], F.col("f1_macro") >= GATES["f1"]
    flagged = metrics.select(
        "*", auc_ok.alias("passes_auc"), recall_ok.alias("passes_recall"), f1_ok.alias("passes_macro_f1"),
        (auc_ok & recall_ok & f1_ok).alias("passes_all_A1_gates"),
    )
    eligible = F.col("passes_all_A1_gates") & (F.col("selection_source") == "VALIDATION")
    order = Window.partitionBy(eligible).orderBy(*_descending(["f1_macro", "auc", "recall_positive", "precision_positive"]), "experiment")
    return flagged.withColumn("rank_if_valid", F.when(eligible, F.row_number().over(order)))


def consolidate(tables: Sequence[DataFrame], rename: dict[str, str] | None = None) -> DataFrame:
    """Union by name of tables with different columns, then rename."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out.withColumnsRenamed(rename) if rename else out


def experiment_record(
    df: DataFrame, experiment: str | Column, model: str | Column, strategy: str, class_weighting: str, hyperparameters: dict,
    seed: int = SEED, stamp: str | None = None,
) -> DataFrame:
    """Metric rows as experiment records with status and UTC stamp."""
    moment = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    now = F.lit(stamp) if stamp else F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    params = F.create_map(*[F.lit(str(v)) for kv in sorted(hyperparameters.items()) for v in kv]) if hyperparameters else F.create_map().cast("map<string,string>")
    return df.select(
        _column(experiment).alias("experiment"), _column(model).alias("model"), F.lit(strategy).alias("strategy"), "threshold",
        F.col("precision_positive").alias("precision"), F.col("recall_positive").alias("recall"), "f1_binary",
        F.col("f1_macro").alias("macro_f1"), F.col("f1_weighted").alias("weighted_f1"), "roc_auc", "accuracy",
        F.lit(seed).alias("seed"), gate_status(F.col("roc_auc"), F.col("recall_positive"), F.col("f1_macro")).alias("status"),
        F.lit(class_weighting).alias("class_weighting"), params.alias("hyperparameters"), now.alias("timestamp"),
    )


def variant_row(summary: DataFrame, family: str | Column, variant: str | Column, tuned: bool = False) -> DataFrame:
    """Trade-off summary as a model-variant comparison row; expects roc_auc beside the summary columns."""
    passes = (F.col("constrained_max_f1") >= GATES["f1"]) & (F.col("constrained_recall") >= GATES["recall"])
    return summary.select(
        _column(family).alias("model_family"), _column(variant).alias("variant_name"), F.lit(tuned).alias("tuned"), "roc_auc", "average_precision",
        F.col("f1_at_point_five").alias("f1_at_0_5"), "max_f1", "max_f1_threshold", "recall_at_max_f1", "precision_at_max_f1", "constrained_max_f1",
        F.col("constrained_max_f1_threshold").alias("constrained_threshold"), "constrained_recall", "constrained_precision",
        F.col("best_precision_at_recall_gate").alias("best_precision_at_recall_ge_0_60"),
        F.col("threshold_at_best_precision_recall_gate").alias("threshold_at_best_precision_recall_ge_0_60"),
        passes.alias("passes_validation_gate"),
    )


def freeze_variant(df: DataFrame) -> DataFrame:
    """The variant to freeze: both recalls above the gate if any row has that; READY or NEEDS review."""
    kept = df.where(F.col("model_family") != BASELINE)
    ok = (F.col("recall_at_max_f1") >= GATES["recall"]) & (F.col("constrained_recall") >= GATES["recall"])
    chosen = kept.orderBy(F.desc(ok), *_descending(FAMILY_ORDER), "model_family", "variant_name").limit(1)
    ready = (F.col("constrained_max_f1") >= GATES["f1"]) & (F.col("constrained_recall") >= GATES["recall"])
    return chosen.withColumn("status", F.when(ready, "READY_FOR_FINAL_EVALUATION").otherwise("NEEDS_GATE_REVIEW"))


def freeze_winner(reranked: DataFrame, previous: str | None = None) -> DataFrame:
    """One row for the rank-1 candidate: metrics, gates, reason, previous winner."""
    return reranked.where("rank_if_valid = 1").select(
        "model", "experiment", "round", F.lit("f1_macro").alias("official_f1_metric"), F.col("f1_macro").alias("official_f1_value"), "auc",
        F.col("recall_positive").alias("recall"), F.col("precision_positive").alias("precision"), "f1_binary", "f1_weighted", "tn", "fp", "fn", "tp",
        F.struct("passes_auc", "passes_recall", "passes_macro_f1").alias("gates"), F.col("passes_all_A1_gates").alias("all_gates_pass"),
        F.lit("highest macro F1 among validation candidates that pass every gate").alias("reason"), F.lit(previous).cast("string").alias("previous_winner"),
    )


def best_per_round(df: DataFrame, metric: str = "f1_binary", group: str = "round") -> DataFrame:
    return df.groupBy(group).agg(F.max(metric).alias(metric), F.max_by("experiment", F.struct(F.col(metric), F.col("experiment"))).alias("experiment"))


def gate_table(df: DataFrame, keep: Sequence[str] = (), auc: str = "roc_auc", recall: str = "recall_positive", f1: str = "f1_macro") -> DataFrame:
    """(keep..., metric, value, requirement, status), one row per gate."""
    def row(name: str, col: str, gate: float) -> Column:
        return F.struct(
            F.lit(name).alias("metric"), F.col(col).alias("value"), F.lit(gate).alias("requirement"),
            F.when(F.col(col) >= gate, "PASS").otherwise("FAIL").alias("status"),
        )

    cells = F.array(row("roc_auc", auc, GATES["roc_auc"]), row("recall", recall, GATES["recall"]), row("f1_macro", f1, GATES["f1"]))
    return df.select(*keep, F.inline(cells))
