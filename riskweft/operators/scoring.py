"""Metrics and threshold search over (group..., label, score).

Every function takes by: the group columns (model, segment, period, weight
set, ...). All groups are evaluated in one plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskweft.operators.ordered import fold_values, in_ranges, running_totals
from riskweft.session import stage
from riskweft.sources.contract import GATES

GRID = 1_000_000          # thresholds live on a grid of six decimals
GRID_RANGE = 1 << 14      # grid cells per range in the running totals
COUNTS = ("tn", "fp", "fn", "tp")


def share(numerator: Column, denominator: Column) -> Column:
    """Ratio with 0 on a zero denominator."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def confusion(df: DataFrame, by: Sequence[str] = (), label: str = "label", predicted: str = "predicted") -> DataFrame:
    truth, hit = F.col(label) == 1, F.col(predicted) == 1
    return df.groupBy(*by).agg(
        F.count_if(~truth & ~hit).alias("tn"), F.count_if(~truth & hit).alias("fp"),
        F.count_if(truth & ~hit).alias("fn"), F.count_if(truth & hit).alias("tp"),
    )


def confusion_at(df: DataFrame, threshold: float | Column, by: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return confusion(df.withColumn("predicted", (F.col(score) >= t).cast("int")), by, label)


def metric_columns() -> dict[str, Column]:
    """All metrics that follow from the four counts."""
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    n = tn + fp + fn + tp
    precision, recall = share(tp, tp + fp), share(tp, tp + fn)
    f1, f1_zero = share(2 * tp, 2 * tp + fp + fn), share(2 * tn, 2 * tn + fp + fn)
    macro = (f1_zero + f1) / 2
    accuracy, specificity = share(tn + tp, n), share(tn, tn + fp)
    return {
        "precision_positive": precision,
        "recall_positive": recall,
        "f1_binary": f1,
        "f1_binary_default_1": f1,
        "f1_class_0": f1_zero,
        "f1_macro": macro,
        "f1_weighted": share(f1_zero * (tn + fp) + f1 * (fn + tp), n),
        "micro_f1": accuracy,
        "official_a1_f1": macro,
        "accuracy": accuracy,
        "specificity": specificity,
        "balanced_accuracy": (recall + specificity) / 2,
        "target_positive_prevalence": share(fn + tp, n),
        "predicted_positive_prevalence": share(fp + tp, n),
    }


def with_metrics(counts: DataFrame) -> DataFrame:
    return counts.select("*", *[c.alias(n) for n, c in metric_columns().items()])


def fold_scores(df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """(by, score, pos, neg): the only row-level shuffle of the metric operators, staged for the later passes."""
    scored = df.where(F.col(score).isNotNull())
    measures = {"pos": F.when(F.col(label) == 1, 1).otherwise(0), "neg": F.when(F.col(label) == 1, 0).otherwise(1)}
    folded = fold_values(scored, by, score, measures)
    return stage(folded.withColumnRenamed(score, "score") if score != "score" else folded, "scores")


def cumulative(folded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: tp and fp of the rule score >= s, and the class totals."""
    placed = running_totals(in_ranges(folded, by, "score"), by, ["score"], ["pos", "neg"], F.col("_range"))
    placed = _with_totals(placed, folded, by)
    return placed.select(
        *by, "score", "pos", "neg", "positives", "negatives",
        (F.col("positives") - F.col("cum_pos") + F.col("pos")).alias("tp"),
        (F.col("negatives") - F.col("cum_neg") + F.col("neg")).alias("fp"),
        (F.col("cum_neg") - F.col("neg")).alias("neg_below"),
    )


def class_totals(folded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return folded.groupBy(*by).agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))


def _with_totals(df: DataFrame, folded: DataFrame, by: Sequence[str]) -> DataFrame:
    totals = class_totals(folded, by)
    if by:
        return df.join(totals, list(by))
    return df.select("*", *[totals.select(c).scalar().alias(c) for c in ("positives", "negatives")])


def rank_metrics(folded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, roc_auc, average_precision): ties count half in the AUC; AP is the step sum."""
    half_wins = F.col("pos").cast("double") * (2 * F.col("neg_below") + F.col("neg"))
    step = F.col("pos") * share(F.col("tp"), F.col("tp") + F.col("fp"))
    sums = cumulative(folded, by).groupBy(*by).agg(
        F.sum(half_wins).alias("_wins"), F.sum(step).alias("_steps"),
        F.max("positives").cast("double").alias("_p"), F.max("negatives").alias("_n"),
    )
    return sums.select(
        *by,
        F.try_divide(F.col("_wins"), 2 * F.col("_p") * F.col("_n")).alias("roc_auc"),
        F.try_divide(F.col("_steps"), F.col("_p")).alias("average_precision"),
    )


def roc_curve(folded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, threshold, fpr, tpr): all distinct scores (collinear points kept) and the (0, 0) point at infinity."""
    points = cumulative(folded, by).select(
        *by, F.col("score").alias("threshold"),
        share(F.col("fp"), F.col("negatives")).alias("fpr"), share(F.col("tp"), F.col("positives")).alias("tpr"),
    )
    start = class_totals(folded, by).select(
        *by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def pr_curve(folded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, threshold, precision, recall) and the closing point (null, 1, 0)."""
    points = cumulative(folded, by).select(
        *by, F.col("score").alias("threshold"),
        share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), share(F.col("tp"), F.col("positives")).alias("recall"),
    )
    end = class_totals(folded, by).select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def _grid_floor(score: Column) -> Column:
    """Largest k with k/GRID <= score, exact in double arithmetic."""
    k = F.floor(score * GRID)
    return F.when((k + 1) / F.lit(float(GRID)) <= score, k + 1).when(k / F.lit(float(GRID)) > score, k - 1).otherwise(k)


def threshold_counts(folded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, threshold, tn, fp, fn, tp) for every score rounded to six decimals, and 0.5.

    Counts use the unrounded scores: each score sits in its grid cell, a
    candidate at cell k counts the cells >= k. For probabilities there are at
    most 1,000,002 candidates per group, whatever the number of rows.
    """
    score = F.col("score")
    cells = folded.groupBy(*by, _grid_floor(score).alias("cell"), F.rint(score * GRID).cast("bigint").alias("candidate")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    zero = F.lit(0).cast("bigint")
    entries = F.array(
        F.struct(F.col("cell").alias("k"), F.col("pos").alias("pos"), F.col("neg").alias("neg"), F.lit(0).alias("is_candidate")),
        F.struct(F.col("candidate").alias("k"), zero.alias("pos"), zero.alias("neg"), F.lit(1).alias("is_candidate")),
    )
    spread = cells.select(*by, F.explode(entries).alias("e")).select(*by, "e.*")
    half = class_totals(folded, by).select(
        *by, F.lit(GRID // 2).cast("bigint").alias("k"), zero.alias("pos"), zero.alias("neg"), F.lit(1).alias("is_candidate")
    )
    merged = spread.unionByName(half).groupBy(*by, "k").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.max("is_candidate").alias("is_candidate")
    )
    placed = running_totals(merged, by, ["k"], ["pos", "neg"], F.floor(F.col("k") / GRID_RANGE))
    placed = _with_totals(placed.where("is_candidate = 1"), folded, by)
    tp = F.col("positives") - F.col("cum_pos") + F.col("pos")
    fp = F.col("negatives") - F.col("cum_neg") + F.col("neg")
    return placed.select(
        *by, (F.col("k") / F.lit(float(GRID))).alias("threshold"),
        (F.col("negatives") - fp).alias("tn"), fp.alias("fp"), (F.col("positives") - tp).alias("fn"), tp.alias("tp"),
    )


def threshold_table(
    folded: DataFrame, by: Sequence[str] = (), min_recall: float = GATES["recall"], min_auc: float = GATES["roc_auc"],
    rank_columns: Sequence[str] = ("roc_auc",),
) -> DataFrame:
    """One row per candidate threshold with every metric and the gate flags."""
    table = with_metrics(threshold_counts(folded, by))
    ranks = rank_metrics(folded, by).select(*by, *rank_columns)
    table = table.join(ranks, list(by)) if by else table.select("*", *[ranks.select(c).scalar().alias(c) for c in rank_columns])
    recall_ok, auc_ok = F.col("recall_positive") >= min_recall, F.col("roc_auc") >= min_auc
    return table.select(
        "*",
        F.lit("f1_macro").alias("official_f1_metric"),
        F.col("f1_binary").alias("f1"), F.col("precision_positive").alias("precision"), F.col("recall_positive").alias("recall"),
        recall_ok.alias("passes_recall_gate"), auc_ok.alias("passes_auc_gate"), (recall_ok & auc_ok).alias("valid_candidate"),
        F.abs(F.col("threshold") - 0.5).alias("threshold_distance_to_half"),
    )


def first_by(table: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the greatest order tuple per group: one partial aggregation, no sort."""
    rest = [c for c in table.columns if c not in by]
    best = table.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_best"))
    return best.select(*by, *[F.col("_best")[c].alias(c) for c in rest])


def best_threshold(table: DataFrame, by: Sequence[str] = (), min_recall: float = GATES["recall"], min_auc: float = GATES["roc_auc"]) -> DataFrame:
    """Best binary-F1 row: gates on recall and AUC, else on recall, else all rows with recall first."""
    f1, recall, precision = F.col("f1_binary"), F.col("recall_positive"), F.col("precision_positive")
    tier = F.when((recall >= min_recall) & (F.col("roc_auc") >= min_auc), 2).when(recall >= min_recall, 1).otherwise(0)
    order = [
        tier, F.when(tier > 0, f1).otherwise(recall), F.when(tier > 0, recall).otherwise(f1), precision,
        -F.abs(F.col("threshold") - 0.5), -F.col("threshold"),
    ]
    return first_by(table, by, order)


def fast_threshold(counts: DataFrame, by: Sequence[str] = (), objective: str = "f1", min_recall: float = GATES["recall"]) -> DataFrame:
    """Best threshold by (objective, the other one, threshold) under the recall gate alone, else over all rows."""
    table = counts if "f1_binary" in counts.columns else with_metrics(counts)
    f1, precision = F.col("f1_binary"), F.col("precision_positive")
    keys = [precision, f1] if objective == "precision" else [f1, precision]
    gate = F.when(F.col("recall_positive") >= min_recall, 1).otherwise(0)
    return first_by(table, by, [gate, *keys, F.col("threshold")])


def objective_threshold(table: DataFrame, by: Sequence[str] = (), objective: str = "f1", min_recall: float = GATES["recall"]) -> DataFrame:
    """Rows above the recall gate by (objective, other, threshold); without any, the three-tier rule."""
    f1, precision, recall = F.col("f1_binary"), F.col("precision_positive"), F.col("recall_positive")
    keys = [precision, f1] if objective == "precision" else [f1, precision]
    gate = F.when(recall >= min_recall, 1).otherwise(0)
    # Below the gate the last tier of best_threshold applies: recall, f1, precision, distance.
    order = [
        gate, F.when(gate == 1, keys[0]).otherwise(recall), F.when(gate == 1, keys[1]).otherwise(f1),
        F.when(gate == 1, F.col("threshold")).otherwise(precision),
        F.when(gate == 1, 0.0).otherwise(-F.abs(F.col("threshold") - 0.5)), -F.col("threshold"),
    ]
    return first_by(table, by, order)


def _pick(prefix: dict[str, str], order: Sequence[Column], valid: Column | None = None) -> Column:
    row = F.struct(*[F.col(c).alias(n) for n, c in prefix.items()])
    key = F.struct(*order)
    return F.max_by(row, key if valid is None else F.when(valid, key))


def tradeoff_summary(table: DataFrame, folded: DataFrame, by: Sequence[str] = (), min_recall: float = GATES["recall"]) -> DataFrame:
    """AUC, average precision, F1 at 0.5, best F1, best F1 and best precision under the recall gate."""
    f1, p, r, t = (F.col(c) for c in ("f1_binary", "precision_positive", "recall_positive", "threshold"))
    near = -F.abs(t - 0.5)
    gate = r >= min_recall
    cols = {"f1": "f1_binary", "t": "threshold", "r": "recall_positive", "p": "precision_positive"}
    picked = table.groupBy(*by).agg(
        _pick(cols, [f1, p, r, t]).alias("top"),
        _pick(cols, [f1, p, near, -t], gate).alias("held"),
        _pick(cols, [p, f1, near, -t], gate).alias("sharp"),
        F.max(F.when(t == 0.5, f1)).alias("f1_at_point_five"),
    )
    held, sharp = F.coalesce("held", "top"), F.coalesce("sharp", "top")
    summary = picked.select(
        *by, "f1_at_point_five",
        F.col("top")["f1"].alias("max_f1"), F.col("top")["t"].alias("max_f1_threshold"),
        F.col("top")["r"].alias("recall_at_max_f1"), F.col("top")["p"].alias("precision_at_max_f1"),
        held["f1"].alias("constrained_max_f1"), held["t"].alias("constrained_max_f1_threshold"),
        held["r"].alias("constrained_recall"), held["p"].alias("constrained_precision"),
        sharp["p"].alias("best_precision_at_recall_gate"), sharp["t"].alias("threshold_at_best_precision_recall_gate"),
    )
    ranks = rank_metrics(folded, by)
    if by:
        return summary.join(ranks, list(by))
    return summary.select("*", *[ranks.select(c).scalar().alias(c) for c in ("roc_auc", "average_precision")])


def unconstrained_best(table: DataFrame, by: Sequence[str] = (), min_recall: float = GATES["recall"]) -> DataFrame:
    """Highest F1 anywhere and highest precision under the recall gate, with their thresholds."""
    f1, p, t = F.col("f1_binary"), F.col("precision_positive"), F.col("threshold")
    picked = table.groupBy(*by).agg(
        _pick({"v": "f1_binary", "t": "threshold"}, [f1, -t]).alias("a"),
        _pick({"v": "precision_positive", "t": "threshold"}, [p, f1, -t], F.col("recall_positive") >= min_recall).alias("b"),
    )
    return picked.select(
        *by, F.col("a")["v"].alias("max_f1_unconstrained"), F.col("a")["t"].alias("max_f1_unconstrained_threshold"),
        F.col("b")["v"].alias("max_precision_recall_gate"), F.col("b")["t"].alias("max_precision_recall_gate_threshold"),
    )


def passes_gates(auc: Column, recall: Column, f1: Column) -> Column:
    """Inclusive gates; a missing value fails. The kind of F1 is the caller's explicit choice."""
    ok = (auc >= GATES["roc_auc"]) & (recall >= GATES["recall"]) & (f1 >= GATES["f1"])
    return F.coalesce(ok, F.lit(False))


def gate_status(auc: Column, recall: Column, f1: Column) -> Column:
    ranked = F.coalesce((auc >= GATES["roc_auc"]) & (recall >= GATES["recall"]), F.lit(False))
    return F.when(passes_gates(auc, recall, f1), "PASS").when(ranked, "VALID_BUT_F1_LOW").otherwise("FAIL")


def evaluate(df: DataFrame, threshold: float | Column, by: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """Counts, metrics and rank metrics at a fixed threshold."""
    folded = fold_scores(df, by, label, score)
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    hit = F.col("score") >= t
    counts = folded.groupBy(*by).agg(
        F.sum(F.when(hit, 0).otherwise(F.col("neg"))).alias("tn"), F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"), F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
    )
    ranks = rank_metrics(folded, by)
    table = with_metrics(counts)
    if by:
        return table.join(ranks, list(by))
    return table.select("*", *[ranks.select(c).scalar().alias(c) for c in ("roc_auc", "average_precision")])
