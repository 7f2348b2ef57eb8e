"""Metric and threshold queries (MET*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.operators import projection as pr, scoring as sc
from riskweft.queries.features import rounded
from riskweft.queries.registry import query
from riskweft.queries.scores import METRIC_NAMES, METRIC_SQL, scores_long, scored_wide, threshold_ctes, with_scores
from riskweft.sources.contract import GATES

BY = ["model"]
R = 9


def r(names, digits=R):
    return ", ".join(f"round({n}, {digits}) as {n}" for n in names)


COUNTS = "tn, fp, fn, tp"
AT_HALF = (
    "at_half as (select model, cast(sum(case when label=0 and score<0.5 then 1 else 0 end) as bigint) as tn,"
    " cast(sum(case when label=0 and score>=0.5 then 1 else 0 end) as bigint) as fp,"
    " cast(sum(case when label=1 and score<0.5 then 1 else 0 end) as bigint) as fn,"
    " cast(sum(case when label=1 and score>=0.5 then 1 else 0 end) as bigint) as tp from scores group by model)"
)


@query("met1_confusion_counts", with_scores(f"select model, {COUNTS} from at_half", AT_HALF))
def met1_confusion_counts(spark, sf):
    return sc.confusion_at(scores_long(spark, sf), 0.5, BY)


@query(
    "met2_metrics_from_counts",
    with_scores(f"select model, {COUNTS}, {r(METRIC_NAMES)} from (select *, {METRIC_SQL} from at_half)", AT_HALF),
)
def met2_metrics_from_counts(spark, sf):
    return rounded(sc.with_metrics(sc.confusion_at(scores_long(spark, sf), 0.5, BY)), R)


CTES = threshold_ctes()


@query("met3_roc_auc", with_scores("select model, round(roc_auc, 9) as roc_auc from rank_metrics", *CTES[:4]))
def met3_roc_auc(spark, sf):
    return rounded(sc.rank_metrics(sc.fold_scores(scores_long(spark, sf), BY), BY).select("model", "roc_auc"), R)


@query("met4_average_precision", with_scores("select model, round(average_precision, 9) as average_precision from rank_metrics", *CTES[:4]))
def met4_average_precision(spark, sf):
    return rounded(sc.rank_metrics(sc.fold_scores(scores_long(spark, sf), BY), BY).select("model", "average_precision"), R)


@query(
    "met5_roc_curve",
    with_scores(
        "select model, score as threshold, round(cast(cfp as double)/nn, 9) as fpr, round(cast(ctp as double)/np, 9) as tpr from cum"
        " union all select model, cast('infinity' as double), 0.0, 0.0 from totals",
        *CTES[:3],
    ),
)
def met5_roc_curve(spark, sf):
    return rounded(sc.roc_curve(sc.fold_scores(scores_long(spark, sf), BY), BY), R, ("threshold",))


@query(
    "met6_pr_curve",
    with_scores(
        "select model, score as threshold, round(cast(ctp as double)/(ctp+cfp), 9) as precision, round(cast(ctp as double)/np, 9) as recall from cum"
        " union all select model, null, 1.0, 0.0 from totals",
        *CTES[:3],
    ),
)
def met6_pr_curve(spark, sf):
    return rounded(sc.pr_curve(sc.fold_scores(scores_long(spark, sf), BY), BY), R, ("threshold",))


FLAGS = (
    f"'f1_macro' as official_f1_metric, round(f1_binary,9) as f1, round(precision_positive,9) as precision, round(recall_positive,9) as recall,"
    f" recall_positive >= {GATES['recall']} as passes_recall_gate, roc_auc >= {GATES['roc_auc']} as passes_auc_gate,"
    f" recall_positive >= {GATES['recall']} and roc_auc >= {GATES['roc_auc']} as valid_candidate, round(near,9) as threshold_distance_to_half"
)
FULL = f"model, threshold, {COUNTS}, {r(METRIC_NAMES)}, round(roc_auc,9) as roc_auc, {FLAGS}"


def table(spark, sf):
    folded = sc.fold_scores(scores_long(spark, sf), BY)
    return sc.threshold_table(folded, BY), folded


@query("met7_threshold_table", with_scores(f"select {FULL} from tt", *CTES))
def met7_threshold_table(spark, sf):
    return rounded(table(spark, sf)[0], R, ("threshold",))


def best_sql(order: str, source: str = "tt", columns: str = FULL) -> str:
    return f"select {columns} from (select *, row_number() over (partition by model order by {order}) as pos from {source}) where pos = 1"


@query(
    "met8_fast_threshold",
    with_scores(
        best_sql(
            "case when recall_positive >= 0.6 then 0 else 1 end, f1_binary desc, precision_positive desc, threshold desc",
            columns=f"model, threshold, {COUNTS}, {r(METRIC_NAMES)}",
        ),
        *CTES,
    ),
)
def met8_fast_threshold(spark, sf):
    folded = sc.fold_scores(scores_long(spark, sf), BY)
    return rounded(sc.fast_threshold(sc.threshold_counts(folded, BY), BY), R, ("threshold",))


@query(
    "met8_fast_threshold_precision",
    with_scores(
        best_sql(
            "case when recall_positive >= 0.6 then 0 else 1 end, precision_positive desc, f1_binary desc, threshold desc",
            columns=f"model, threshold, {COUNTS}, {r(METRIC_NAMES)}",
        ),
        *CTES,
    ),
)
def met8_fast_threshold_precision(spark, sf):
    folded = sc.fold_scores(scores_long(spark, sf), BY)
    return rounded(sc.fast_threshold(sc.threshold_counts(folded, BY), BY, "precision"), R, ("threshold",))


TIERED = (
    "case when recall_positive >= 0.6 and roc_auc >= 0.75 then 0 when recall_positive >= 0.6 then 1 else 2 end,"
    " case when recall_positive >= 0.6 then f1_binary else recall_positive end desc,"
    " case when recall_positive >= 0.6 then recall_positive else f1_binary end desc, precision_positive desc, near, threshold"
)


@query("met9_best_threshold", with_scores(best_sql(TIERED), *CTES))
def met9_best_threshold(spark, sf):
    return rounded(sc.best_threshold(table(spark, sf)[0], BY), R, ("threshold",))


@query("met10_tuned_threshold", with_scores(best_sql(TIERED, columns="model, threshold"), *CTES))
def met10_tuned_threshold(spark, sf):
    return sc.best_threshold(table(spark, sf)[0], BY).select("model", "threshold")


def _top(order: str, where: str = "true", value: str = "threshold") -> str:
    return f"(select {value} from tt x where x.model = m.model and {where} order by {order} limit 1)"


_TOP = "f1_binary desc, precision_positive desc, recall_positive desc, threshold desc"
_HELD = "f1_binary desc, precision_positive desc, near, threshold"
_SHARP = "precision_positive desc, f1_binary desc, near, threshold"


@query(
    "met11_tradeoff_summary",
    with_scores(
        "select m.model, round(max(case when m.threshold=0.5 then m.f1_binary end),9) as f1_at_point_five,"
        " round(arg_max(m.f1_binary, -pos_top),9) as max_f1, arg_max(m.threshold, -pos_top) as max_f1_threshold,"
        " round(arg_max(m.recall_positive, -pos_top),9) as recall_at_max_f1, round(arg_max(m.precision_positive, -pos_top),9) as precision_at_max_f1,"
        " round(arg_max(m.f1_binary, -pos_held),9) as constrained_max_f1, arg_max(m.threshold, -pos_held) as constrained_max_f1_threshold,"
        " round(arg_max(m.recall_positive, -pos_held),9) as constrained_recall, round(arg_max(m.precision_positive, -pos_held),9) as constrained_precision,"
        " round(arg_max(m.precision_positive, -pos_sharp),9) as best_precision_at_recall_gate,"
        " arg_max(m.threshold, -pos_sharp) as threshold_at_best_precision_recall_gate, round(max(m.average_precision),9) as average_precision"
        " from ranked m group by m.model",
        *CTES,
        f"ranked as (select tt.*, average_precision, row_number() over (partition by tt.model order by {_TOP}) as pos_top,"
        f" row_number() over (partition by tt.model order by (recall_positive >= 0.6) desc, {_HELD}) as pos_held,"
        f" row_number() over (partition by tt.model order by (recall_positive >= 0.6) desc, {_SHARP}) as pos_sharp"
        " from tt join rank_metrics using (model))",
    ),
)
def met11_tradeoff_summary(spark, sf):
    thresholds, folded = table(spark, sf)
    skip = tuple(c for c in ("max_f1_threshold", "constrained_max_f1_threshold", "threshold_at_best_precision_recall_gate"))
    return rounded(sc.tradeoff_summary(thresholds, folded, BY).drop("roc_auc"), R, skip)


@query(
    "met12_objective_threshold",
    with_scores(
        best_sql("(recall_positive >= 0.6) desc, precision_positive desc, f1_binary desc, threshold desc", columns="model, threshold, " + r(["precision_positive", "f1_binary"])),
        *CTES,
    ),
)
def met12_objective_threshold(spark, sf):
    best = sc.objective_threshold(table(spark, sf)[0], BY, "precision")
    return rounded(best.select("model", "threshold", "precision_positive", "f1_binary"), R, ("threshold",))


@query(
    "met13_gate_status",
    with_scores(
        "select model, round(roc_auc,9) as roc_auc, round(recall_positive,9) as recall_positive, round(f1_macro,9) as f1_macro,"
        " roc_auc >= 0.75 and recall_positive >= 0.6 and f1_macro >= 0.65 as passes_gates,"
        " case when roc_auc >= 0.75 and recall_positive >= 0.6 and f1_macro >= 0.65 then 'PASS'"
        " when roc_auc >= 0.75 and recall_positive >= 0.6 then 'VALID_BUT_F1_LOW' else 'FAIL' end as status"
        " from (" + best_sql(TIERED, columns="*") + ")",
        *CTES,
    ),
)
def met13_gate_status(spark, sf):
    best = sc.best_threshold(table(spark, sf)[0], BY)
    auc, recall, f1 = F.col("roc_auc"), F.col("recall_positive"), F.col("f1_macro")
    return rounded(
        best.select("model", auc, recall, f1, sc.passes_gates(auc, recall, f1).alias("passes_gates"), sc.gate_status(auc, recall, f1).alias("status")), R
    )


@query(
    "met14_unconstrained_best",
    with_scores(
        "select model, round(arg_max(f1_binary, -pos_f),9) as max_f1_unconstrained, arg_max(threshold, -pos_f) as max_f1_unconstrained_threshold,"
        " round(arg_max(precision_positive, -pos_p),9) as max_precision_recall_gate, arg_max(threshold, -pos_p) as max_precision_recall_gate_threshold"
        " from (select *, row_number() over (partition by model order by f1_binary desc, threshold) as pos_f,"
        " row_number() over (partition by model order by (recall_positive >= 0.6) desc, precision_positive desc, f1_binary desc, threshold) as pos_p from tt)"
        " group by model",
        *CTES,
    ),
)
def met14_unconstrained_best(spark, sf):
    best = sc.unconstrained_best(table(spark, sf)[0], BY)
    return rounded(best, R, ("max_f1_unconstrained_threshold", "max_precision_recall_gate_threshold"))


@query(
    "prj8_threshold_predicate",
    with_scores("select row_id, cast(case when early_returns >= 0.25 then 1 else 0 end as integer) as y_pred from scored"),
)
def prj8_threshold_predicate(spark, sf):
    return scored_wide(spark, sf).select("row_id", pr.predict(F.col("early_returns"), 0.25).alias("y_pred"))


@query(
    "prj9_outcome_label",
    with_scores(
        "select row_id, case when Y=1 and early_returns>=0.25 then 'TP' when Y=0 and early_returns>=0.25 then 'FP'"
        " when Y=0 then 'TN' else 'FN' end as outcome from scored"
    ),
)
def prj9_outcome_label(spark, sf):
    df = scored_wide(spark, sf)
    return df.select("row_id", pr.outcome(F.col("Y"), pr.predict(F.col("early_returns"), 0.25)).alias("outcome"))


@query(
    "prj13_min_max_scores",
    with_scores(
        "select row_id, round((z-lo)/(hi-lo), 9) as score from (select row_id, X13-X19 as z, min(X13-X19) over () as lo, max(X13-X19) over () as hi from scored)"
    ),
)
def prj13_min_max_scores(spark, sf):
    df = scored_wide(spark, sf).select("row_id", F.expr("X13-X19").alias("z"))
    return rounded(pr.min_max_scores(df, "z").select("row_id", "score"), R)
