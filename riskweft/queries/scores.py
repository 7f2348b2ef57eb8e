"""Deterministic scores over the panel, as input for the metric operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskweft.sources.panel import panel, with_panel

MODELS = ("delay_rule", "age_rule", "early_returns")

# The same text is valid in both engines.
Z = {
    "delay_rule": "-1.2 + 0.25*(X8+X9+X10+X11)/4.0 + 0.3*(case when X1 < 3000 then 1 else 0 end) + 0.000001*(X13-X19)",
    "age_rule": "-1.5 + 0.02*(X5-50) + 0.1*X9 - 0.0000008*X20",
    "early_returns": "-3.0 + 7.0*early_share",
}


def _score(text: str) -> str:
    return f"round(1.0/(1.0+exp(cast(-({text}) as double))), 6)"


SCORED_SQL = "scored as (select *, " + ", ".join(f"{_score(z)} as {name}" for name, z in Z.items()) + " from panel)"
SCORES_SQL = "scores as (" + " union all ".join(f"select '{m}' as model, row_id, Y as label, {m} as score from scored" for m in MODELS) + ")"


def scored_wide(spark, sf) -> DataFrame:
    """Panel columns plus one score column per model."""
    return panel(spark, sf, extra=True).selectExpr("*", *[f"{_score(z)} as {name}" for name, z in Z.items()])


def scores_long(spark, sf) -> DataFrame:
    """(model, row_id, label, score)."""
    wide = scored_wide(spark, sf).select("row_id", F.col("Y").alias("label"), *MODELS)
    return wide.unpivot(["row_id", "label"], list(MODELS), "model", "score")


def with_scores(body: str, *ctes: str) -> str:
    return with_panel(body, SCORED_SQL, SCORES_SQL, *ctes)


# Threshold table by model, from the scores CTE.
METRIC_SQL = """
  coalesce(cast(tp as double)/nullif(tp+fp,0),0.0) as precision_positive,
  coalesce(cast(tp as double)/nullif(tp+fn,0),0.0) as recall_positive,
  coalesce(2.0*tp/nullif(2*tp+fp+fn,0),0.0) as f1_binary,
  coalesce(2.0*tp/nullif(2*tp+fp+fn,0),0.0) as f1_binary_default_1,
  coalesce(2.0*tn/nullif(2*tn+fp+fn,0),0.0) as f1_class_0,
  (coalesce(2.0*tn/nullif(2*tn+fp+fn,0),0.0)+coalesce(2.0*tp/nullif(2*tp+fp+fn,0),0.0))/2 as f1_macro,
  (coalesce(2.0*tn/nullif(2*tn+fp+fn,0),0.0)*(tn+fp)+coalesce(2.0*tp/nullif(2*tp+fp+fn,0),0.0)*(fn+tp))/(tn+fp+fn+tp) as f1_weighted,
  cast(tn+tp as double)/(tn+fp+fn+tp) as micro_f1,
  (coalesce(2.0*tn/nullif(2*tn+fp+fn,0),0.0)+coalesce(2.0*tp/nullif(2*tp+fp+fn,0),0.0))/2 as official_a1_f1,
  cast(tn+tp as double)/(tn+fp+fn+tp) as accuracy,
  coalesce(cast(tn as double)/nullif(tn+fp,0),0.0) as specificity,
  (coalesce(cast(tp as double)/nullif(tp+fn,0),0.0)+coalesce(cast(tn as double)/nullif(tn+fp,0),0.0))/2 as balanced_accuracy,
  cast(fn+tp as double)/(tn+fp+fn+tp) as target_positive_prevalence,
  cast(fp+tp as double)/(tn+fp+fn+tp) as predicted_positive_prevalence"""
METRIC_NAMES = (
    "precision_positive recall_positive f1_binary f1_binary_default_1 f1_class_0 f1_macro f1_weighted micro_f1 official_a1_f1 "
    "accuracy specificity balanced_accuracy target_positive_prevalence predicted_positive_prevalence"
).split()


def threshold_ctes(source: str = "scores", group: str = "model") -> list[str]:
    """CTEs folded, totals, cum, rank_metrics, counts, tt (threshold table) for a grouped score table."""
    return [
        f"folded as (select {group}, score, cast(sum(case when label=1 then 1 else 0 end) as bigint) as pos,"
        f" cast(sum(case when label=1 then 0 else 1 end) as bigint) as neg from {source} group by {group}, score)",
        f"totals as (select {group}, cast(sum(pos) as bigint) as np, cast(sum(neg) as bigint) as nn from folded group by {group})",
        f"cum as (select folded.*, np, nn, cast(sum(pos) over (partition by {group} order by score desc) as bigint) as ctp,"
        f" cast(sum(neg) over (partition by {group} order by score desc) as bigint) as cfp from folded join totals using ({group}))",
        f"rank_metrics as (select {group}, sum(cast(pos as double)*(2*(nn-cfp)+neg))/nullif(2.0*max(np)*max(nn), 0) as roc_auc,"
        f" sum(pos*(cast(ctp as double)/(ctp+cfp)))/nullif(max(np), 0) as average_precision from cum group by {group})",
        f"cand as (select distinct {group}, round_even(score*1000000.0, 0)/1000000.0 as threshold from {source}"
        f" union select {group}, 0.5 from totals)",
        f"counts as (select cand.{group}, cand.threshold, nn-coalesce(cfp,0) as tn, coalesce(cfp,0) as fp,"
        f" t.np-coalesce(ctp,0) as fn, coalesce(ctp,0) as tp from cand asof left join (select {group}, score, ctp, cfp from cum) c"
        f" on cand.{group} = c.{group} and cand.threshold <= c.score join totals t on t.{group} = cand.{group})".replace("nn-coalesce", "t.nn-coalesce"),
        f"tt as (select counts.*, {METRIC_SQL}, roc_auc, abs(threshold-0.5) as near from counts join rank_metrics using ({group}))",
    ]
