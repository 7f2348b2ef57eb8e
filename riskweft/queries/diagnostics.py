"""Diagnostic queries (DIA*)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from riskweft.operators import diagnostics as dg, neighbours as nn, projection as pr, scoring as sc, splitting as sp
from riskweft.queries.features import rounded
from riskweft.queries.metrics import BY, CTES, TIERED, best_sql, table
from riskweft.queries.quality import PROFILE_SQL, profile
from riskweft.queries.registry import query
from riskweft.queries.scores import METRIC_SQL, MODELS, scored_wide, scores_long, with_scores
from riskweft.queries.splits import RANKED_SQL, SPLIT_SQL
from riskweft.session import stage
from riskweft.sources.contract import FEATURES, SEMANTIC_NAMES
from riskweft.sources.panel import with_panel

THRESHOLD = {"delay_rule": 0.25, "age_rule": 0.2, "early_returns": 0.25}
D = 6

_OUT = "case when Y=1 and early_returns>=0.25 then 'TP' when Y=0 and early_returns>=0.25 then 'FP' when Y=0 then 'TN' else 'FN' end"
_LONG = " union all ".join(f"select {_OUT} as outcome, '{c}' as feature, cast({c} as double) as v from scored" for c in FEATURES)
_SIDE = (
    "sides as (select outcome, feature, count(*) as n, avg(v) as mean, stddev_samp(v) as std, quantile_cont(v,0.25) as q25,"
    f" quantile_cont(v,0.5) as q50, quantile_cont(v,0.75) as q75 from ({_LONG}) where outcome <> 'TN' group by 1, 2)"
)
_NAMES = "names as (select * from (values " + ", ".join(f"('{c}', '{SEMANTIC_NAMES[c]}')" for c in FEATURES) + ") t(feature, semantic_name))"


def _contrast(name, left, right):
    mean_tp = "r.mean" if right == "TP" else "l.mean"
    mean_fp = "l.mean" if left == "FP" else "0.0"
    pooled = "sqrt((l.std*l.std + r.std*r.std)/2)"
    quart = ", ".join(f"round({s}.{q}, {D}) as {q}_{n}" for s, n in (("l", "left"), ("r", "right")) for q in ("q25", "q50", "q75"))
    return (
        f"select '{name}' as comparison, l.feature, semantic_name, '{left}' as left_label, '{right}' as right_label, l.n as left_count, r.n as right_count,"
        f" round(l.mean,{D})+0.0 as left_mean, round(r.mean,{D})+0.0 as right_mean, round({mean_tp},{D})+0.0 as mean_tp, round({mean_fp},{D})+0.0 as mean_fp,"
        f" round(l.q50,{D})+0.0 as median_left, round(r.q50,{D})+0.0 as median_right, round(l.std,{D}) as std_left, round(r.std,{D}) as std_right,"
        f" round(abs(l.mean-r.mean),{D}) as absolute_mean_difference,"
        f" round(case when {pooled} > 1e-12 then (r.mean-l.mean)/{pooled} else 0.0 end,{D})+0.0 as standardized_mean_difference, {quart}"
        f" from sides l join sides r on l.feature=r.feature and l.outcome='{left}' and r.outcome='{right}' join names on names.feature=l.feature"
    )


@query("dia1_error_contrast", with_scores(" union all ".join(_contrast(*c) for c in dg.CONTRASTS), _SIDE, _NAMES))
def dia1_error_contrast(spark, sf):
    df = scored_wide(spark, sf)
    marked = df.select(*FEATURES, pr.outcome(F.col("Y"), pr.predict(F.col("early_returns"), 0.25)).alias("outcome"))
    return rounded(dg.error_contrast(stage(marked, "outcome"), FEATURES), D)


_PRED_SQL = "pred as (select row_id, Y as label, " + ", ".join(f"{m} >= {t} as {m}" for m, t in THRESHOLD.items()) + " from scored)"


def _overlap(a, b):
    c = "count(*) filter (where {})"
    return (
        f"select '{a}' as model_a, '{b}' as model_b, {c.format(f'label=0 and {a} and {b}')} as shared_fp,"
        f" {c.format(f'label=0 and {a} and not {b}')} as exclusive_fp_a, {c.format(f'label=0 and {b} and not {a}')} as exclusive_fp_b,"
        f" {c.format(f'label=1 and not {a} and not {b}')} as shared_fn, {c.format(f'label=1 and not {a} and {b}')} as exclusive_fn_a,"
        f" {c.format(f'label=1 and not {b} and {a}')} as exclusive_fn_b from pred"
    )


def predicted_long(spark, sf):
    threshold = F.create_map(*[F.lit(v) for kv in THRESHOLD.items() for v in kv])[F.col("model")]
    return scores_long(spark, sf).withColumn("predicted", pr.predict(F.col("score"), threshold))


@query("dia2_error_overlap", with_scores(" union all ".join(_overlap(a, b) for a, b in combinations(MODELS, 2)), _PRED_SQL))
def dia2_error_overlap(spark, sf):
    return dg.error_overlap(dg.predictions_wide(predicted_long(spark, sf), MODELS), MODELS)


_RANKS_SQL = "ranked as (select " + ", ".join(
    f"{m}, rank() over (order by {m}) + (count(*) over (partition by {m}) - 1) / 2.0 as r_{m}" for m in MODELS
) + " from scored)"


@query(
    "dia3_score_correlation",
    with_scores(
        " union all ".join(
            f"select '{a}' as model_a, '{b}' as model_b, round(corr({a}, {b}), 9) as pearson, round(corr(r_{a}, r_{b}), 9) as spearman from ranked"
            for a, b in combinations(MODELS, 2)
        ),
        _RANKS_SQL,
    ),
)
def dia3_score_correlation(spark, sf):
    return rounded(dg.score_correlation(stage(scores_long(spark, sf), "scores"), MODELS), 9)


_DUP = ["SEX", "EDUCATION", "MARRIAGE", "PAY_0", "PAY_2", "SEGMENT"]


@query(
    "dia4_duplicate_groups",
    with_panel(
        "select count(*) filter (where n > 1) as exact_duplicate_feature_groups, count(*) filter (where n > 1 and d > 1) as conflicting_label_duplicate_groups"
        f" from (select count(*) as n, count(distinct Y) as d from profile group by {', '.join(_DUP)})",
        PROFILE_SQL,
    ),
)
def dia4_duplicate_groups(spark, sf):
    return dg.duplicate_groups(profile(spark, sf), _DUP)


def _neighbour_sql(rank: int) -> str:
    return f"""with cells as (select vec_id, label, unnest(embedding) as v, unnest(range(len(embedding))) as i from embeddings),
      stats as (select i, avg(cast(v as double)) as m, stddev_samp(cast(v as double)) as s from cells group by i),
      vecs as (select vec_id, label, list((cast(v as double)-m)/(case when s=0 then 1 else s end) order by cells.i) as vec
               from cells join stats on stats.i = cells.i group by vec_id, label),
      near as (select a.vec_id, a.label, b.label as other,
                 row_number() over (partition by a.vec_id order by list_distance(a.vec, b.vec), b.vec_id) as r
               from vecs a join vecs b on a.vec_id <> b.vec_id)
      select count(*) as rows, cast(sum(case when label <> other then 1 else 0 end) as bigint) as opposite,
        round(avg(case when label <> other then 1.0 else 0.0 end), 9) as opposite_rate from near where r = {rank}"""


def _register_neighbours(name: str, rank: int, pivots: int | None = None) -> None:
    @query(name, _neighbour_sql(rank))
    def run(spark, sf):
        df = spark.read.parquet(f"{sf}/embeddings.parquet")
        vectors = nn.standardize_array(df, "embedding", ("vec_id", "label"))
        return rounded(nn.opposite_label_rate(vectors, "vec_id", "label", "vec", rank, pivots=pivots), 9)


for _rank in (1, 2):
    _register_neighbours(f"dia5_opposite_label_rate_{_rank}", _rank)
# With pivots, the search leaves out cells by the triangle inequality.
_register_neighbours("dia5_opposite_label_rate_pruned", 2, 8)


_PCT = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}


@query(
    "dia6_score_overlap",
    with_scores(
        "select " + ", ".join(
            f"(select round(quantile_cont(delay_rule, {p}), 9) from scored where Y={c}) as {n}_{k}"
            for c, n in ((0, "negative"), (1, "positive")) for k, p in _PCT.items()
        )
        + ", (select round(avg(case when delay_rule >= (select quantile_cont(delay_rule, 0.5) from scored where Y=1) then 1.0 else 0.0 end), 9) from scored where Y=0)"
        " as negative_above_positive_median, (select round(avg(case when delay_rule <= (select quantile_cont(delay_rule, 0.5) from scored where Y=0) then 1.0"
        " else 0.0 end), 9) from scored where Y=1) as positive_below_negative_median"
    ),
)
def dia6_score_overlap(spark, sf):
    df = stage(scored_wide(spark, sf).select("Y", "delay_rule"), "scores")
    return rounded(dg.score_overlap(df, "Y", "delay_rule"), 9)


@query(
    "dia7_hard_negative_analysis",
    with_scores(
        " union all ".join(
            f"select '{n}' as definition, round(min(delay_rule), 9) as score_cutoff, count(*) as hard_negative_count,"
            f" round(count(*)/cast((select count(*) from scored where Y=0) as double), 9) as negative_percentage, round(avg(delay_rule), 9) as mean_score,"
            f" round(quantile_cont(delay_rule, 0.5), 9) as median_score from scored where Y=0 and delay_rule >="
            f" (select quantile_cont(delay_rule, {1.0 - q}) from scored where Y=0)"
            for n, q in dg.HARD_SHARES.items()
        )
    ),
)
def dia7_hard_negative_analysis(spark, sf):
    df = stage(scored_wide(spark, sf).select("Y", "delay_rule"), "scores")
    return rounded(dg.hard_negative_analysis(df, "Y", "delay_rule"), 9)


@query(
    "dia8_precision_needed",
    with_scores(
        "select model, round(recall_positive, 9) as recall, round(case when 2*recall_positive-0.65 <> 0 then 0.65*recall_positive/(2*recall_positive-0.65) end, 6)"
        " as precision_needed from (" + best_sql(TIERED, columns="*") + ")",
        *CTES,
    ),
)
def dia8_precision_needed(spark, sf):
    best = sc.best_threshold(table(spark, sf)[0], BY)
    recall = F.col("recall_positive")
    return best.select("model", F.round(recall, 9).alias("recall"), F.round(dg.precision_needed(recall), 6).alias("precision_needed"))


_METRICS = ["roc_auc", "precision_positive", "recall_positive", "f1_binary", "threshold"]
_BEST = f"best as ({best_sql(TIERED, columns='*')})"


@query(
    "dia9_baseline_reconciliation",
    with_scores(
        " union all ".join(
            f"select a.model, '{m}' as metric, round(b.{m}, 9) as official, round(a.{m}, 9) as reproduced, round(a.{m} - b.{m}, 9) + 0.0 as difference"
            " from best a join best b on b.model = 'delay_rule' where a.model <> 'delay_rule'"
            for m in _METRICS
        ),
        *CTES, _BEST,
    ),
)
def dia9_baseline_reconciliation(spark, sf):
    """Every model against the delay rule, which stands for the official baseline."""
    best = stage(sc.best_threshold(table(spark, sf)[0], BY), "best")
    rows = dg.metric_rows(best, _METRICS, ["model"])
    official = rows.where("model = 'delay_rule'").drop("model")
    out = dg.metric_difference(official, rows.where("model <> 'delay_rule'"), "official", "reproduced", "difference")
    return rounded(out, 9)


_SPLIT_SCORES = "scores as (select split as model, row_id, Y as label, early_returns as score from scored)"
SPLIT_SCORED = [RANKED_SQL, SPLIT_SQL, "scored as (select *, round(1.0/(1.0+exp(cast(-(-3.0 + 7.0*early_share) as double))), 6) as early_returns from split_table)", _SPLIT_SCORES]
_FIXED = (
    f"fixed as (select *, {METRIC_SQL} from (select model, cast(sum(case when label=0 and score<0.25 then 1 else 0 end) as bigint) as tn,"
    " cast(sum(case when label=0 and score>=0.25 then 1 else 0 end) as bigint) as fp, cast(sum(case when label=1 and score<0.25 then 1 else 0 end) as bigint) as fn,"
    " cast(sum(case when label=1 and score>=0.25 then 1 else 0 end) as bigint) as tp from scores group by model) join rank_metrics using (model))"
)
_FROZEN = ["roc_auc", "precision_positive", "recall_positive", "f1_binary", "f1_macro", "f1_weighted"]


def split_metrics(spark, sf):
    """Metrics of the early-return score per split at the frozen threshold 0.25."""
    df = stage(scored_wide(spark, sf).select("row_id", "Y", "early_returns"), "scores")
    split = sp.stratified_split(df)
    return sc.evaluate(split, 0.25, ["split"], "Y", "early_returns")


@query(
    "dia10_validation_test_delta",
    with_panel(
        " union all ".join(
            f"select '{m}' as metric, round(v.{m}, 9) as validation, round(t.{m}, 9) as test, round(t.{m} - v.{m}, 9) + 0.0 as delta_test_minus_validation"
            " from fixed v join fixed t on v.model='validation' and t.model='test'"
            for m in _FROZEN
        ),
        *SPLIT_SCORED, *CTES[:4], _FIXED,
    ),
)
def dia10_validation_test_delta(spark, sf):
    rows = dg.metric_rows(stage(split_metrics(spark, sf), "metrics"), _FROZEN, ["split"])
    validation, test = (rows.where(F.col("split") == s).drop("split") for s in ("validation", "test"))
    return rounded(dg.metric_difference(validation, test, "validation", "test", "delta_test_minus_validation"), 9)


@query(
    "dia11_reproduction_check",
    with_panel(
        " union all ".join(
            f"select '{m}' as metric, round(t.{m}, 9) as reproduced, round(v.{m}, 9) as reference, round(abs(t.{m} - v.{m}), 9) as absolute_difference,"
            f" case when abs(t.{m} - v.{m}) <= 0.01 then 'PASS' else 'REVIEW' end as status from fixed v join fixed t on v.model='train' and t.model='test'"
            for m in _FROZEN
        ),
        *SPLIT_SCORED, *CTES[:4], _FIXED,
    ),
)
def dia11_reproduction_check(spark, sf):
    rows = dg.metric_rows(stage(split_metrics(spark, sf), "metrics"), _FROZEN, ["split"])
    expected, actual = (rows.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    return rounded(dg.reproduction_check(actual, expected), 9)
