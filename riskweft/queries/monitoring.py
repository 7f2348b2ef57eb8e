"""Monitoring queries (MON*) on events, lineitem and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.operators import monitoring as mo
from riskweft.queries.features import rounded
from riskweft.queries.registry import query
from riskweft.queries.scores import METRIC_SQL, threshold_ctes

R = 9
VALID_TYPES = ("click", "view", "purchase")


def quality_conditions():
    """Missing: no k in the properties. Invalid: value outside (0, 200]. Broken: event type outside the agreed list."""
    k = F.get_json_object("props", "$.k").cast("int")
    return (k.isNull() | (k % 10 == 0)), ~F.col("value").between(0.0, 200.0), ~F.col("event_type").isin(*VALID_TYPES)


_K = "cast(json_extract_string(props, '$.k') as integer)"


@query(
    "mon1_quality_by_day",
    f"select cast(ts as date) as day, count(*) as rows, round(avg(case when {_K} is null or {_K} % 10 = 0 then 1.0 else 0.0 end), 9) as missing_rate,"
    " round(avg(case when value < 0.0 or value > 200.0 then 1.0 else 0.0 end), 9) as invalid_rate,"
    f" round(avg(case when event_type not in {VALID_TYPES} then 1.0 else 0.0 end), 9) as schema_failure_rate from events group by 1",
)
def mon1_quality_by_day(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("day", F.to_date("ts"))
    return rounded(mo.quality_by_period(events, "day", *quality_conditions()), R)


DRIFT = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CUT = "1999-01-01"
_DRIFT_LONG = "long as (" + " union all ".join(
    f"select '{c}' as feature, {c} as v, l_shipdate >= timestamp '{CUT}' as now from lineitem" for c in DRIFT
) + ")"
_PSI_EDGES = "list_sort(list_distinct([" + ", ".join(f"quantile_cont(v, {i}/10.0)" for i in range(1, 10)) + "]))"


@query(
    "mon2_psi",
    f"""with {_DRIFT_LONG}, edges as (select feature, {_PSI_EDGES} as e from long where not now group by feature),
      binned as (select long.feature, len(list_filter(e, lambda x: x < v)) as bin, sum(case when now then 0 else 1 end) as b, sum(case when now then 1 else 0 end) as c
                 from long join edges using (feature) group by 1, 2),
      shares as (select feature, greatest(b/cast(sum(b) over (partition by feature) as double), 1e-6) as p,
                 greatest(c/cast(sum(c) over (partition by feature) as double), 1e-6) as q from binned)
      select feature, round(sum((q-p)*ln(q/p)), 9) as psi from shares group by feature""",
)
def mon2_psi(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_shipdate", *DRIFT)
    return rounded(mo.psi(lines, DRIFT, F.col("l_shipdate") >= F.lit(CUT).cast("timestamp_ntz")), R)


@query(
    "mon3_ks_distance",
    f"""with {_DRIFT_LONG}, folded as (select feature, v, sum(case when now then 0 else 1 end) as b, sum(case when now then 1 else 0 end) as c from long group by 1, 2),
      cum as (select feature, sum(b) over w / cast(sum(b) over (partition by feature) as double) as fb, sum(c) over w / cast(sum(c) over (partition by feature) as double) as fc
              from folded window w as (partition by feature order by v))
      select feature, round(max(abs(fb-fc)), 9) as ks from cum group by feature""",
)
def mon3_ks_distance(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_shipdate", *DRIFT)
    return rounded(mo.ks_distance(lines, DRIFT, F.col("l_shipdate") >= F.lit(CUT).cast("timestamp_ntz")), R)


SCORE = "round(1.0/(1.0+exp(cast(-((o_totalprice-250000.0)/100000.0) as double))), 6)"
_SCORED = f"scored as (select o_orderkey, strftime(o_orderdate, '%Y-%m') as period, {SCORE} as score from orders)"


def order_scores(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("period"), F.expr(SCORE).alias("score"))


def order_labels(spark, sf):
    """An order's label arrives with its lines: 1 when at least 45 % of them came back or are large."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    late = F.avg(F.when((F.col("l_returnflag") == "R") | (F.col("l_quantity") > 40), 1.0).otherwise(0.0))
    return lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.when(late >= 0.45, 1).otherwise(0).alias("label"))


@query(
    "mon4_prediction_drift",
    f"with {_SCORED} select period, cast(least(9, floor(score*10)) as integer) as bin, count(*) as rows, count(*) filter (where score >= 0.6) as positives from scored group by 1, 2",
)
def mon4_prediction_drift(spark, sf):
    return mo.prediction_drift(order_scores(spark, sf), "period", "score", 0.6)


@query(
    "mon4_positive_rate",
    f"with {_SCORED} select period, count(*) as rows, round(avg(case when score >= 0.6 then 1.0 else 0.0 end), 9) as predicted_positive_rate from scored group by 1",
)
def mon4_positive_rate(spark, sf):
    return rounded(mo.positive_rate(mo.prediction_drift(order_scores(spark, sf), "period", "score", 0.6), "period"), R)


_PERF = [
    _SCORED,
    "labels_in as (select l_orderkey, case when avg(case when l_returnflag='R' or l_quantity > 40 then 1.0 else 0.0 end) >= 0.45 then 1 else 0 end as label"
    " from lineitem group by 1)",
    "scores as (select period, score, label from scored join labels_in on o_orderkey = l_orderkey)",
    *threshold_ctes("scores", "period")[:4],
    "fixed as (select period, cast(sum(case when label=0 and score<0.6 then 1 else 0 end) as bigint) as tn, cast(sum(case when label=0 and score>=0.6 then 1 else 0 end) as bigint) as fp,"
    " cast(sum(case when label=1 and score<0.6 then 1 else 0 end) as bigint) as fn, cast(sum(case when label=1 and score>=0.6 then 1 else 0 end) as bigint) as tp from scores group by 1)",
    f"perf as (select fixed.*, {METRIC_SQL}, roc_auc from fixed join rank_metrics using (period))",
]


def performance(spark, sf):
    return mo.realised_performance(order_scores(spark, sf), order_labels(spark, sf), "o_orderkey", "period", 0.6)


_PCOLS = ["roc_auc", "f1_binary", "f1_macro", "recall_positive", "precision_positive"]


@query(
    "mon5_realised_performance",
    "with " + ",\n".join(_PERF) + " select period, tn, fp, fn, tp, " + ", ".join(f"round({c}, 9) as {c}" for c in _PCOLS) + " from perf",
)
def mon5_realised_performance(spark, sf):
    return rounded(performance(spark, sf), R)


@query(
    "mon6_persistent_alerts",
    "with " + ",\n".join([
        *_PERF,
        "rows_long as (select period, 'roc_auc' as metric, roc_auc as value, coalesce(roc_auc < 0.75, true) as below from perf"
        " union all select period, 'recall', recall_positive, recall_positive < 0.6 from perf union all select period, 'f1_macro', f1_macro, f1_macro < 0.65 from perf)",
        "islands as (select *, count(*) filter (where not below) over (partition by metric order by period rows unbounded preceding) as island from rows_long)",
    ])
    + " select metric, min(period) as first_period, max(period) as last_period, count(*) as periods, round(min(value), 9) as worst from islands where below"
    " group by metric, island having count(*) >= 3",
)
def mon6_persistent_alerts(spark, sf):
    return rounded(mo.persistent_alerts(mo.gate_breaches(performance(spark, sf), "period"), "period"), R)
