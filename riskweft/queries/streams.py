"""Streaming queries: the stream result of a finite input, its open windows closed, equals its batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.queries.modeling import scorer
from riskweft.queries.monitoring import VALID_TYPES, _K, order_labels, order_scores, quality_conditions
from riskweft.queries.registry import query
from riskweft.session import staging_path
from riskweft.streaming import monitor as st


def _drained(spark, df):
    path = staging_path(spark, "stream")
    st.drain(df, path, staging_path(spark, "checkpoint"))
    return spark.read.schema(df.schema).parquet(path)


@query(
    "mon7_stream_quality",
    f"select cast(period_start as date) as day, rows, missing, invalid, broken from (select date_trunc('day', ts) as period_start, count(*) as rows,"
    f" count(*) filter (where {_K} is null or {_K} % 10 = 0) as missing, count(*) filter (where value < 0.0 or value > 200.0) as invalid,"
    f" count(*) filter (where event_type not in {VALID_TYPES}) as broken from events group by 1)",
)
def mon7_stream_quality(spark, sf):
    path = f"{sf}/events.parquet"
    events = spark.read.parquet(path)
    make = lambda df: st.quality_stream(df, "ts", *quality_conditions())
    closed = _drained(spark, make(st.read_stream(spark, st.table_glob(path), events.schema)))
    return st.close_windows(closed, events, make, "ts").select(F.to_date("period_start").alias("day"), "rows", "missing", "invalid", "broken")


@query(
    "mon7_stream_predictions",
    "select cast(period_start as date) as day, bin, rows, positives from (select date_trunc('day', ts) as period_start,"
    " cast(least(9, floor(least(value/500.0, 1.0)*10)) as integer) as bin, count(*) as rows, count(*) filter (where least(value/500.0, 1.0) >= 0.2) as positives"
    " from events group by 1, 2)",
)
def mon7_stream_predictions(spark, sf):
    path = f"{sf}/events.parquet"
    events = spark.read.parquet(path)
    make = lambda df: st.prediction_stream(df.withColumn("score", F.least(F.col("value") / 500.0, F.lit(1.0))), "ts", "score", 0.2)
    closed = _drained(spark, make(st.read_stream(spark, st.table_glob(path), events.schema)))
    return st.close_windows(closed, events, make, "ts").select(F.to_date("period_start").alias("day"), "bin", "rows", "positives")


@query(
    "mon7_late_labels",
    "select strftime(o_orderdate, '%Y-%m') as period, count(*) as rows, cast(sum(label) as bigint) as positives from orders join"
    " (select l_orderkey, case when avg(case when l_returnflag='R' or l_quantity > 40 then 1.0 else 0.0 end) >= 0.45 then 1 else 0 end as label"
    " from lineitem group by 1) on l_orderkey = o_orderkey group by 1",
)
def mon7_late_labels(spark, sf):
    """Predictions and labels as two streams, joined inside the waiting time."""
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", F.col("o_orderdate").alias("predicted_at"))
    predictions = order_scores(spark, sf).join(orders, "o_orderkey")
    labels = order_labels(spark, sf).join(orders, "o_orderkey").select("o_orderkey", "label", F.expr("predicted_at + interval 30 days").alias("labelled_at"))
    paths = []
    for name, df in (("predictions", predictions), ("labels", labels)):
        path = staging_path(spark, name)
        df.write.parquet(path)
        paths.append((path, df.schema))
    left, right = (st.read_stream(spark, p, s) for p, s in paths)
    joined = _drained(spark, st.late_labels(left, right, "o_orderkey", "predicted_at", "labelled_at", "60 days"))
    return joined.groupBy("period").agg(F.count(F.lit(1)).alias("rows"), F.sum("label").alias("positives"))


@query("prd2_predict_stream")
def prd2_predict_stream(spark, sf):
    model, data = scorer(spark, sf)
    records = data.drop("Y", "split")
    path = staging_path(spark, "records")
    records.write.parquet(path)
    out = staging_path(spark, "predictions")
    model.predict_stream(st.read_stream(spark, path, records.schema), out, staging_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema("row_id bigint, probability double, predicted_class int, threshold double").parquet(out)
