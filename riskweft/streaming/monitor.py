"""Structured Streaming forms of the monitoring operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, path: str, schema, glob: str | None = None, fmt: str = "parquet") -> DataFrame:
    """File stream with an explicit schema; glob picks files inside the folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def table_glob(path: str) -> str:
    """A pattern that matches this table only; a file and a folder of part files are then read alike."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermarks need a zoned timestamp, so zone-free ones are cast first."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def quality_stream(events: DataFrame, time: str, missing: Column, invalid: Column, broken: Column, delay: str = "1 day", width: str = "1 day") -> DataFrame:
    """(period_start, rows, missing, invalid, broken) per tumbling window; state is one row per open window."""
    counted = event_time(events, time, delay).groupBy(F.window(time, width)).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("missing"), F.count_if(invalid).alias("invalid"), F.count_if(broken).alias("broken")
    )
    return counted.select(F.col("window.start").alias("period_start"), "rows", "missing", "invalid", "broken")


def prediction_stream(scored: DataFrame, time: str, score: str, threshold: float, delay: str = "1 day", width: str = "1 day", bins: int = 10) -> DataFrame:
    """(period_start, bin, rows, positives): score histogram per tumbling window."""
    place = F.least(F.lit(bins - 1), F.floor(F.col(score) * bins)).cast("int")
    counted = event_time(scored, time, delay).groupBy(F.window(time, width), place.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(score) >= threshold).alias("positives")
    )
    return counted.select(F.col("window.start").alias("period_start"), "bin", "rows", "positives")


def close_windows(closed: DataFrame, events: DataFrame, make: Callable[[DataFrame], DataFrame], time: str, width: str = "1 day") -> DataFrame:
    """What the stream has written, and a batch pass over the windows after its last one, which were still open when it stopped.

    make is the stream's own aggregation: without a stream, the watermark has no effect.
    """
    end = closed.agg(F.max(F.col("period_start") + F.expr(f"interval {width}"))).scalar()
    rest = events.where(end.isNull() | (F.col(time).cast("timestamp") >= end))
    return closed.unionByName(make(rest))


def late_labels(predictions: DataFrame, labels: DataFrame, key: str, time: str, label_time: str, wait: str = "200 days") -> DataFrame:
    """Stream-stream join of predictions with labels that arrive within wait; older state is dropped by the watermarks."""
    left = event_time(predictions, time, wait)
    right = event_time(labels.withColumnRenamed(key, "_key"), label_time, wait)
    on_time = F.col(label_time).between(F.col(time) - F.expr(f"interval {wait}"), F.col(time) + F.expr(f"interval {wait}"))
    return left.join(right, (F.col(key) == F.col("_key")) & on_time).drop("_key")


def drain(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run everything available into a Parquet table and stop; the checkpoint makes a restart go on where it ended."""
    query = (
        df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
