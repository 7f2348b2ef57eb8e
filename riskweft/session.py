"""Session defaults and the one place that cuts lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

_LOCAL_ROOTS: dict[str, str] = {}
_STAGED: dict[str, list[str]] = {}


def build_session(app: str = "riskweft", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators expect; a cluster may override any of them."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording the Python call site of every column operation costs more than building the plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def side_by_side(spark: SparkSession, calls: Iterable[Callable[[], T]], parallelism: int = 4) -> list[T]:
    """Results of independent calls in their order; a few run at a time, since planning and short jobs leave most cores idle."""
    with ThreadPoolExecutor(parallelism) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(c)) for c in calls]]


def staging_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir.

    Only a local[*] session, whose driver and tasks share one disk, falls back
    to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    context = spark.sparkContext
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that every executor can reach.")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="riskweft-stage-")
        context.setCheckpointDir(_LOCAL_ROOTS[app])
    return _LOCAL_ROOTS[app]


def staging_path(spark: SparkSession, label: str) -> str:
    return os.path.join(staging_root(spark), f"{label}-{uuid.uuid4().hex}")


def stage(df: DataFrame, label: str = "stage", folders: Sequence[str] = ()) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back.

    Later passes scan only the columns they need, and a lost executor costs a
    re-read of files, not a recomputation of the lineage. With folders, a pass
    that filters on these columns reads only its own files.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    writer = df.write.partitionBy(*folders) if folders else df.write
    writer.parquet(path)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def release(table: DataFrame) -> None:
    """Delete one staged table before the others, when nothing will read it any more."""
    spark = table.sparkSession
    _STAGED[spark.sparkContext.applicationId].remove(table.staged_path)
    _delete(spark, table.staged_path)


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables that this application has staged; call it when their results have been read. Returns how many went."""
    return sum(_delete(spark, path) for path in _STAGED.pop(spark.sparkContext.applicationId, []))


def _delete(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True))
