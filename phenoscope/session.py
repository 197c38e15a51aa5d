"""Session helpers: configuration for scale, the shared checkpoint folder and a
size-checked broadcast."""

from __future__ import annotations

import contextlib
import contextvars
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Sides smaller than this many rows are broadcast by ``broadcast_if_small``.
# A row of a term set or a feature dictionary is tens of bytes, so this keeps a
# broadcast well under the default 10 MB threshold at any data scale.
DEFAULT_BROADCAST_ROWS = 200_000


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "phenoscope", extra: dict | None = None) -> SparkSession:
    """Session with the settings the operators are designed for.

    AQE re-plans joins from runtime sizes, coalesces small shuffle partitions
    and splits skewed join partitions; the UI stays off.
    """
    b = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
    )
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = 256 << 20,
                           minimum: int = 8) -> int:
    """Initial shuffle partition count for a stage writing ``shuffle_bytes``.

    AQE coalesces small partitions afterwards, so the initial count only has
    to be high enough that no reduce partition outgrows executor memory: about
    one partition per ``target_bytes`` of shuffled data.  Map-side combining
    makes the shuffle of the cohort and feature aggregates far smaller than the
    scanned input.
    """
    return max(minimum, -(-int(shuffle_bytes) // int(target_bytes)))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Where it is unset, a folder under the
    warehouse folder serves, which all executors share as well.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_phenoscope_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return _registered(os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}"))


# The folders of the innermost open scratch scope.
_SCRATCH: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


def _registered(path: str) -> str:
    folders = _SCRATCH.get()
    if folders is not None:
        folders.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Removes every scratch folder and checkpoint made inside when it ends, also on
    failure.  What leaves the scope must not read them any more: collect it, or write it
    elsewhere.  Threads of ``run_concurrently`` belong to the scope they were started in."""
    folders: list[str] = []
    token = _SCRATCH.set(folders)
    try:
        yield folders
    finally:
        _SCRATCH.reset(token)
        for path in folders:
            remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on its file system, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared checkpoint folder.

    Unlike a local checkpoint, the written blocks survive the loss of the
    executor that computed them.
    """
    checkpoint_root(df.sparkSession)
    out = df.checkpoint(eager=True)
    if _SCRATCH.get() is not None:
        _registered(out._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get())
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, written as Parquet to the shared checkpoint folder and reread:
    for rows that several steps read, where their order does not matter."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only after checking that it has at most ``max_rows`` rows.

    The check is one cheap action (a ``limit`` count).  Beyond the bound the
    frame is returned as is and the planner (with AQE) picks a shuffle join.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system (local, HDFS, object store),
    checked through Hadoop's FileSystem API as Spark's own readers do."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))
