"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the engine relies on; applied only when building a new session.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "sprout") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session. Only a local-mode session (tests) without one gets a fresh scratch folder; on a
    cluster a machine-local folder would not survive a lost executor, so the setting is required there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = d.get() if d.isDefined() else None
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's distributed store)")
        d = tempfile.mkdtemp(prefix="sprout-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


BROADCAST_BYTES = 32 << 20


def broadcast_below(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only if the counted rows times ``row_bytes`` stay below ``limit``; else the planner's choice."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder (one per call, never reused)."""
    base = shared_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame's rows, computed now and read from compressed files in the shared folder; the shuffle files of making them go at once."""
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_path = path
    return out


def drop_path(df: DataFrame) -> None:
    """Deletes the files of a frame from ``kept`` that nothing reads any more."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.kept_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
