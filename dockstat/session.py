"""Spark session defaults and the shared working folder.

All timestamps in this library are UTC instants, so the session time zone
is pinned to UTC.  Adaptive query execution stays on so that join
strategies, partition counts and skewed partitions are re-planned from
runtime statistics instead of compile-time guesses.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partitions of ~256 MiB: scan splits, and AQE coalesces shuffle output to
    # this size (start from a high spark.sql.shuffle.partitions on a cluster,
    # about the largest shuffle's bytes / 256 MiB).
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "dockstat",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    use_utc(spark)
    checkpoint_root(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin the runtime time zone; dates and hours are derived in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever the deployment names in
    ``spark.checkpoint.dir`` (or set on the context); without it the call
    fails rather than fall back to a machine-local folder.  Only a local
    master (tests) gets a private temporary folder when neither is set.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                               "(checkpoints and staged tables are written there)")
        path = tempfile.mkdtemp(prefix="dockstat-ckpt-")  # single-machine runs and tests only
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir() or path
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique table location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/tables/{name}-{uuid.uuid4().hex[:12]}"
