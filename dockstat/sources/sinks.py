"""Parquet sinks: append-only raw tables and rebuilt mart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _folder(spark: SparkSession, path: str):
    """(file system, Hadoop path) of ``path``, on any Hadoop-compatible store."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without Spark's own (``_``) and hidden ones; [] if it is missing."""
    fs, root = _folder(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(n for n in names if not n.startswith(("_", ".")))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds data; a table that is there but can't be read still exists."""
    return bool(children(spark, path))


def newest_partition(spark: SparkSession, path: str, column: str) -> str | None:
    """Greatest value of the first-level partition ``column``, from the folder names alone."""
    values = [n.split("=", 1)[1] for n in children(spark, path) if n.startswith(f"{column}=")]
    return max((v for v in values if v != "__HIVE_DEFAULT_PARTITION__"), default=None)


def remove(spark: SparkSession, path: str) -> None:
    fs, root = _folder(spark, path)
    fs.delete(root, True)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A raw table under its explicit schema; without any file yet it is empty."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def append_raw(df: DataFrame, path: str, partition_col: str = "ingest_date") -> None:
    """Append a batch of raw rows; the table is created by the first append.

    Rows are partitioned by the UTC date of ``ingested_at`` so later stages
    prune to the days they read.
    """
    (df.withColumn(partition_col, F.to_date(F.col("ingested_at").cast("timestamp")))
     .write.mode("append").partitionBy(partition_col).parquet(path))


def append_version(df: DataFrame, path: str, version: str, version_col: str = "snapshot_run") -> None:
    """Publish a full new version of a table next to the previous ones.

    The version is a partition of an append-only folder, so the previous
    version stays readable while the new one is written, and the write
    becomes visible only when Spark commits the job -- a failed run leaves
    the current version untouched and can simply be retried.
    """
    (df.withColumn(version_col, F.lit(version)).write.mode("append")
     .partitionBy(version_col).parquet(path))


def read_latest_version(spark, path: str, version_col: str = "snapshot_run"):
    """``(rows of the newest published version, its version)`` or ``(None, None)``."""
    last = newest_partition(spark, path, version_col)
    if last is None:
        return None, None
    t = spark.read.parquet(path)
    return t.filter(F.col(version_col) == F.lit(last)).drop(version_col), last


def prune_versions(spark, path: str, keep: int = 7, version_col: str = "snapshot_run") -> list[str]:
    """Delete all but the newest ``keep`` published versions; returns the removed ones.

    Works on any Hadoop-compatible file system (the cluster's shared store
    or a local folder) through the session's Hadoop configuration.
    """
    prefix = f"{version_col}="
    versions = [n for n in children(spark, path) if n.startswith(prefix)]
    old = versions[:-keep] if keep > 0 else versions
    for name in old:
        remove(spark, f"{path}/{name}")
    return [n[len(prefix):] for n in old]
