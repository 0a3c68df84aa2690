"""Incremental snapshot fact: load what is newer than the table's watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockstat.sources.manifest import newest_part, publish_table, published, read_published
from dockstat.sources.sinks import newest_partition, table_exists


def table_watermark(spark: SparkSession, path: str, watermark: str, partition_col: str | None):
    """``max(watermark)`` of the table; with a partition column only the newest
    partition, found by listing folders, is scanned."""
    t = spark.read.parquet(path)
    if partition_col:
        last = newest_partition(spark, path, partition_col)
        if last is None:
            return None
        t = t.filter(F.col(partition_col) == F.lit(last))
    return t.agg(F.max(watermark)).first()[0]


def _prepare(rows: DataFrame, keys: list[str], partition_col: str | None) -> DataFrame:
    """One row per key, laid out for a partitioned write.

    Range partitioning on (partition, keys) puts equal keys in one task --
    so the de-duplication needs no second shuffle -- and gives every task a
    narrow slice of partitions, so each task writes a few files instead of
    one per partition value.  A hot station is cut by date and time.
    """
    first = [partition_col, *keys] if partition_col else list(keys)
    if partition_col:
        rows = rows.repartitionByRange(*first)
    # of rows with equal keys the one with the greatest other values stays, on every run
    order = [F.col(c).desc_nulls_last() for c in rows.columns if c not in first] or [F.lit(1)]
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*first).orderBy(*order))) \
        .filter(F.col("_rn") == 1).drop("_rn")


def incremental_merge(target_path: str, source: DataFrame, keys: Sequence[str] = ("station_id", "ingested_at"),
                      watermark: str = "ingested_at", partition_col: str | None = "snapshot_date",
                      partition_expr: Column | None = None, return_touched: bool = False):
    """Merge ``source`` into the parquet table at ``target_path`` and return the table.

    First run (no table): everything is written.  Later runs take only rows
    with ``watermark`` strictly greater than the table's current maximum --
    late or equal-time rows are not loaded -- and upsert them on ``keys``.
    An existing but empty table has no maximum; it loads everything (the
    warehouse version would load nothing, forever).  Duplicate keys within
    a batch are reduced to one row.  A table that can't be read raises; only a missing
    one counts as absent.

    When ``watermark`` is one of ``keys`` (the snapshot fact: station_id,
    ingested_at) a row past the watermark cannot match a stored key, so the
    upsert is an append of the new rows: the work follows the batch, not the
    table.  A retry re-reads the watermark, so rows committed by a failed
    attempt are not loaded twice.  Otherwise the partitions that receive
    rows are rebuilt: their current rows (minus the keys being replaced)
    plus the new rows are published as a new version (``publish_table``), so
    a crash at any step leaves the old table or the new one; read such a table with
    ``read_published``.  That path needs the
    partition to follow from the key (a key never moves between
    partitions); with ``partition_col=None`` the whole table is rewritten.

    With ``return_touched`` the result is ``(table, touched)`` where
    ``touched`` lists the partition values that received rows (``None`` for
    a first, full load), so dependent marts can be refreshed for just those
    partitions.
    """
    spark = source.sparkSession
    keys = list(keys)
    if partition_col:
        pexpr = partition_expr if partition_expr is not None else F.to_date(watermark)
        source = source.withColumn(partition_col, pexpr)

    if watermark not in keys:
        table, touched = _general_upsert(target_path, source, keys, watermark, partition_col)
        return (table, touched) if return_touched else table

    def done(touched):
        # an empty first batch leaves no file: the table is still missing, and empty
        t = spark.read.parquet(target_path) if table_exists(spark, target_path) else \
            spark.createDataFrame([], source.schema)
        return (t, touched) if return_touched else t

    def write(df: DataFrame, mode: str) -> None:
        w = df.write.mode(mode)
        if partition_col:
            w = w.partitionBy(partition_col)
            if mode == "overwrite":
                w = w.option("partitionOverwriteMode", "dynamic")
        w.parquet(target_path)

    if not table_exists(spark, target_path):
        write(_prepare(source, keys, partition_col), "overwrite")
        return done(None)

    wm = table_watermark(spark, target_path, watermark, partition_col)
    new = source if wm is None else source.filter(F.col(watermark) > F.lit(wm))
    if new.isEmpty():
        return done([])
    new = _prepare(new, keys, partition_col).persist()  # batch-sized; read twice below
    touched = ([r[0] for r in new.select(partition_col).distinct().collect()]
               if partition_col else None)

    write(new, "append")
    new.unpersist()
    return done(touched)


def _general_upsert(path: str, source: DataFrame, keys: list[str], watermark: str, partition_col: str | None):
    """(table, partition values that received rows; None for a first load) of an upsert on keys without the watermark."""
    spark = source.sparkSession
    if not published(spark, path):
        publish_table(_prepare(source, keys, partition_col), path, partition_col)
        return read_published(spark, path), None
    last = newest_part(spark, path, partition_col) if partition_col else None
    if partition_col and last is None:
        wm = None
    else:
        wm = read_published(spark, path, [last] if last else None).agg(F.max(watermark)).first()[0]
    new = source if wm is None else source.filter(F.col(watermark) > F.lit(wm))
    new = _prepare(new, keys, partition_col).persist()  # batch-sized; read several times below
    try:
        touched = [r[0] for r in new.select(partition_col).distinct().collect()] if partition_col else None
        if touched == [] or new.isEmpty():
            return read_published(spark, path), []
        target = read_published(spark, path)
        # The dates a batch touches are few; as a literal list they prune the
        # scan of the existing table to exactly those partitions.
        current = target.filter(F.col(partition_col).isin(touched)) if partition_col else target
        kept = current.join(new.select(*keys), keys, "left_anti").select(*target.columns)
        publish_table(kept.unionByName(new.select(*target.columns)), path, partition_col)
    finally:
        new.unpersist()
    return read_published(spark, path), touched


def insert_new(target_path: str, source: DataFrame, keys: Sequence[str] = ("station_id", "ingested_at"),
               partition_col: str = "snapshot_date", partition_expr: Column | None = None) -> DataFrame:
    """Append the rows of ``source`` whose key the table does not hold yet, however old they are.

    Unlike :func:`incremental_merge` there is no watermark: late rows come in, and rows that come
    again -- in a repeated file or a retried batch -- don't.  Only the partitions that receive
    rows are read (keys alone), so the partition has to follow from the key.  NULL keys
    are equal to each other.
    """
    spark, keys = source.sparkSession, list(keys)
    rows = source.withColumn(partition_col, partition_expr if partition_expr is not None else F.to_date(keys[-1]))
    rows = _prepare(rows, keys, partition_col).persist()
    try:
        if table_exists(spark, target_path):
            dates = [r[0] for r in rows.select(partition_col).distinct().collect()]
            inside = F.col(partition_col).isin([d for d in dates if d is not None])
            known = spark.read.parquet(target_path)
            known = known.filter(inside | F.col(partition_col).isNull() if None in dates else inside).select(*keys)
            same = [F.col(f"_new.{k}").eqNullSafe(F.col(f"_known.{k}")) for k in keys]
            fresh = rows.alias("_new").join(known.alias("_known"), same, "left_anti")
        else:
            fresh = rows
        fresh.write.mode("append").partitionBy(partition_col).parquet(target_path)
    finally:
        rows.unpersist()
    return spark.read.parquet(target_path)
