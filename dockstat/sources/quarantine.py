"""Loading landed feed files with what can't be read put aside.

A load writes its sound rows to the raw table and its unreadable files and unfit items to
the feed's quarantine table, each into ``load=`` folders of its own; both are replaced when
a failed load is repeated.  A file that could not be read is tried again with every later load
until it can: its rows then come in with that load, once, and the quarantine gets a row that
says so (``problem`` = :data:`MENDED`).  An unfit item stays there with its text; the rest of its
file is loaded.  Files are known by their path, so a mended copy may be put in place of the
broken one; one under a new name is a new file.  (Spark's listing passes over files without a single byte.)

The numbers of a load are observed while it writes its rows, so the table is not read again for
them, and the quarantine costs a second reading only in loads that have a problem.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockstat.sources.gbfs import BAD_FILE, FEEDS, JUDGED, read_judged, read_judged_stream
from dockstat.sources.sinks import _folder, read_table

MENDED = "mended"
QUARANTINE = T.StructType([T.StructField(n, T.StringType()) for n in ("file", "problem", "item")]
                          + [T.StructField("ingested_at", T.TimestampType()), T.StructField("load", T.LongType())])


@dataclass(frozen=True)
class Load:
    """Numbers of one load, taken while it was written."""

    number: int
    rows: int
    problems: int
    nulls: dict[str, int]


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """What is still put aside: unfit items, and files that have not been readable since."""
    table = read_table(spark, path, QUARANTINE)
    mended = table.filter(F.col("problem") == MENDED).select("file").distinct()
    left = table.filter((F.col("problem") == BAD_FILE)).join(mended, "file", "left_anti")
    items = table.filter(~F.col("problem").isin(BAD_FILE, MENDED))
    return left.unionByName(items).select(*QUARANTINE.names)


def _pending(spark: SparkSession, path: str, number: int) -> list[str]:
    """Paths of the files that loads before ``number`` could not read and none has read since."""
    table = read_table(spark, path, QUARANTINE).filter(F.col("load") < number)
    by_file = table.filter(F.col("problem").isin(BAD_FILE, MENDED)).groupBy("file") \
        .agg(F.bool_or(F.col("problem") == MENDED).alias("mended"))
    jvm, out = spark.sparkContext._jvm, []
    for r in by_file.filter(~F.col("mended")).select("file").toLocalIterator():
        plain = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r.file)).toString()
        fs, at = _folder(spark, plain)
        if fs.exists(at):
            out.append(plain)
    return sorted(out)


def _write(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def with_mended(spark: SparkSession, rows: DataFrame, feed: str, landed: str, quarantine: str,
                number: int) -> tuple[DataFrame, DataFrame | None]:
    """Judged rows with those of pending files that have become readable, and these files' quarantine rows."""
    pending = _pending(spark, quarantine, number)
    if not pending:
        return rows, None
    readable = read_judged(spark, pending, feed, landed).filter(F.coalesce(F.col("problem") != BAD_FILE, F.lit(True)))
    mended = readable.groupBy("file").agg(F.max("ingested_at").alias("ingested_at")) \
        .select("file", F.lit(MENDED).alias("problem"), F.lit(None).cast("string").alias("item"), "ingested_at")
    return rows.unionByName(readable), mended


def put_aside(rows: DataFrame, mended: DataFrame | None, quarantine: str, number: int) -> None:
    """Write a load's problems, and the files it found mended, to its quarantine folder."""
    aside = rows.filter(F.col("problem").isNotNull()).select("file", "problem", "item", "ingested_at")
    if mended is not None:
        aside = aside.unionByName(mended)
    _write(aside.withColumn("load", F.lit(number).cast("long")), quarantine, "load")


def load_judged(spark: SparkSession, rows: DataFrame, feed: str, landed: str, path: str, quarantine: str,
                number: int) -> Load:
    """Write one load: ``rows`` (judged) and the items of pending files that have become readable."""
    rows, mended = with_mended(spark, rows, feed, landed, quarantine, number)
    required = [f.name for f in FEEDS[feed][1]]
    sound = F.col("problem").isNull()
    seen = Observation()
    watched = rows.observe(seen, F.count_if(sound).alias("_rows"), F.count_if(~sound).alias("_problems"),
                           *[F.count_if(sound & F.col(c).isNull()).alias(c) for c in required])
    _write(watched.filter(sound).drop(*JUDGED)
           .withColumn("ingest_date", F.to_date(F.col("ingested_at").cast("timestamp")))
           .withColumn("load", F.lit(number).cast("long")), path, "ingest_date", "load")
    got = seen.get
    if got["_problems"] or mended is not None:
        put_aside(rows, mended, quarantine, number)
    return Load(number, got["_rows"], got["_problems"], {c: got[c] for c in required})


def load_new_files(spark: SparkSession, landed: str, feed: str, path: str, quarantine: str, checkpoint: str) -> list[Load]:
    """Load what a landing folder holds and no earlier load has taken; each file once, whatever its stamp."""
    loads: list[Load] = []

    def write(batch: DataFrame, number: int) -> None:
        loads.append(load_judged(batch.sparkSession, batch, feed, landed, path, quarantine, number))

    query = read_judged_stream(spark, landed, feed).writeStream.foreachBatch(write) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return loads
