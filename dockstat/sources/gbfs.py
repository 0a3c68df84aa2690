"""Readers for landed GBFS feed files.

Each landed file is one fetch of one feed: a JSON envelope
``{"last_updated": ..., "ttl": ..., "data": {"<list>": [...]}}``.  The
reader applies an explicit schema (no inference), explodes the list with
``inline`` and stamps every row with the file's ingestion time, so all rows
of one fetch share one ``ingested_at``.  The ingestion time is taken from an
``ingested_at=...`` folder in the path when the landing layout has one,
else from the file's modification time.

Boolean flags that feeds publish as ``0/1`` or ``true/false`` are read as
text and typed by staging; ``price`` is read as text and is ``''`` when
absent, as the ingest step stores it.  A truncated or malformed file fails these reads;
:func:`read_judged` and :func:`read_judged_stream` instead give such files, and items that
don't fit the feed, as rows with a ``problem``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, L = T.StringType(), T.DoubleType(), T.LongType()


def _fields(*pairs) -> list[T.StructField]:
    return [T.StructField(n, t, True) for n, t in pairs]


# feed name -> (list key under "data", item fields)
FEEDS = {
    "station_information": ("stations", _fields(
        ("station_id", S), ("name", S), ("short_name", S), ("lat", D), ("lon", D), ("region_id", S),
        ("capacity", L), ("has_kiosk", S))),
    "station_status": ("stations", _fields(
        ("station_id", S), ("num_bikes_available", L), ("num_bikes_disabled", L),
        ("num_docks_available", L), ("num_docks_disabled", L), ("is_installed", S), ("is_renting", S),
        ("is_returning", S), ("last_reported", L), ("num_ebikes_available", L))),
    "system_regions": ("regions", _fields(("region_id", S), ("name", S))),
    "free_bike_status": ("bikes", _fields(
        ("bike_id", S), ("lat", D), ("lon", D), ("is_reserved", S), ("is_disabled", S),
        ("vehicle_type_id", S))),
    "system_pricing_plans": ("plans", _fields(
        ("plan_id", S), ("name", S), ("currency", S), ("price", S), ("is_taxable", S),
        ("description", S))),
}


def envelope_schema(feed: str) -> T.StructType:
    key, fields = FEEDS[feed]
    item = T.StructType(fields)
    return T.StructType([
        T.StructField("last_updated", L, True),
        T.StructField("ttl", L, True),
        T.StructField("data", T.StructType([T.StructField(key, T.ArrayType(item), True)]), True),
    ])


def raw_schema(feed: str) -> T.StructType:
    """Columns of a feed's raw table."""
    return T.StructType([*FEEDS[feed][1], T.StructField("ingested_at", T.TimestampType()),
                         T.StructField("ingest_date", T.DateType()), T.StructField("load", T.LongType())])


def _stamp(files: DataFrame) -> Column:
    if "ingested_at" in files.columns:
        return F.col("ingested_at").cast("timestamp")
    return F.col("_metadata.file_modification_time")


def _typed(rows: DataFrame, feed: str, *more: str) -> DataFrame:
    if feed == "system_pricing_plans":
        rows = rows.withColumn("price", F.coalesce(F.col("price"), F.lit("")))
    return rows.select(*[f.name for f in FEEDS[feed][1]], "ingested_at", *more)


def _rows(env: DataFrame, feed: str) -> DataFrame:
    return _typed(env.select(F.inline(F.col(f"data.{FEEDS[feed][0]}")), _stamp(env).alias("ingested_at")), feed)


def read_gbfs(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """Rows of every landed ``feed`` file under ``path`` (batch)."""
    if feed not in FEEDS:
        raise ValueError(f"unknown feed {feed!r}; known: {sorted(FEEDS)}")
    env = (spark.read.schema(envelope_schema(feed)).option("multiLine", True)
           .option("mode", "FAILFAST").json(path))
    return _rows(env, feed)


def read_gbfs_stream(spark: SparkSession, path: str, feed: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """The same rows as a streaming DataFrame over a landing folder."""
    # files are taken in any order of their times, however old
    r = (spark.readStream.schema(envelope_schema(feed)).option("multiLine", True)
         .option("mode", "FAILFAST").option("maxFileAge", "36500d"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _rows(r.json(path), feed)


#: What is added to a feed's columns by the judging readers: NULL ``problem`` means a sound item.
JUDGED = ["problem", "file", "item"]
BAD_FILE, BAD_ITEM = "file is no whole JSON document", "item does not fit the feed"


def _judged(files: DataFrame, feed: str) -> DataFrame:
    """Rows of whole-text files: one per item, one per unreadable file, with :data:`JUDGED` columns.

    A file is parsed down to the JSON text of its items first, so that an item with a field of
    the wrong type, or one that is no object, leaves the other items of its file sound.
    """
    key, fields = FEEDS[feed]
    text = T.StructType([*fields, T.StructField("_corrupt_record", S)])
    entry = "struct<bad: boolean, item: string>"
    entries = F.when(F.col("_body").isNull() | F.col("_body._corrupt_record").isNotNull(),
                     F.array(F.struct(F.lit(True).alias("bad"), F.lit(None).cast("string").alias("item")))) \
        .otherwise(F.transform(f"_body.data.{key}", lambda x: F.struct(F.lit(False).alias("bad"), x.alias("item")))) \
        .cast(f"array<{entry}>")
    rows = files.select(_stamp(files).alias("ingested_at"), F.col("_metadata.file_path").alias("file"),
                        F.from_json("value", f"data struct<{key}: array<string>>, _corrupt_record string").alias("_body")) \
        .select("ingested_at", "file", F.explode(entries).alias("_entry")) \
        .select("ingested_at", "file", "_entry.bad", "_entry.item", F.from_json("_entry.item", text).alias("_row"))
    unfit = F.col("_row").isNull() | F.col("_row._corrupt_record").isNotNull()
    problem = F.when(F.col("bad"), F.lit(BAD_FILE)).when(unfit, F.lit(BAD_ITEM))
    return _typed(rows.select("ingested_at", "file", "item", problem.alias("problem"),
                              *[F.col(f"_row.{f.name}") for f in fields]), feed, *JUDGED)


def read_judged(spark: SparkSession, paths: str | list[str], feed: str, base: str | None = None) -> DataFrame:
    """Items of landed files with their ``problem``, if any; ``base`` is the landing folder of single files."""
    r = spark.read.option("wholetext", True)
    return _judged((r.option("basePath", base) if base else r).text(paths), feed)


def read_judged_stream(spark: SparkSession, path: str, feed: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same rows as a streaming DataFrame over a landing folder."""
    r = spark.readStream.option("wholetext", True).option("maxFileAge", "36500d")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _judged(r.text(path), feed)
