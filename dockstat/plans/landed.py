"""Landed feed files written from the benchmark tables, for the readers, the stream and the jobs.

Each feed's items go into JSON envelopes of about ``ITEMS`` items, one file each, under
``<feed>/ingested_at=<stamp>/part=<n>/`` -- the layout the readers expect.  Status files
are fetches of a feed that reports each station once: a station's first event of a quarter of
the day is in the fetch at its start, its second one in a fetch a second later, and so on, so
every event is in one file and a station with many events makes many fetches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockstat.plans import fixtures as fx
from dockstat.sources.gbfs import FEEDS

ITEMS = 5000


def fetched_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a staged-shape snapshot, with its fetch's stamp as ``ingested_at``."""
    of_quarter = Window.partitionBy("user_id", "quarter").orderBy("ts", "event_id")
    events = fx.table(spark, sf_dir, "events") \
        .withColumn("quarter", F.expr("timestampadd(HOUR, hour(ts) div 6 * 6, date_trunc('day', ts))")) \
        .withColumn("fetch", F.timestamp_add("SECOND", F.row_number().over(of_quarter) - 1, F.col("quarter")))
    return events.selectExpr(*fx.STATUS_EXPRS[:-1], "fetch as ingested_at")


def items(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """A feed's items as text or numbers, with ``ingested_at``."""
    if feed == "station_status":
        return fetched_status(spark, sf_dir).withColumn("last_reported", F.unix_seconds(F.col("last_reported_at").cast("timestamp")))
    raw = {"station_information": fx.raw_station_information, "system_regions": fx.raw_system_regions,
           "free_bike_status": fx.raw_free_bike_status, "system_pricing_plans": fx.raw_pricing_plans}[feed]
    rows = raw(spark, sf_dir)
    if feed == "system_pricing_plans":  # one fetch of all plans
        rows = rows.withColumn("ingested_at", F.lit(f"{fx.FIXTURE_RUN}"))
    return rows


def land(spark: SparkSession, sf_dir: str, feed: str, root: str, part: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> str:
    """Write one feed's files under ``root``; returns the feed's folder.

    ``part`` picks or changes the items that land now; later calls add files beside them.
    """
    key, fields = FEEDS[feed]
    rows = part(items(spark, sf_dir, feed))
    item = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    stamp = F.date_format(F.col("ingested_at").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = rows.select(stamp.alias("ingested_at"), F.col(fields[0].name).alias("_id"), item.alias("_item"))
    sizes = rows.groupBy("ingested_at").agg(F.ceil(F.count(F.lit(1)) / ITEMS).alias("_files"))
    files = rows.join(sizes, "ingested_at") \
        .withColumn("part", F.pmod(F.xxhash64("_id"), "_files").cast("int")) \
        .groupBy("ingested_at", "part").agg(F.collect_list("_item").alias("_items"))
    envelope = F.struct(F.lit(0).alias("last_updated"), F.lit(30).alias("ttl"), F.struct(F.col("_items").alias(key)).alias("data"))
    files.select(F.to_json(envelope).alias("value"), "ingested_at", "part") \
        .write.mode("append").partitionBy("ingested_at", "part").text(f"{root}/{feed}")
    return f"{root}/{feed}"
