"""Operations marts: fleet per run, station per day, region per hour-of-week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockstat.functions.columns import avg_rate_4dp, half_up_div, mean_rounded, rate_to_bp
from dockstat.operators.joins import bounded_broadcast


def _ratio_4dp(num: Column, den: Column) -> Column:
    """``round(safe_divide(num, den), 4)`` exactly, for non-negative integers."""
    return half_up_div(num.cast("decimal(38,0)") * 10000, den.cast("decimal(38,0)")) / 10000


def _distinct_stations(approx: bool) -> Column:
    """Exact ``count(distinct station_id)``, or a HyperLogLog estimate (rsd 5 %) with ``approx``."""
    return F.approx_count_distinct("station_id") if approx else F.count_distinct("station_id")


def fleet_availability(fact: DataFrame, run_key: Column | None = None, approx: bool = False) -> DataFrame:
    """One row per ingestion run: fleet totals, utilisation and e-bike share.

    ``run_key`` defaults to ``ingested_at``; pass e.g. an hour truncation when
    every station reports on its own clock.  The result column keeps the
    name ``ingested_at``.
    """
    key = F.col("ingested_at") if run_key is None else run_key
    bikes, ebikes = F.sum("num_bikes_available"), F.sum("num_ebikes_available")
    docks = F.sum("num_docks_available")
    agg = (fact.groupBy(key.alias("ingested_at")).agg(
        _distinct_stations(approx).alias("total_stations"),
        bikes.alias("total_bikes_available"),
        ebikes.alias("total_ebikes_available"),
        (bikes - ebikes).alias("total_classic_bikes_available"),
        F.sum("num_bikes_disabled").alias("total_bikes_disabled"),
        docks.alias("total_docks_available"),
        F.sum("num_docks_disabled").alias("total_docks_disabled"),
        _ratio_4dp(bikes, bikes + docks).alias("fleet_utilisation_rate"),
        _ratio_4dp(ebikes, bikes).alias("ebike_share_rate"),
        F.count_if(F.col("num_bikes_available") == 0).alias("empty_stations"),
        F.count_if(F.col("num_docks_available") == 0).alias("full_stations"),
        F.count_if(~F.col("is_installed") | ~F.col("is_renting")).alias("inactive_stations")))
    return agg


def _priority_2dp(n: Column, empty: Column, bp_sum: Column, bp_count: Column) -> Column:
    """``round(empty/n*60 + (1 - avg_rate)*40, 2)`` with ``avg_rate = bp_sum/bp_count/10000``.

    In hundredths: ``6000*e/n + 4000 - 2*S/(5*c)`` over the common
    denominator ``5*c*n``; NULL when no rate was observed.  The products grow with the
    square of the snapshots of a station-day, so they are wide decimals.
    """
    n, empty, bp_sum, bp_count = (c.cast("decimal(38,0)") for c in (n, empty, bp_sum, bp_count))
    num = empty * bp_count * 30000 + bp_count * n * 20000 - bp_sum * n * 2
    return half_up_div(num, bp_count * n * 5) / 100


def station_daily_performance(fact: DataFrame) -> DataFrame:
    """Per station and UTC day: counts, mean/min/max availability, empties,
    sums and a rebalancing priority score (higher = more urgent).

    total_docks is a grouping key, so a mid-day capacity change yields two
    rows.  Partial aggregation runs before the shuffle on the grouping keys.
    """
    bp = rate_to_bp("bike_availability_rate")
    n = F.count(F.lit(1))
    empty = F.count_if(F.col("num_bikes_available") == 0)
    return fact.groupBy(
        "station_id", "station_name", "region_id", "region_name", "total_docks",
        F.to_date("ingested_at").alias("snapshot_date")).agg(
        n.alias("snapshots_that_day"),
        avg_rate_4dp("bike_availability_rate").alias("avg_bike_availability"),
        avg_rate_4dp("dock_availability_rate").alias("avg_dock_availability"),
        F.min("bike_availability_rate").alias("min_bike_availability"),
        F.max("bike_availability_rate").alias("max_bike_availability"),
        empty.alias("empty_snapshots"),
        F.count_if(F.col("num_docks_available") == 0).alias("full_snapshots"),
        _ratio_4dp(empty, n).alias("empty_rate"),
        F.sum("num_bikes_available").alias("total_bikes_available_sum"),
        F.sum("num_ebikes_available").alias("total_ebikes_available_sum"),
        F.sum("num_bikes_disabled").alias("total_bikes_disabled_sum"),
        _priority_2dp(n, empty, F.sum(bp), F.count(bp)).alias("rebalancing_priority_score"))


def region_hourly_availability(fact: DataFrame, approx: bool = False) -> DataFrame:
    """Per region, UTC hour of day and day of week (1 = Sunday)."""
    n = F.count(F.lit(1))
    empty = F.count_if(F.col("num_bikes_available") == 0)
    return fact.groupBy(
        "region_id", "region_name",
        F.hour("ingested_at").alias("hour_of_day"),
        F.dayofweek("ingested_at").alias("day_of_week")).agg(
        n.alias("snapshot_count"),
        _distinct_stations(approx).alias("stations_observed"),
        avg_rate_4dp("bike_availability_rate").alias("avg_bike_availability"),
        avg_rate_4dp("dock_availability_rate").alias("avg_dock_availability"),
        F.min("bike_availability_rate").alias("min_bike_availability"),
        F.max("bike_availability_rate").alias("max_bike_availability"),
        empty.alias("empty_station_snapshots"),
        _ratio_4dp(empty, n).alias("empty_station_rate"))


def _part_keys() -> list[Column]:
    return [F.col("region_id"), F.col("region_name"), F.to_date("ingested_at").alias("snapshot_date"),
            F.hour("ingested_at").alias("hour_of_day"), F.dayofweek("ingested_at").alias("day_of_week")]


def region_hourly_parts(fact: DataFrame) -> DataFrame:
    """Mergeable per-day pieces of :func:`region_hourly_availability`.

    One row per (region, UTC date, hour, day of week) with integer sums,
    counts, min and max.  A daily job rewrites only the dates that received
    snapshots and rolls all days up with :func:`region_hourly_rollup`.
    """
    bike, dock = rate_to_bp("bike_availability_rate"), rate_to_bp("dock_availability_rate")
    return fact.groupBy(*_part_keys()).agg(
        F.count(F.lit(1)).alias("n"), F.sum(bike).alias("bike_bp_sum"), F.count(bike).alias("bike_bp_n"),
        F.sum(dock).alias("dock_bp_sum"), F.count(dock).alias("dock_bp_n"),
        F.min("bike_availability_rate").alias("bike_min"), F.max("bike_availability_rate").alias("bike_max"),
        F.count_if(F.col("num_bikes_available") == 0).alias("empty"))


NUMBERING_PARTS = 64


def number_stations(ids: DataFrame, start: int = 0) -> DataFrame:
    """``station_id`` and consecutive numbers from ``start`` on, for distinct non-NULL ids.

    Numbers are given within hash parts and shifted by the sizes of the parts before, so no
    task orders all stations.
    """
    parts = ids.select("station_id", F.pmod(F.xxhash64("station_id"), F.lit(NUMBERING_PARTS)).alias("_p"))
    sizes = {r["_p"]: r["n"] for r in parts.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = [], start
    for p in range(NUMBERING_PARTS):
        offsets.append(F.lit(total).cast("long"))
        total += sizes.get(p, 0)
    place = F.row_number().over(Window.partitionBy("_p").orderBy("station_id"))
    return parts.select("station_id", (F.get(F.array(*offsets), F.col("_p").cast("int")) + place - 1).alias("number"))


def station_ids(fact: DataFrame) -> DataFrame:
    return fact.select("station_id").filter("station_id is not null").distinct()


def region_hour_presence(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    """Which stations were seen per (region, UTC date, hour, day of week): bitmaps over their numbers.

    A bitmap covers 32,768 numbers, so a row is 4 KB however many snapshots a station has,
    and days merge with ``bitmap_or_agg``; see :func:`region_hourly_rollup`.
    """
    seen = fact.select("station_id", *_part_keys()).join(bounded_broadcast(numbers), "station_id")
    number = F.col("number") + 1  # positive numbers share buckets from one on
    return seen.groupBy(*[F.col(c) for c in ("region_id", "region_name", "snapshot_date", "hour_of_day", "day_of_week")],
                        F.bitmap_bucket_number(number).alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("stations"))


def region_hour_sketches(fact: DataFrame) -> DataFrame:
    """The approximate form of :func:`region_hour_presence`: HyperLogLog sketches, without station numbers."""
    seen = fact.select("station_id", *_part_keys())
    return seen.groupBy("region_id", "region_name", "snapshot_date", "hour_of_day", "day_of_week") \
        .agg(F.hll_sketch_agg("station_id").alias("sketch"))


def region_hourly_rollup(parts: DataFrame, presence: DataFrame) -> DataFrame:
    """:func:`region_hourly_availability` from per-day parts and per-day presence (bitmaps or sketches)."""
    keys = ["region_id", "region_name", "hour_of_day", "day_of_week"]
    n, empty = F.sum("n"), F.sum("empty")
    agg = parts.groupBy(*keys).agg(
        n.alias("snapshot_count"),
        mean_rounded(F.sum("bike_bp_sum"), F.sum("bike_bp_n")).alias("avg_bike_availability"),
        mean_rounded(F.sum("dock_bp_sum"), F.sum("dock_bp_n")).alias("avg_dock_availability"),
        F.min("bike_min").alias("min_bike_availability"),
        F.max("bike_max").alias("max_bike_availability"),
        empty.alias("empty_station_snapshots"),
        _ratio_4dp(empty, n).alias("empty_station_rate"))
    if "sketch" in presence.columns:
        seen = presence.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("_seen"))
    else:
        seen = presence.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("stations").alias("stations")) \
            .groupBy(*keys).agg(F.sum(F.bitmap_count("stations")).alias("_seen"))
    return agg.join(seen, [agg[k].eqNullSafe(seen[k]) for k in keys], "left").select(
        *[agg[k] for k in keys], "snapshot_count", F.coalesce("_seen", F.lit(0).cast("long")).alias("stations_observed"),
        "avg_bike_availability", "avg_dock_availability", "min_bike_availability", "max_bike_availability",
        "empty_station_snapshots", "empty_station_rate")


def top_priority_stations(daily: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` station-days most in need of rebalancing (a top-k report).

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each partition
    keeps its own top ``n`` and only those reach the final merge.
    """
    return daily.orderBy(F.col("rebalancing_priority_score").desc_nulls_last(),
                         F.col("snapshot_date").desc(), F.col("station_id").asc(),
                         F.col("total_docks").asc()).limit(n)
