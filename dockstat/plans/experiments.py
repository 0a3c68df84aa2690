"""Intervention experiments: pre/post availability around each intervention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockstat.operators.joins import DEFAULT_BROADCAST_ROWS, bounded_broadcast
from dockstat.functions.columns import Z_SIGNIFICANT, rate_to_bp, z_score

INTERVENTION_KEYS = ["station_id", "station_name", "region_name", "intervention_date", "intervention_type"]


def station_interventions(seed: DataFrame, stations_dim: DataFrame) -> DataFrame:
    """Intervention records with the station's current attributes and health."""
    s = stations_dim.select("station_id", "station_name", "region_id", "region_name", "total_docks",
                            "capacity_tier", F.col("health_score").alias("current_health_score"),
                            F.col("health_status").alias("current_health_status"))
    return (seed.join(s, "station_id", "left")
            .select("station_id", "station_name", "region_id", "region_name", "total_docks",
                    "capacity_tier", "current_health_score", "current_health_status",
                    F.col("intervention_date").cast("date").alias("intervention_date"),
                    "intervention_type", "notes"))


def with_station_names(seed: DataFrame, stations: DataFrame) -> DataFrame:
    """Intervention seed with the station and region names the pre/post analysis groups by.

    Same names as :func:`station_interventions` gives (they come from the
    enriched stations either way), without computing health and tiers.
    """
    names = stations.select("station_id", "station_name", "region_name")
    return seed.join(names, "station_id", "left").select(
        *INTERVENTION_KEYS[:3], F.col("intervention_date").cast("date").alias("intervention_date"),
        "intervention_type")


def _windowed(interventions: DataFrame, fact: DataFrame, days: int,
              broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Snapshots within ``days`` days either side of each intervention.

    The band condition ``|snapshot_date - intervention_date| <= days`` is
    turned into an equi-join: every intervention is expanded to its
    ``2 * days + 1`` calendar dates and joined on (station_id,
    snapshot_date).  The expanded interventions are broadcast when their
    measured row count is within ``broadcast_rows``: the fact is filtered
    where it lies and only per-intervention partial aggregates are
    shuffled.  Otherwise the fact is shuffled on (station_id,
    snapshot_date), never by station alone, so a busy station spreads over
    its dates.  With a fact partitioned by snapshot_date the join key is the
    partition column, which lets dynamic partition pruning skip dates no
    intervention touches.
    """
    iv = (interventions.select(*INTERVENTION_KEYS)
          .withColumn("snapshot_date", F.explode(F.sequence(
              F.date_sub("intervention_date", days), F.date_add("intervention_date", days)))))
    snaps = fact.select("station_id", F.to_date("ingested_at").alias("snapshot_date"),
                        "bike_availability_rate", "num_bikes_available")
    j = bounded_broadcast(iv, broadcast_rows).join(snaps, ["station_id", "snapshot_date"])
    return j.withColumn("period", F.when(F.col("snapshot_date") < F.col("intervention_date"), "pre").otherwise("post"))


def intervention_periods(interventions: DataFrame, fact: DataFrame, days: int = 14) -> DataFrame:
    """Per intervention and period ('pre': before the date, 'post': from it on)."""
    j = _windowed(interventions, fact, days)
    bp = rate_to_bp("bike_availability_rate")
    return j.groupBy(*INTERVENTION_KEYS, "period").agg(
        F.count(F.lit(1)).alias("snapshot_count"),
        (F.floor(F.try_divide(F.sum(bp), F.count(bp)) + 0.5) / 10000).alias("avg_bike_availability"),
        F.min("bike_availability_rate").alias("min_bike_availability"),
        F.max("bike_availability_rate").alias("max_bike_availability"),
        F.count_if(F.col("num_bikes_available") == 0).alias("empty_snapshots"))


def intervention_results(interventions: DataFrame, fact: DataFrame, days: int = 14,
                         significance: bool = False) -> DataFrame:
    """Pre vs post comparison, one row per intervention with snapshots in range.

    The per-period aggregation and the pivot are one conditional
    aggregation (a single shuffle).  A period without snapshots gives NULL
    average, count and empties; a NULL delta counts as 'no_change'.
    """
    j = _windowed(interventions, fact, days)
    bp = rate_to_bp("bike_availability_rate")
    pre, post = F.col("period") == "pre", F.col("period") == "post"

    def mean_bp(cond):
        b = F.when(cond, bp)
        return F.floor(F.try_divide(F.sum(b), F.count(b)) + 0.5)

    def count_or_null(cond):
        n = F.count_if(cond)
        return F.when(n > 0, n)

    def empties(cond):
        return F.when(F.count_if(cond) > 0, F.count_if(cond & (F.col("num_bikes_available") == 0)))

    agg = j.groupBy(*INTERVENTION_KEYS).agg(
        mean_bp(pre).alias("_pre_bp"), mean_bp(post).alias("_post_bp"),
        count_or_null(pre).alias("pre_snapshot_count"), count_or_null(post).alias("post_snapshot_count"),
        empties(pre).alias("pre_empty_snapshots"), empties(post).alias("post_empty_snapshots"))
    out = agg.select(
        *INTERVENTION_KEYS,
        (F.col("_pre_bp") / 10000).alias("pre_avg_availability"),
        (F.col("_post_bp") / 10000).alias("post_avg_availability"),
        "pre_snapshot_count", "post_snapshot_count", "pre_empty_snapshots", "post_empty_snapshots",
        ((F.col("_post_bp") - F.col("_pre_bp")) / 10000).alias("availability_delta"),
        F.when(F.col("_post_bp") > F.col("_pre_bp"), "improved")
        .when(F.col("_post_bp") < F.col("_pre_bp"), "worsened")
        .otherwise("no_change").alias("intervention_outcome"))
    if significance:
        z = z_score("pre_avg_availability", "post_avg_availability", "pre_snapshot_count",
                    "post_snapshot_count")
        out = out.withColumn("z_score", z).withColumn("is_significant", F.col("z_score") > Z_SIGNIFICANT)
    return out
