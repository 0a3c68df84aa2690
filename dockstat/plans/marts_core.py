"""Core marts: station and region dimensions, pricing plans, the snapshot fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockstat.functions.columns import mean_rounded
from dockstat.operators.dedup import latest_per_key
from dockstat.operators.tiers import with_capacity_tier

DIM_STATION_COLUMNS = ["station_id", "station_name", "short_name", "region_id", "region_name",
                       "latitude", "longitude", "total_docks", "has_kiosk", "capacity_tier",
                       "capacity_tier_description", "health_score", "health_status", "ingested_at"]
FACT_COLUMNS = ["station_id", "station_name", "region_id", "region_name", "total_docks",
                "latitude", "longitude", "num_bikes_available", "num_ebikes_available",
                "num_bikes_disabled", "num_docks_available", "num_docks_disabled",
                "is_installed", "is_renting", "is_returning", "bike_availability_rate",
                "dock_availability_rate", "last_reported_at", "ingested_at"]
PLAN_COLUMNS = ["plan_id", "plan_name", "currency", "price", "is_taxable", "description", "ingested_at"]


def dim_stations(enriched: DataFrame, health: DataFrame, tiers: DataFrame) -> DataFrame:
    """Stations with their latest health and capacity tier."""
    h = health.select("station_id", "health_score", "health_status")
    s = enriched.join(h, "station_id", "left")
    return with_capacity_tier(s, tiers).select(*DIM_STATION_COLUMNS)


def dim_regions(regions: DataFrame, stations_dim: DataFrame, grain: str = "declared") -> DataFrame:
    """Regions with station counts, docks and health mix.

    Regions without stations keep NULL rollups; stations without a region
    are not counted anywhere (left join from regions).  The rollup is a
    hash aggregate with map-side partial aggregation, so a region holding
    most stations costs no more than any other.
    """
    if grain == "declared":
        regions = latest_per_key(regions, "region_id", "ingested_at")
    h = F.round(F.col("health_score") * 100).cast("long")
    summary = stations_dim.groupBy("region_id").agg(
        F.count(F.lit(1)).alias("total_stations"),
        F.sum("total_docks").alias("total_docks"),
        mean_rounded(F.sum(h), F.count(h), unit=100).alias("avg_health_score"),
        F.count_if(F.col("health_status") == "healthy").alias("healthy_stations"),
        F.count_if(F.col("health_status") == "at_risk").alias("at_risk_stations"),
        F.count_if(F.col("health_status") == "critical").alias("critical_stations"))
    return (regions.select("region_id", "region_name", "ingested_at")
            .join(summary, "region_id", "left")
            .select("region_id", "region_name", "total_stations", "total_docks", "avg_health_score",
                    "healthy_stations", "at_risk_stations", "critical_stations", "ingested_at"))


def dim_pricing_plans(plans: DataFrame, tiebreak: str | None = None) -> DataFrame:
    """Newest row per plan."""
    return latest_per_key(plans, "plan_id", "ingested_at", tiebreak).select(*PLAN_COLUMNS)


def fct_status_snapshots(history: DataFrame) -> DataFrame:
    """The snapshot fact: one row per station snapshot, 19 columns."""
    return history.select(*FACT_COLUMNS)
