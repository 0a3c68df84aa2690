"""Data-quality checks: each returns failing rows or failure counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The not-null contract of the staging tables.
NOT_NULL = {
    "stage_stations": ["station_id", "station_name", "latitude", "longitude", "total_docks", "ingested_at"],
    "stage_station_status": ["station_id", "num_bikes_available", "num_docks_available",
                                     "last_reported_at", "ingested_at"],
    "stage_regions": ["region_id", "region_name", "ingested_at"],
    "stage_bikes": ["bike_id", "ingested_at"],
    "stage_pricing_plans": ["plan_id", "plan_name", "price", "ingested_at"],
}


class DataQualityError(RuntimeError):
    pass


def check_not_null(tables: Mapping[str, DataFrame],
                   spec: Mapping[str, Sequence[str]] = NOT_NULL) -> DataFrame:
    """One row per (table, column) with the number of NULLs.

    Each table is scanned once: all its NULL counts are one aggregate, then
    ``stack`` turns the single row into (check, failures) rows.
    """
    parts = []
    for name, cols in spec.items():
        if name not in tables:
            continue
        df = tables[name]
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
        pairs = ", ".join(f"'not_null_{name}_{c}', c{i}" for i, c in enumerate(cols))
        parts.append(agg.selectExpr(f"stack({len(cols)}, {pairs}) as (check_name, failures)"))
    return reduce(DataFrame.unionByName, parts)


def check_rate_valid(fact: DataFrame) -> DataFrame:
    """Snapshots whose availability rates fall outside [0, 1]."""
    def bad(c):
        return F.col(c).isNotNull() & ((F.col(c) < 0) | (F.col(c) > 1))
    return (fact.filter(bad("bike_availability_rate") | bad("dock_availability_rate"))
            .select("station_id", "ingested_at", "bike_availability_rate", "dock_availability_rate"))


def check_score_bounded(health: DataFrame) -> DataFrame:
    """Stations whose health score falls outside [0, 100] (NULL passes)."""
    s = F.col("health_score")
    return health.filter((s < 0) | (s > 100)).select("station_id", "station_name", "health_score")


def check_no_future(fact: DataFrame, as_of: str | None = None) -> DataFrame:
    """Snapshots stamped after ``as_of`` (default: now)."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return fact.filter(F.col("ingested_at").cast("timestamp") > now).select("station_id", "ingested_at")


def run_checks(not_null: DataFrame | None = None, failing: Mapping[str, DataFrame] | None = None,
               raise_on_failure: bool = False) -> DataFrame:
    """Combine check results into (check_name, failures, passed).

    ``failing`` maps a check name to its failing-rows DataFrame; each is
    reduced to a count inside the job.  With ``raise_on_failure`` the checks run here, once:
    the totals (a handful of rows) are fetched and returned as a local table, and a failure
    raises :class:`DataQualityError`.
    """
    parts = [] if not_null is None else [not_null]
    for name, df in (failing or {}).items():
        parts.append(df.agg(F.count(F.lit(1)).alias("failures"))
                     .select(F.lit(name).alias("check_name"), "failures"))
    out = reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)
    if raise_on_failure:
        rows = out.collect()
        bad = [r for r in rows if not r.passed]
        if bad:
            raise DataQualityError(", ".join(f"{r.check_name}={r.failures}" for r in bad))
        out = out.sparkSession.createDataFrame(rows, out.schema)
    return out
