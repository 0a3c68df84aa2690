"""Typed staging projections of the raw feed tables.

Each function renames and casts; nothing is filtered.  ``on_error="fail"``
keeps strict (ANSI) casts, so a malformed value fails the job as in the
warehouse; ``on_error="null"`` turns it into NULL with ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cast(name: str, to: str, on_error: str) -> Column:
    col = F.col(name)
    if on_error == "null":
        return col.try_cast(to)
    if on_error != "fail":
        raise ValueError(f"on_error must be 'fail' or 'null', got {on_error!r}")
    return col.cast(to)


def _ts(name: str, on_error: str) -> Column:
    """ISO-8601 (or already typed) instant -> TIMESTAMP."""
    return _cast(name, "timestamp", on_error)


def stage_stations(raw: DataFrame, on_error: str = "fail") -> DataFrame:
    return raw.select(
        F.col("station_id"),
        F.col("name").alias("station_name"),
        F.col("short_name"),
        F.col("region_id"),
        _cast("lat", "double", on_error).alias("latitude"),
        _cast("lon", "double", on_error).alias("longitude"),
        _cast("capacity", "long", on_error).alias("total_docks"),
        _cast("has_kiosk", "boolean", on_error).alias("has_kiosk"),
        _ts("ingested_at", on_error).alias("ingested_at"))


def stage_station_status(raw: DataFrame, on_error: str = "fail") -> DataFrame:
    counts = ["num_bikes_available", "num_ebikes_available", "num_bikes_disabled",
              "num_docks_available", "num_docks_disabled"]
    flags = ["is_installed", "is_renting", "is_returning"]
    return raw.select(
        F.col("station_id"),
        *[_cast(c, "long", on_error).alias(c) for c in counts],
        *[_cast(c, "boolean", on_error).alias(c) for c in flags],
        F.timestamp_seconds(_cast("last_reported", "long", on_error)).alias("last_reported_at"),
        _ts("ingested_at", on_error).alias("ingested_at"))


def stage_regions(raw: DataFrame, on_error: str = "fail") -> DataFrame:
    return raw.select(
        F.col("region_id"),
        F.col("name").alias("region_name"),
        _ts("ingested_at", on_error).alias("ingested_at"))


def stage_bikes(raw: DataFrame, on_error: str = "fail") -> DataFrame:
    return raw.select(
        F.col("bike_id"),
        _cast("lat", "double", on_error).alias("latitude"),
        _cast("lon", "double", on_error).alias("longitude"),
        _cast("is_reserved", "boolean", on_error).alias("is_reserved"),
        _cast("is_disabled", "boolean", on_error).alias("is_disabled"),
        F.col("vehicle_type_id"),
        _ts("ingested_at", on_error).alias("ingested_at"))


def stage_pricing_plans(raw: DataFrame, on_error: str = "fail") -> DataFrame:
    """``price`` arrives as a string ('' when absent): strict cast fails on ''."""
    return raw.select(
        F.col("plan_id"),
        F.col("name").alias("plan_name"),
        F.col("currency"),
        _cast("price", "double", on_error).alias("price"),
        _cast("is_taxable", "boolean", on_error).alias("is_taxable"),
        F.col("description"),
        _ts("ingested_at", on_error).alias("ingested_at"))
