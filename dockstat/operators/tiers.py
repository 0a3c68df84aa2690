"""Capacity tier lookup: dock count -> tier, as an equi-join on dyadic blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockstat.operators.ranges import range_lookup


def with_capacity_tier(df: DataFrame, tiers: DataFrame, docks_col: str = "total_docks") -> DataFrame:
    """Left join on ``docks between min_docks and max_docks``.

    Tiers may be of any width, fractional or overlapping (a row for each tier met); see
    :mod:`dockstat.operators.ranges`.  Docks 0, NULL or above the last tier match nothing.
    """
    named = tiers.select("min_docks", "max_docks", F.col("tier_name").alias("capacity_tier"),
                         F.col("description").alias("capacity_tier_description"))
    return range_lookup(df, docks_col, named, "min_docks", "max_docks", ["capacity_tier", "capacity_tier_description"])
