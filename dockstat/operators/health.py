"""Composite station health from each station's newest snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockstat.functions.columns import (health_status, rate_to_bp, hundredths, score_low_disabled_h,
                                        score_operational_h, score_rate_h)
from dockstat.operators.windows import TIE_COLUMNS

HEALTH_INPUT = ["station_id", "station_name", "region_id", "region_name", "total_docks",
                "num_bikes_available", "num_docks_available", "num_bikes_disabled",
                "num_docks_disabled", "is_installed", "is_renting", "is_returning",
                "bike_availability_rate", "dock_availability_rate",
                "rolling_3_bike_availability_rate", "last_reported_at", "ingested_at"]


def top_snapshots(history: DataFrame, n: int = 3) -> DataFrame:
    """The newest ``n`` snapshots of every station (rank filter, limited map-side).

    Top-n of a union is the top-n of the parts' top-n, so a daily job can
    keep this small table and fold each day's new snapshots into it instead
    of rescanning the history: ``top_snapshots(previous.unionByName(new), n)``.
    """
    w = Window.partitionBy("station_id").orderBy(*(F.col(c).desc_nulls_last() for c in ["ingested_at", *TIE_COLUMNS]))
    return history.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def latest_snapshots(history: DataFrame, n: int = 3) -> DataFrame:
    """Each station's newest snapshot with the rolling mean of its last ``n``.

    Same rows as ``availability_windows(history)`` at recency rank 1, but
    only the newest ``n`` snapshots per station are kept, by a rank filter
    that Spark applies per partition before the shuffle -- a station with
    millions of snapshots sends at most ``n`` per map task.
    """
    w = Window.partitionBy("station_id").orderBy(*(F.col(c).desc_nulls_last() for c in ["ingested_at", *TIE_COLUMNS]))
    top = history.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
    bp = rate_to_bp("bike_availability_rate")
    per = Window.partitionBy("station_id")
    roll = F.try_divide(F.sum(bp).over(per), F.count(bp).over(per)) / 10000
    return (top.withColumn("rolling_3_bike_availability_rate", roll)
            .filter(F.col("_r") == 1).drop("_r"))


def health_from_history(history: DataFrame, n: int = 3) -> DataFrame:
    """:func:`health_scores` computed straight from the snapshot history."""
    return _score(latest_snapshots(history, n).select(*HEALTH_INPUT))


def health_scores(windows: DataFrame) -> DataFrame:
    """One row per station: four 25-point components (each rounded to 2 dp),
    their rounded sum and a status taken from the unrounded sum.

    NULL components (e.g. a snapshot of an unknown station) give a NULL
    score and the status 'critical'.
    """
    return _score(windows.filter(F.col("snapshot_recency_rank") == 1).select(*HEALTH_INPUT))


def _score(latest: DataFrame) -> DataFrame:
    h_bike = score_rate_h("bike_availability_rate")
    h_dock = score_rate_h("dock_availability_rate")
    h_ops = score_operational_h("is_installed", "is_renting", "is_returning")
    h_low = score_low_disabled_h("num_bikes_disabled", "num_docks_disabled", "total_docks")
    scored = latest.select(*HEALTH_INPUT,
                           h_bike.alias("_hb"), h_dock.alias("_hd"), h_ops.alias("_ho"), h_low.alias("_hl"))
    total = F.col("_hb") + F.col("_hd") + F.col("_ho") + F.col("_hl")
    return scored.select(
        *HEALTH_INPUT,
        hundredths("_hb").alias("score_bike_availability"),
        hundredths("_hd").alias("score_dock_availability"),
        hundredths("_ho").alias("score_operational"),
        hundredths("_hl").alias("score_low_disabled"),
        hundredths(total).alias("health_score"),
        health_status(total).alias("health_status"))
