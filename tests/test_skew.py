"""One station holding a third of all snapshots: the skew-safe plans stay exact."""

import plain
from pyspark.sql import functions as F

from dockstat.operators.health import health_from_history, health_scores
from dockstat.operators.scd2 import scd2_from_history
from dockstat.operators.windows import availability_windows
from dockstat.plans.context import Models
from dockstat.plans.marts_ops import region_hourly_availability, station_daily_performance

SF = "/root/testdata/sf0.01"


def hot_history(spark):
    """The fixture history with every third snapshot moved to one station (42)."""
    m = Models(spark, SF)
    status = m.status.withColumn(
        "station_id", F.when(F.col("num_docks_disabled") == 0, F.lit(42).cast("long"))  # event_id % 3 == 0
        .otherwise(F.col("station_id")))
    from dockstat.operators.enrich import status_history
    return status_history(status, m.enriched)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_hot_station_is_a_third(spark):
    h = hot_history(spark)
    top = h.groupBy("station_id").count().orderBy(F.desc("count")).first()
    assert top.station_id == 42 and top["count"] * 3 >= h.count() * 0.9


def test_windows_and_health_on_a_hot_station(spark):
    h = hot_history(spark)
    got = availability_windows(h)
    assert sorted(map(tuple, got.collect()), key=str) == plain.windows(h)
    assert rows(health_scores(got)) == rows(health_from_history(h))


def test_intervals_and_rollups_on_a_hot_station(spark):
    h = hot_history(spark)
    cols = ["is_installed", "is_renting", "is_returning"]
    got = scd2_from_history(h, "station_id", "ingested_at", cols)
    assert sorted(map(tuple, got.collect()), key=str) == plain.intervals(h, "station_id", "ingested_at", cols)
    # the rollups are plain partial aggregates; a hot key only changes a group's size
    daily = station_daily_performance(h)
    assert daily.filter(F.col("station_id") == 42).agg(F.sum("snapshots_that_day")).first()[0] >= 3000
    assert region_hourly_availability(h).count() > 0
