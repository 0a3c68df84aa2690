"""The scheduled jobs end to end on a small landed feed."""

import json
import os

from dockstat.plans.jobs import Paths, run_daily, run_refresh
from dockstat.sources.manifest import read_published


def land(root, feed, stamp, key, items):
    d = os.path.join(root, feed, f"ingested_at={stamp}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{feed}.json"), "w") as f:
        json.dump({"last_updated": 0, "ttl": 30, "data": {key: items}}, f)


def feed_run(landing, stamp, bikes_a):
    land(landing, "station_information", stamp, "stations", [
        {"station_id": "A", "name": "Alpha", "short_name": "a", "lat": 40.70, "lon": -74.00,
         "region_id": "R1", "capacity": 10, "has_kiosk": True},
        {"station_id": "B", "name": "Beta", "short_name": "b", "lat": 40.72, "lon": -73.99,
         "region_id": "R1", "capacity": 20, "has_kiosk": False}])
    land(landing, "station_status", stamp, "stations", [
        {"station_id": "A", "num_bikes_available": bikes_a, "num_bikes_disabled": 0, "num_docks_available": 10 - bikes_a,
         "num_docks_disabled": 0, "is_installed": 1, "is_renting": 1, "is_returning": 1,
         "last_reported": 1775822400, "num_ebikes_available": 0},
        {"station_id": "B", "num_bikes_available": 5, "num_bikes_disabled": 1, "num_docks_available": 14,
         "num_docks_disabled": 0, "is_installed": True, "is_renting": bikes_a > 0, "is_returning": True,
         "last_reported": 1775822400, "num_ebikes_available": 2}])
    land(landing, "system_regions", stamp, "regions", [{"region_id": "R1", "name": "North"}])
    land(landing, "free_bike_status", stamp, "bikes", [
        {"bike_id": "x1", "lat": 40.701, "lon": -74.001, "is_reserved": 0, "is_disabled": 0,
         "vehicle_type_id": "classic"}])
    land(landing, "system_pricing_plans", stamp, "plans", [
        {"plan_id": "p", "name": "Day", "currency": "USD", "price": 19, "is_taxable": 0, "description": "d"}])


def test_refresh_then_daily(spark, tmp):
    landing = os.path.join(tmp, "landing")
    p = Paths(os.path.join(tmp, "warehouse"), landing)
    feed_run(landing, "2026-04-10T12:00:00Z", 3)
    checks = {r.check_name: r.failures for r in run_refresh(spark, p).collect()}
    assert checks["rate_valid"] == 0
    run_refresh(spark, p)  # nothing new landed: no rows appended twice
    assert spark.read.parquet(p.raw("station_status")).count() == 2

    run_daily(spark, p, as_of="2026-04-10 13:00:00")
    feed_run(landing, "2026-04-10T12:30:00Z", 0)
    run_refresh(spark, p)
    assert spark.read.parquet(p.raw("station_status")).count() == 4
    run_daily(spark, p, as_of="2026-04-11 06:00:00")
    run_daily(spark, p, as_of="2026-04-11 06:00:00")  # retry of the same run changes nothing

    fact = spark.read.parquet(p.mart("status_snapshots"))
    assert fact.count() == 4
    daily = {r.station_id: r for r in read_published(spark, p.mart("station_daily")).collect()}
    assert daily["A"].snapshots_that_day == 2 and daily["A"].empty_snapshots == 1
    from dockstat.operators.scd2_store import read_history
    latest = read_history(spark, p.snapshot("station_operational_history"))
    rows = sorted((r.station_id, r.is_renting, str(r.dbt_valid_to)) for r in latest.collect())
    assert rows == [("A", True, "None"), ("B", False, "None"), ("B", True, "2026-04-11 06:00:00")]
    near = spark.read.parquet(p.mart("bike_nearest_station")).collect()
    assert {(r.bike_id, r.nearest_station_id) for r in near} == {("x1", "A")}


def test_daily_marts_equal_full_rebuild(spark, tmp):
    """Incremental daily marts equal the marts computed over the whole fact."""
    from dockstat.plans.marts_ops import fleet_availability, region_hourly_availability, station_daily_performance
    landing = os.path.join(tmp, "landing")
    p = Paths(os.path.join(tmp, "warehouse"), landing)
    for k, (stamp, as_of) in enumerate([("2026-04-10T12:00:00Z", "2026-04-10 13:00:00"),
                                        ("2026-04-10T18:00:00Z", "2026-04-10 19:00:00"),
                                        ("2026-04-11T08:00:00Z", "2026-04-11 09:00:00")]):
        feed_run(landing, stamp, k * 2)
        run_refresh(spark, p)
        run_daily(spark, p, as_of=as_of)
    fact = spark.read.parquet(p.mart("status_snapshots"))
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    from dockstat.sources.sinks import read_latest_version
    assert rows(read_latest_version(spark, p.mart("region_hourly"))[0]) == rows(region_hourly_availability(fact))
    daily = read_published(spark, p.mart("station_daily"))
    assert rows(daily.select(*station_daily_performance(fact).columns)) == rows(station_daily_performance(fact))
    fleet = read_published(spark, p.mart("fleet_runs")).drop("run_date")
    assert rows(fleet.select(*fleet_availability(fact).columns)) == rows(fleet_availability(fact))
    # the folded top-3 table gives the same health as a scan of the whole fact
    from dockstat.operators.health import health_from_history
    from dockstat.sources.sinks import read_latest_version
    top, _ = read_latest_version(spark, p.mart("station_top_snapshots"))
    assert rows(health_from_history(top)) == rows(health_from_history(fact.drop("snapshot_date")))


def test_empty_feeds_late_files_and_truncated_files(spark, tmp):
    landing = os.path.join(tmp, "landing")
    p = Paths(os.path.join(tmp, "warehouse"), landing)
    feed_run(landing, "2026-04-10T12:00:00Z", 3)
    land(landing, "free_bike_status", "2026-04-10T12:00:00Z", "bikes", [])   # no free bikes
    run_refresh(spark, p)
    run_daily(spark, p, as_of="2026-04-10 13:00:00")
    feed_run(landing, "2026-04-10T11:00:00Z", 4)                             # stamped before, landed after
    run_refresh(spark, p)
    raw = spark.read.parquet(p.raw("station_status"))
    assert raw.count() == 4 and raw.select("ingested_at").distinct().count() == 2
    broken = os.path.join(landing, "station_status", "ingested_at=2026-04-10T14:00:00Z")
    os.makedirs(broken)
    whole = os.path.join(landing, "station_status", "ingested_at=2026-04-10T12:00:00Z", "station_status.json")
    with open(os.path.join(broken, "f.json"), "w") as f:
        f.write(open(whole).read()[:60])
    os.makedirs(os.path.join(landing, "station_status", "ingested_at=2026-04-10T14:10:00Z"))
    with open(os.path.join(landing, "station_status", "ingested_at=2026-04-10T14:10:00Z", "f.json"), "w") as f:
        f.write("\n")                                          # a blank file
    land(landing, "station_status", "2026-04-10T14:30:00Z", "stations", [
        {"station_id": "A", "num_bikes_available": 4, "num_docks_available": 6, "last_reported": 1775822400},
        {"station_id": "B", "num_bikes_available": "many", "num_docks_available": 6, "last_reported": 1775822400}, 7, None])

    def state():
        checks = {r.check_name: r.failures for r in run_refresh(spark, p).collect()}
        return spark.read.parquet(p.raw("station_status")).count(), checks["quarantine_station_status"]

    assert state() == (5, 5)                                   # two files and three items put aside
    from dockstat.sources.quarantine import quarantined
    assert {r.item for r in quarantined(spark, p.quarantine("station_status")).collect() if r.item and "many" in r.item}
    assert state() == (5, 5)                                   # nothing new, nothing twice
    with open(os.path.join(broken, "f.json"), "w") as f:
        f.write(open(whole).read())                            # mended in place
    feed_run(landing, "2026-04-10T15:00:00Z", 4)
    assert state() == (9, 4)                                   # its two rows and two new ones
    feed_run(landing, "2026-04-10T15:30:00Z", 5)
    assert state() == (11, 4)
    stamps = spark.read.parquet(p.raw("station_status")).filter("ingested_at = timestamp'2026-04-10 14:00:00'")
    assert stamps.count() == 2
    kiosk = spark.read.parquet(p.raw("station_information")).filter("station_id = 'A'").first().has_kiosk
    assert kiosk == "true"


def test_retry_after_a_crash_covers_the_same_snapshots(spark, tmp, monkeypatch):
    """Crash after the fact merge, more lands, retry with the same and then a new stamp: as a clean run."""
    import pytest
    from dockstat.operators.health import health_from_history
    from dockstat.plans import jobs
    from dockstat.plans.marts_ops import region_hourly_availability
    from dockstat.sources.sinks import read_latest_version
    landing = os.path.join(tmp, "landing")
    p = Paths(os.path.join(tmp, "warehouse"), landing)
    feed_run(landing, "2026-04-10T12:00:00Z", 3)
    run_refresh(spark, p)

    def crash(*a, **k):
        raise RuntimeError("lost")

    for step in ("top_snapshots", "region_hourly_rollup", "nearest_station"):
        with monkeypatch.context() as m:
            m.setattr(jobs, step, crash)
            with pytest.raises(RuntimeError):
                run_daily(spark, p, as_of="2026-04-10 13:00:00")
        if step == "region_hourly_rollup":
            feed_run(landing, "2026-04-10T13:30:00Z", 1)   # lands between the attempts
            run_refresh(spark, p)
    run_daily(spark, p, as_of="2026-04-10 13:00:00")
    fact = spark.read.parquet(p.mart("status_snapshots"))
    assert fact.count() == 2
    run_daily(spark, p, as_of="2026-04-10 14:00:00")
    fact = spark.read.parquet(p.mart("status_snapshots"))
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert fact.count() == 4
    top, _ = read_latest_version(spark, p.mart("station_top_snapshots"))
    assert top.count() == 4
    assert rows(health_from_history(top)) == rows(health_from_history(fact.drop("snapshot_date")))
    assert rows(read_latest_version(spark, p.mart("region_hourly"))[0]) == rows(region_hourly_availability(fact))


def test_merge_into_a_broken_table_raises(spark, tmp):
    import pytest
    from dockstat.operators.incremental import incremental_merge
    path = os.path.join(tmp, "t")
    df = spark.createDataFrame([("A", 1), ("B", 2)], "station_id string, ingested_at long")
    incremental_merge(path, df, keys=["station_id"], partition_col=None)
    with open(os.path.join(path, "version=0", "part-broken.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        incremental_merge(path, spark.createDataFrame([("C", 3)], df.schema), keys=["station_id"], partition_col=None)
    assert len(os.listdir(os.path.join(path, "version=0"))) > 2
    assert [f for f in os.listdir(os.path.join(path, "_manifests")) if not f.startswith(".")] == ["0000000000"]


def test_prune_versions(spark, tmp):
    from pyspark.sql import functions as F
    from dockstat.sources.sinks import append_version, prune_versions, read_latest_version
    path = os.path.join(tmp, "versions")
    df = spark.range(3).withColumn("x", F.lit(1))
    for v in ["20260401T060000", "20260402T060000", "20260403T060000"]:
        append_version(df, path, v)
    assert prune_versions(spark, path, keep=2) == ["20260401T060000"]
    latest, version = read_latest_version(spark, path)
    assert version == "20260403T060000" and latest.count() == 3
    assert spark.read.parquet(path).select("snapshot_run").distinct().count() == 2
