import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from dockstat.operators.enrich import stations_enriched
from dockstat.operators.staging import stage_pricing_plans, stage_station_status
from dockstat.sources.gbfs import read_gbfs
from dockstat.sources.seeds import (bike_types, boroughs, capacity_tiers, read_interventions,
                                    region_population)
from dockstat.sources.manifest import publish_table, read_published
from dockstat.sources.sinks import append_raw
from dockstat.streaming.ingest import stream_status_to_fact


def land(root, feed, stamp, key, items):
    d = os.path.join(root, feed, f"ingested_at={stamp}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{feed}.json"), "w") as f:
        json.dump({"last_updated": 0, "ttl": 30, "data": {key: items}}, f)


STATUS = [{"station_id": "A", "num_bikes_available": 3, "num_bikes_disabled": 0, "num_docks_available": 7,
           "num_docks_disabled": 0, "is_installed": 1, "is_renting": True, "is_returning": 0,
           "last_reported": 1775822400, "num_ebikes_available": 1},
          {"station_id": "B", "num_bikes_available": 1}]


def test_read_status_and_stage(spark, tmp):
    land(tmp, "station_status", "2026-04-10T12:00:00Z", "stations", STATUS)
    raw = read_gbfs(spark, os.path.join(tmp, "station_status"), "station_status")
    st = {r.station_id: r for r in stage_station_status(raw).collect()}
    a = st["A"]
    assert (a.is_installed, a.is_renting, a.is_returning) == (True, True, False)
    assert a.last_reported_at == dt.datetime(2026, 4, 10, 12, 0)
    assert a.ingested_at == dt.datetime(2026, 4, 10, 12, 0)
    assert st["B"].num_docks_available is None  # missing key -> NULL


def test_empty_bike_feed_and_price(spark, tmp):
    land(tmp, "free_bike_status", "2026-04-10T12:00:00Z", "bikes", [])
    bikes = read_gbfs(spark, os.path.join(tmp, "free_bike_status"), "free_bike_status")
    assert bikes.count() == 0 and "vehicle_type_id" in bikes.columns
    land(tmp, "system_pricing_plans", "2026-04-10T12:00:00Z", "plans",
         [{"plan_id": "p1", "name": "Day", "currency": "USD", "price": 19.0, "is_taxable": 0,
           "description": "d"},
          {"plan_id": "p2", "name": "Free", "currency": "USD", "is_taxable": False, "description": "x"}])
    plans = read_gbfs(spark, os.path.join(tmp, "system_pricing_plans"), "system_pricing_plans")
    assert {r.plan_id: r.price for r in plans.collect()} == {"p1": "19.0", "p2": ""}
    lenient = {r.plan_id: r.price for r in stage_pricing_plans(plans, on_error="null").collect()}
    assert lenient == {"p1": 19.0, "p2": None}
    with pytest.raises(Exception):
        stage_pricing_plans(plans).collect()  # '' fails the strict cast


def test_seeds_and_sinks(spark, tmp):
    assert capacity_tiers(spark).count() == 5
    assert bike_types(spark).filter(F.col("typical_range_miles").isNull()).count() == 2
    assert boroughs(spark).count() == 7
    pop = region_population(boroughs(spark)).first()
    assert (pop.region_name, pop.boroughs, pop.population_2020) == ("NYC District", 7, 9156639)
    p = os.path.join(tmp, "iv.csv")
    with open(p, "w") as f:
        f.write("station_id,intervention_date,intervention_type,notes\n"
                "66dd,2026-04-10,rebalancing,x\n1905394575114219798,2026-04-12,reactivation,y\n")
    iv = read_interventions(spark, p)
    assert [r.station_id for r in iv.collect()] == ["66dd", "1905394575114219798"]
    raw = spark.createDataFrame([("A", dt.datetime(2026, 4, 10, 1))], "station_id string, ingested_at timestamp")
    append_raw(raw, os.path.join(tmp, "raw"))
    append_raw(raw, os.path.join(tmp, "raw"))
    assert spark.read.parquet(os.path.join(tmp, "raw")).count() == 2
    publish_table(raw.withColumn("d", F.lit("x")), os.path.join(tmp, "mart"), partition_by="d")
    publish_table(raw.withColumn("d", F.lit("x")), os.path.join(tmp, "mart"), partition_by="d")
    assert read_published(spark, os.path.join(tmp, "mart")).count() == 1


def test_stream_ingest_available_now(spark, tmp):
    landing = os.path.join(tmp, "landing")
    land(landing, "station_status", "2026-04-10T12:00:00Z", "stations", STATUS[:1])
    land(landing, "station_status", "2026-04-10T12:30:00Z", "stations",
         [dict(STATUS[0], num_bikes_available=5)])
    st = spark.createDataFrame([("A", "Alpha", "a", "R1", 40.7, -74.0, 10, True, dt.datetime(2026, 4, 1))],
                               "station_id string, station_name string, short_name string, region_id string, "
                               "latitude double, longitude double, total_docks long, has_kiosk boolean, "
                               "ingested_at timestamp")
    rg = spark.createDataFrame([("R1", "North", dt.datetime(2026, 4, 1))],
                               "region_id string, region_name string, ingested_at timestamp")
    fact = os.path.join(tmp, "fact")
    # the landing layout is partitioned by ingested_at, so the stream sees it as a column
    q = stream_status_to_fact(spark, os.path.join(landing, "station_status"), stations_enriched(st, rg),
                              fact, os.path.join(tmp, "ckpt"))
    q.awaitTermination(120)
    got = sorted((r.ingested_at, r.num_bikes_available, r.bike_availability_rate)
                 for r in spark.read.parquet(fact).collect())
    assert got == [(dt.datetime(2026, 4, 10, 12, 0), 3, 0.3), (dt.datetime(2026, 4, 10, 12, 30), 5, 0.5)]
    # a restart with the same checkpoint reads only the file that landed since
    land(landing, "station_status", "2026-04-10T13:00:00Z", "stations",
         [dict(STATUS[0], num_bikes_available=8)])
    q = stream_status_to_fact(spark, os.path.join(landing, "station_status"), stations_enriched(st, rg),
                              fact, os.path.join(tmp, "ckpt"))
    q.awaitTermination(120)
    got = sorted((r.ingested_at, r.num_bikes_available) for r in spark.read.parquet(fact).collect())
    assert got[-1] == (dt.datetime(2026, 4, 10, 13, 0), 8) and len(got) == 3


def test_stream_of_shuffled_and_repeated_files_equals_batch(spark, tmp):
    """One file a micro-batch, newest first, one twice, one broken; a station appears between two runs."""
    landing, fact = os.path.join(tmp, "landing"), os.path.join(tmp, "fact")
    feed, dim = os.path.join(landing, "station_status"), os.path.join(tmp, "stations")
    schema = ("station_id string, station_name string, region_id string, region_name string, total_docks long, "
              "latitude double, longitude double")
    a, c = ("A", "Alpha", "R1", "North", 10, 40.7, -74.0), ("C", "Gamma", "R1", "North", 20, 40.8, -74.0)
    spark.createDataFrame([a], schema).write.parquet(dim)

    def land_at(hour, bikes, stations="A", at=None):
        items = [dict(STATUS[0], station_id=s, num_bikes_available=bikes) for s in stations]
        land(landing, "station_status", f"2026-04-{hour // 24 + 10}T{hour % 24:02d}:00:00Z", "stations", items)
        os.utime(os.path.join(feed, f"ingested_at=2026-04-{hour // 24 + 10}T{hour % 24:02d}:00:00Z", "station_status.json"), at)

    def run():
        stream_status_to_fact(spark, feed, lambda s: s.read.parquet(dim), fact, os.path.join(tmp, "ckpt"),
                              max_files_per_trigger=1, quarantine=os.path.join(tmp, "aside")).awaitTermination()

    for hour in (30, 12, 1):                       # the newest stamp lands first
        land_at(hour, hour % 10, at=(1e9 - hour, 1e9 - hour))
    again = os.path.join(feed, "ingested_at=2026-04-10T12:00:00Z", "again.json")
    with open(os.path.join(feed, "ingested_at=2026-04-10T12:00:00Z", "station_status.json")) as f, open(again, "w") as g:
        g.write(f.read())
    broken = os.path.join(feed, "ingested_at=2026-04-10T20:00:00Z")
    os.makedirs(broken)
    with open(os.path.join(broken, "f.json"), "w") as f:
        f.write('{"data": {"stations": [{"station_id"')
    run()
    spark.createDataFrame([c], schema).write.mode("append").parquet(dim)
    land_at(31, 4, "AC")
    with open(os.path.join(broken, "f.json"), "w") as f:
        json.dump({"data": {"stations": [dict(STATUS[0], num_bikes_available=9)]}}, f)
    run()
    got = sorted((r.ingested_at, r.station_id, r.station_name, r.bike_availability_rate)
                 for r in spark.read.parquet(fact).collect())
    from dockstat.operators.enrich import status_history
    whole = status_history(stage_station_status(read_gbfs(spark, feed, "station_status")).dropDuplicates(), spark.read.parquet(dim))
    assert got == sorted((r.ingested_at, r.station_id, r.station_name, r.bike_availability_rate) for r in whole.collect())
    assert len(got) == 6


def test_reader_stamps_file_time_without_run_folder(spark, tmp):
    d = os.path.join(tmp, "flat")
    os.makedirs(d)
    with open(os.path.join(d, "regions.json"), "w") as f:
        json.dump({"data": {"regions": [{"region_id": "R1", "name": "North"}]}}, f)
    r = read_gbfs(spark, d, "system_regions").first()
    assert r.region_id == "R1" and r.ingested_at is not None


@pytest.mark.parametrize("step", ["children", "commit"])
def test_publish_and_upsert_survive_a_crash(spark, tmp, monkeypatch, step):
    """A crash before the rows are written or before the commit leaves the old table; the retry gives the new one."""
    from dockstat.operators.incremental import incremental_merge
    from dockstat.sources import manifest as M
    table, upsert = os.path.join(tmp, "table"), os.path.join(tmp, "upsert")

    def days(*rows):
        return spark.createDataFrame([(d and dt.date(2026, 4, d), v) for d, v in rows], "day date, v int")

    def stations(*rows):
        return spark.createDataFrame([(k, dt.datetime(2026, 4, 1, h), v) for k, h, v in rows], "k string, at timestamp, v int")

    def held(path):
        return sorted(map(tuple, read_published(spark, path).collect()), key=str)

    def merge(rows):
        incremental_merge(upsert, rows, keys=["k"], watermark="at", partition_col=None)

    publish_table(days((1, 1), (2, 2), (None, 0)), table, "day")
    merge(stations(("A", 1, 1), ("B", 1, 1)))
    before = held(table), held(upsert)
    new_days, new_stations = days((2, 20), (3, 3)), stations(("B", 2, 5), ("C", 2, 6), ("A", 1, 9))

    def crash(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(M, step, crash)
        for work in (lambda: publish_table(new_days, table, "day"), lambda: merge(new_stations)):
            with pytest.raises(RuntimeError):
                work()
    assert (held(table), held(upsert)) == before
    publish_table(new_days, table, "day")
    merge(new_stations)
    assert held(table) == sorted([(dt.date(2026, 4, 1), 1), (dt.date(2026, 4, 2), 20), (dt.date(2026, 4, 3), 3), (None, 0)], key=str)
    assert [(r[0], r[2]) for r in held(upsert)] == [("A", 1), ("B", 5), ("C", 6)]
    publish_table(read_published(spark, table).filter("v > 2"), table)     # reads itself; the whole table
    assert sorted(r.v for r in read_published(spark, table).collect()) == [3, 20]
    publish_table(days().limit(0), table)
    assert held(table) == []
    for n in range(9):
        publish_table(days((1, n)), table, "day", keep=2)
    assert len([f for f in os.listdir(table) if f.startswith("version=") and os.listdir(os.path.join(table, f))]) <= 3


def test_failing_check_raises(spark):
    from dockstat.operators.quality import DataQualityError, check_rate_valid, run_checks
    bad = spark.createDataFrame([("A", dt.datetime(2026, 4, 10), 1.5, 0.2)],
                                "station_id string, ingested_at timestamp, bike_availability_rate double, "
                                "dock_availability_rate double")
    with pytest.raises(DataQualityError, match="rate_valid=1"):
        run_checks(failing={"rate_valid": check_rate_valid(bad)}, raise_on_failure=True)
