import datetime as dt
import os

from pyspark.sql import functions as F

from dockstat.operators.incremental import incremental_merge
from dockstat.operators.scd2 import scd2_check, scd2_from_history

T0 = dt.datetime(2026, 4, 10, 12, 0, 0)
SCHEMA = "station_id string, ingested_at timestamp, num_bikes_available long"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_merge_watermark_and_idempotence(spark, tmp):
    path = os.path.join(tmp, "fact")
    h = lambda k: T0 + dt.timedelta(hours=k)
    incremental_merge(path, rows(spark, [("A", h(0), 1), ("A", h(1), 2)]))
    # late (h(0.5)) and equal-time (h(1)) rows are not loaded; newer rows are
    batch = rows(spark, [("A", T0 + dt.timedelta(minutes=30), 9), ("A", h(1), 9), ("A", h(30), 3),
                         ("B", h(30), 4)])
    out = incremental_merge(path, batch)
    got = sorted((r.station_id, r.ingested_at, r.num_bikes_available) for r in out.collect())
    assert got == [("A", h(0), 1), ("A", h(1), 2), ("A", h(30), 3), ("B", h(30), 4)]
    again = incremental_merge(path, batch)
    assert again.count() == 4
    assert {r.snapshot_date for r in again.collect()} == {T0.date(), (T0 + dt.timedelta(hours=30)).date()}


def test_merge_upsert_on_other_keys(spark, tmp):
    path = os.path.join(tmp, "latest")
    h = lambda k: T0 + dt.timedelta(hours=k)
    incremental_merge(path, rows(spark, [("A", h(0), 1), ("B", h(0), 2)]), keys=("station_id",),
                      partition_col=None)
    out = incremental_merge(path, rows(spark, [("A", h(5), 7), ("C", h(5), 3), ("B", h(0), 9)]),
                            keys=("station_id",), partition_col=None)
    got = sorted((r.station_id, r.ingested_at, r.num_bikes_available) for r in out.collect())
    assert got == [("A", h(5), 7), ("B", h(0), 2), ("C", h(5), 3)]


CUR = "station_id string, total_docks long, has_kiosk boolean"


def test_scd2_lifecycle(spark):
    cur1 = spark.createDataFrame([("A", 10, True), ("B", 20, True), ("C", 30, False)], CUR)
    cur2 = spark.createDataFrame([("A", 10, True), ("B", 25, True), ("D", 5, None)], CUR)
    cur3 = spark.createDataFrame([("A", 10, True), ("B", 25, True), ("C", 30, False), ("D", 5, None)], CUR)
    s = None
    for as_of, cur in zip(["2026-04-01 06:00:00", "2026-04-02 06:00:00", "2026-04-03 06:00:00"],
                          [cur1, cur2, cur3]):
        s = scd2_check(s, cur, "station_id", ["total_docks", "has_kiosk"], as_of)
    d = lambda k: dt.datetime(2026, 4, k, 6)
    got = sorted((r.station_id, r.total_docks, r.dbt_valid_from, r.dbt_valid_to) for r in s.collect())
    assert got == [
        ("A", 10, d(1), None),            # unchanged: one open version
        ("B", 20, d(1), d(2)),            # changed: closed ...
        ("B", 25, d(2), None),            # ... and reopened
        ("C", 30, d(1), d(2)),            # absent in run 2: closed (hard delete)
        ("C", 30, d(3), None),            # back again: new version
        ("D", 5, d(2), None),             # new key; NULL check value compares null-safe
    ]
    assert s.select("dbt_scd_id").distinct().count() == 6


def test_intervals_from_history(spark):
    t = lambda m: T0 + dt.timedelta(minutes=m)
    h = spark.createDataFrame(
        [("A", t(0), True), ("A", t(10), True), ("A", t(20), False), ("A", t(25), False), ("A", t(40), True),
         ("B", t(0), None), ("B", t(5), None)],
        "station_id string, ingested_at timestamp, is_renting boolean")
    out = scd2_from_history(h, "station_id", "ingested_at", ["is_renting"])
    got = sorted((r.station_id, r.version, r.is_renting, r.valid_from, r.valid_to, r.snapshots,
                  r.duration_seconds) for r in out.collect())
    assert got == [("A", 1, True, t(0), t(20), 2, 1200), ("A", 2, False, t(20), t(40), 2, 1200),
                   ("A", 3, True, t(40), None, 1, None), ("B", 1, None, t(0), None, 2, None)]
    # versions of one station never overlap
    for sid in ("A",):
        vs = sorted((r.valid_from, r.valid_to) for r in out.filter(F.col("station_id") == sid).collect())
        assert all(a[1] == b[0] for a, b in zip(vs, vs[1:]))


def test_capacity_roster_latest_batch_closes_dropped_stations(spark):
    from dockstat.operators.scd2 import snapshot_capacity
    cols = ("station_id string, station_name string, region_id string, region_name string, total_docks long, "
            "has_kiosk boolean, latitude double, longitude double, ingested_at timestamp")
    t1, t2 = T0, T0 + dt.timedelta(days=1)
    run1 = spark.createDataFrame([("A", "a", "R", "r", 10, True, 40.7, -74.0, t1),
                                  ("B", "b", "R", "r", 20, True, 40.8, -74.0, t1)], cols)
    both = run1.unionByName(spark.createDataFrame([("A", "a", "R", "r", 10, True, 40.7, -74.0, t2)], cols))
    snap = snapshot_capacity(None, run1, "2026-04-10 13:00:00")
    # append-only history: B keeps its last row and stays open
    kept = snapshot_capacity(snap, both, "2026-04-11 13:00:00")
    assert kept.filter("station_id = 'B' and dbt_valid_to is null").count() == 1
    # roster of the newest load: B left the feed and is closed
    closed = snapshot_capacity(snap, both, "2026-04-11 13:00:00", roster="latest_batch")
    b = closed.filter("station_id = 'B'").first()
    assert b.dbt_valid_to == dt.datetime(2026, 4, 11, 13, 0)
