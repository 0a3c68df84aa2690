import datetime as dt
import time
import math

import numpy as np
import pytest
import plain
from pyspark.sql import functions as F

from dockstat.operators.nearest import nearest_station
from dockstat.operators.scd2 import scd2_from_history
from dockstat.operators.windows import availability_windows, rolling_mean_rate, with_lag, with_recency_rank
from dockstat.plans.context import Models

SF = "/root/testdata/sf0.01"


def brute(bikes, stations):
    """numpy ranking over all pairs (the reference definition)."""
    out = {}
    r = math.acos(-1.0) / 180.0
    for b in bikes:
        best = None
        for s in stations:
            a = (math.sin((s[1] - b[1]) * r / 2) ** 2
                 + math.cos(b[1] * r) * math.cos(s[1] * r) * math.sin((s[2] - b[2]) * r / 2) ** 2)
            if best is None or (a, s[0]) < best:
                best = (a, s[0])
        if best is not None:
            out[b[0]] = best[1]
    return out


BIKES = "bike_id string, latitude double, longitude double, is_reserved boolean, is_disabled boolean, " \
        "vehicle_type_id string, ingested_at timestamp"
STATIONS = "station_id string, station_name string, region_id string, region_name string, " \
           "latitude double, longitude double"
T0 = dt.datetime(2026, 4, 10, 12)


@pytest.mark.parametrize("cell", [0.01, 0.5])
def test_grid_equals_brute_force(spark, cell):
    rng = np.random.default_rng(7)
    st = [(f"s{i}", float(lat), float(lon)) for i, (lat, lon) in
          enumerate(zip(rng.uniform(40.6, 40.9, 300), rng.uniform(-74.1, -73.8, 300)))]
    # a sparse outlier and a station across the antimeridian
    st += [("far", 10.0, 20.0), ("east", 0.0, 179.999)]
    st += [(f"zero{i}", 0.0, 0.0) for i in range(50)]   # co-located placeholder positions
    bk = [(f"b{i}", float(lat), float(lon)) for i, (lat, lon) in
          enumerate(zip(rng.uniform(40.5, 41.0, 150), rng.uniform(-74.2, -73.7, 150)))]
    bk += [("lonely", -45.0, 100.0), ("west", 0.0, -179.999), ("pole", 89.99, 0.0), ("origin", 0.001, 0.0)]
    bikes = spark.createDataFrame([(i, a, o, False, False, "classic", T0) for i, a, o in bk], BIKES)
    stations = spark.createDataFrame([(i, i, "R", "Reg", a, o) for i, a, o in st], STATIONS)
    got = {r.bike_id: r.nearest_station_id for r in nearest_station(bikes, stations, cell_deg=cell).collect()}
    assert got == brute(bk, st)
    assert got["west"] == "east"
    assert got["origin"] == "zero0"


def test_nearest_empty_inputs(spark):
    bikes = spark.createDataFrame([], BIKES)
    stations = spark.createDataFrame([("s", "s", "R", "Reg", 40.7, -74.0)], STATIONS)
    assert nearest_station(bikes, stations).count() == 0
    some = spark.createDataFrame([("b", 40.7, -74.0, False, False, "classic", T0)], BIKES)
    alone = nearest_station(some, spark.createDataFrame([], STATIONS)).collect()
    assert [(r.bike_id, r.nearest_station_id, r.distance_km) for r in alone] == [("b", None, None)]


def test_far_bikes_meet_few_stations_and_every_bike_keeps_a_row(spark, monkeypatch):
    from dockstat.operators import nearest
    rng = np.random.default_rng(11)
    st = [(f"s{i}", float(a), float(o)) for i, (a, o) in enumerate(zip(rng.uniform(40.5, 41.0, 800), rng.uniform(-74.2, -73.7, 800)))]
    st += [("pole", 90.0, 0.0), ("south", -89.0, 10.0), ("date", -5.0, 179.9)]
    bk = [(f"far{i}", float(a), float(o)) for i, (a, o) in enumerate(zip(rng.uniform(-90, 90, 60), rng.uniform(-180, 180, 60)))]
    bk += [(f"null_island{i}", 0.0, 0.0) for i in range(100)] + [("edge", -5.0, -179.9), ("top", 89.9, 170.0)]
    stations = spark.createDataFrame([(i, i, "R", "Reg", a, o) for i, a, o in st], STATIONS)
    rows = [(i, a, o, False, False, "classic", T0) for i, a, o in bk]
    rows += [("lost", None, None, False, False, "classic", T0), ("far0", None, 1.0, True, False, "classic", T0),
             ("far1", -89.9, bk[1][2], False, False, "classic", T0)]
    scored, held = [], nearest._descend
    monkeypatch.setattr(nearest, "_descend", lambda pending, *a: scored.append(pending.count()) or held(pending, *a))
    got = nearest_station(spark.createDataFrame(rows, BIKES), stations).collect()
    assert len(got) == len(bk) + 1 and scored[0] <= 63  # distinct positions only
    found = {r.bike_id: r.nearest_station_id for r in got}
    assert found.pop("lost") is None
    assert found == brute(bk, st)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def odd_snapshots(spark):
    """A hot station, sparse days, tied times, NULL stations, NULL times and NULL values."""
    t = [T0 + dt.timedelta(minutes=7 * k) for k in range(400)]
    t += [T0 + dt.timedelta(days=5), T0 + dt.timedelta(days=7), T0 + dt.timedelta(days=7, minutes=1)]
    rows = [("H", "Hot", "R", "Reg", 20, ts, ts, k % 21, 0, 20 - k % 21, 0, True, k % 17 != 0, True,
             round(min(1.0, (k % 21) / 20), 4), None) for k, ts in enumerate(t)]
    for k in range(60):
        when = None if k % 7 == 0 else T0 + dt.timedelta(hours=k // 3)      # ties of three
        rows.append((None if k % 2 else "S", None, "R", "Reg", 20, T0 if k % 5 else None, when, k % 4 or None, k % 2,
                     k % 3, 0, k % 6 != 0, True, None if k % 11 == 0 else True, k % 4 / 4 if k % 4 else None, 0.25))
    return spark.createDataFrame(rows, plain.SCHEMA).repartition(3)


def test_windows_equal_plain_python(spark):
    df = odd_snapshots(spark)
    for n in (2, 3, 5):
        want = plain.windows(df, n)
        for bucket in (None, F.date_trunc("hour", "ingested_at")):
            assert _rows(availability_windows(df, n=n, bucket=bucket)) == want
    want = {(str(r[0]), str(r[6]), r[-1]) for r in plain.windows(df)}
    got = with_recency_rank(df)
    assert {(str(r.station_id), str(r.ingested_at), r.snapshot_recency_rank) for r in got.collect()} == want
    assert _rows(rolling_mean_rate(df).select("rolling_3_bike_availability_rate")) == \
        sorted(((r[-4],) for r in plain.windows(df)), key=str)
    assert _rows(with_lag(df).select("prev_bikes_available", "prev_docks_available")) == \
        sorted(((r[-3], r[-2]) for r in plain.windows(df)), key=str)


def test_intervals_equal_plain_python(spark):
    df = odd_snapshots(spark)
    cols = ["is_installed", "is_renting", "is_returning"]
    for bucket in (None, F.date_trunc("hour", "ingested_at")):
        got = scd2_from_history(df, "station_id", "ingested_at", cols, ["num_bikes_available"], bucket)
        assert _rows(got) == plain.intervals(df, "station_id", "ingested_at", cols, ["num_bikes_available"])


def test_a_station_of_many_minutes_is_quick(spark):
    """The frame over a station's buckets is a running sum: half a million of them take seconds."""
    n = 500_000
    df = spark.range(n).selectExpr("'H' as station_id", *[f"cast(null as {t}) as {c}" for c, t in (
        p.split() for p in plain.SCHEMA.split(", ")) if c not in ("station_id", "ingested_at")],
        "timestamp_seconds(id * 60) as ingested_at")
    t = time.time()
    ranks = availability_windows(df, bucket=F.date_trunc("minute", "ingested_at")) \
        .agg(F.min("snapshot_recency_rank"), F.max("snapshot_recency_rank"), F.sum("snapshot_recency_rank")).first()
    assert tuple(ranks) == (1, n, n * (n + 1) // 2) and time.time() - t < 120


def test_cells_follow_crowded_stations(spark, monkeypatch):
    """4,000 stations within one cell of 0.01 degrees: a position meets a few dozen of them, and finds the nearest."""
    from dockstat.operators import nearest
    rng = np.random.default_rng(21)
    at = [(f"S{i:04d}", 40.7 + float(a) / 200, -74.0 + float(b) / 200) for i, (a, b) in enumerate(rng.random((4000, 2)))]
    places = [(f"b{i}", 40.7 + float(a) / 200, -74.0 + float(b) / 200) for i, (a, b) in enumerate(rng.random((40, 2)))]
    places += [("near", 40.9, -74.3), ("far", -33.0, 151.0)]
    stations = spark.createDataFrame([(i, "n", "r", "rn", a, o) for i, a, o in at], STATIONS)
    bikes = spark.createDataFrame([(i, a, o, False, False, "1", T0) for i, a, o in places], BIKES)
    columns, held = [], nearest._search
    monkeypatch.setattr(nearest, "_search", lambda pending, st, n, *a: columns.append(n) or held(pending, st, n, *a))
    got = {r.bike_id: r.nearest_station_id for r in nearest_station(bikes, stations).collect()}
    assert got == brute(places, at)
    size, cells = 360.0 / columns[0], {}
    for _, a, o in at:
        key = math.floor((a + 90) / size), math.floor((o + 180) / size)
        cells[key] = cells.get(key, 0) + 1
    assert sum(n * n for n in cells.values()) <= nearest.CELL_STATIONS * len(at)
