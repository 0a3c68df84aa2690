import datetime as dt

from pyspark.sql import functions as F

from dockstat.operators.enrich import stations_enriched, status_history
from dockstat.operators.health import health_from_history, health_scores
from dockstat.operators.tiers import with_capacity_tier
from dockstat.operators.windows import availability_windows
from dockstat.plans.experiments import intervention_periods, intervention_results
from dockstat.plans.marts_core import dim_regions
from dockstat.sources.seeds import capacity_tiers

T0 = dt.datetime(2026, 4, 10, 12, 0, 0)
ST = ("station_id string, station_name string, short_name string, region_id string, latitude double, "
      "longitude double, total_docks long, has_kiosk boolean, ingested_at timestamp")
RG = "region_id string, region_name string, ingested_at timestamp"
SS = ("station_id string, num_bikes_available long, num_ebikes_available long, num_bikes_disabled long, "
      "num_docks_available long, num_docks_disabled long, is_installed boolean, is_renting boolean, "
      "is_returning boolean, last_reported_at timestamp, ingested_at timestamp")


def stations(spark, rows=None):
    rows = rows or [("A", "Alpha", "a", "R1", 40.7, -74.0, 10, True, T0),
                    ("Z", "Zero", "z", "R1", 40.71, -74.0, 0, False, T0)]
    return spark.createDataFrame(rows, ST)


def regions(spark):
    return spark.createDataFrame([("R1", "North", T0), ("R2", "Empty", T0)], RG)


def snap(sid, bikes, docks, t, bd=0, dd=0, inst=True, rent=True, ret=True):
    return (sid, bikes, 0, bd, docks, dd, inst, rent, ret, t, t)


def test_rates_and_orphans(spark):
    status = spark.createDataFrame([
        snap("A", 15, 2, T0),          # more bikes than docks -> capped at 1.0
        snap("A", None, 2, T0 + dt.timedelta(minutes=30)),  # NULL bikes -> NULL rate, never 1.0
        snap("Z", 3, 3, T0),           # zero-dock station -> NULL rates
        snap("Q", 3, 3, T0)], SS)      # unknown station -> NULL metadata and rates
    h = {(r.station_id, r.ingested_at): r for r in
         status_history(status, stations_enriched(stations(spark), regions(spark))).collect()}
    assert h[("A", T0)].bike_availability_rate == 1.0
    assert h[("A", T0 + dt.timedelta(minutes=30))].bike_availability_rate is None
    assert h[("Z", T0)].bike_availability_rate is None and h[("Z", T0)].dock_availability_rate is None
    q = h[("Q", T0)]
    assert q.station_name is None and q.total_docks is None and q.bike_availability_rate is None


def test_health_edge_cases(spark):
    status = spark.createDataFrame([
        snap("A", 5, 5, T0, bd=9, dd=9),   # disabled > docks -> component 0
        snap("Q", 3, 3, T0)], SS)
    hist = status_history(status, stations_enriched(stations(spark), regions(spark)))
    h = {r.station_id: r for r in health_from_history(hist).collect()}
    assert h["A"].score_low_disabled == 0.0
    assert h["A"].health_score == 12.5 + 12.5 + 25 + 0
    assert h["A"].health_status == "at_risk"  # exactly 50 is at_risk
    assert h["Q"].health_score is None and h["Q"].health_status == "critical"
    # the windows-based and the direct path agree
    w = {r.station_id: tuple(r) for r in health_scores(availability_windows(hist)).collect()}
    assert w == {k: tuple(v) for k, v in h.items()}


def test_grain_declared_vs_as_written(spark):
    two_runs = stations(spark, [("A", "Alpha", "a", "R1", 40.7, -74.0, 10, True, T0),
                                ("A", "Alpha2", "a", "R1", 40.7, -74.0, 12, True, T0 + dt.timedelta(days=1))])
    regs = spark.createDataFrame([("R1", "North", T0), ("R1", "North", T0 + dt.timedelta(days=1))], RG)
    declared = stations_enriched(two_runs, regs).collect()
    assert len(declared) == 1 and declared[0].total_docks == 12
    assert stations_enriched(two_runs, regs, grain="as_written").count() == 4
    one_run = stations(spark)
    a = sorted(map(tuple, stations_enriched(one_run, regions(spark)).collect()))
    b = sorted(map(tuple, stations_enriched(one_run, regions(spark), grain="as_written").collect()))
    assert a == b


def test_capacity_tiers(spark):
    df = spark.createDataFrame([(1, 9), (2, 10), (3, 999), (4, 1000), (5, 0), (6, None)],
                               "id int, total_docks long")
    got = {r.id: r.capacity_tier for r in with_capacity_tier(df, capacity_tiers(spark)).collect()}
    assert got == {1: "micro", 2: "small", 3: "hub", 4: None, 5: None, 6: None}


def test_region_without_stations_keeps_nulls(spark):
    dim = spark.createDataFrame([("A", "R1", 10, 80.0, "healthy"), ("B", None, 5, 40.0, "critical")],
                                "station_id string, region_id string, total_docks long, "
                                "health_score double, health_status string")
    got = {r.region_id: r for r in dim_regions(regions(spark), dim).collect()}
    assert got["R1"].total_stations == 1 and got["R1"].healthy_stations == 1
    assert got["R2"].total_stations is None and got["R2"].healthy_stations is None
    assert set(got) == {"R1", "R2"}


def _fact(spark, rows):
    return spark.createDataFrame(rows, "station_id string, ingested_at timestamp, "
                                       "bike_availability_rate double, num_bikes_available long, "
                                       "num_docks_available long")


IV = ("station_id string, station_name string, region_name string, intervention_date date, "
      "intervention_type string")


def test_intervention_window_edges(spark):
    d0 = dt.date(2026, 4, 10)
    at = lambda k: dt.datetime.combine(d0 + dt.timedelta(days=k), dt.time(8))
    fact = _fact(spark, [("A", at(k), 0.5, 5, 5) for k in (-15, -14, -1, 0, 14, 15)])
    iv = spark.createDataFrame([("A", "Alpha", "North", d0, "rebalancing")], IV)
    p = {r.period: r.snapshot_count for r in intervention_periods(iv, fact).collect()}
    assert p == {"pre": 2, "post": 2}


def test_only_post_data(spark):
    d0 = dt.date(2026, 4, 10)
    fact = _fact(spark, [("A", dt.datetime(2026, 4, 12, 8), 0.25, 0, 5)])
    iv = spark.createDataFrame([("A", "Alpha", "North", d0, "maintenance")], IV)
    r = intervention_results(iv, fact, significance=True).first()
    assert r.pre_avg_availability is None and r.post_avg_availability == 0.25
    assert r.availability_delta is None and r.intervention_outcome == "no_change"
    assert r.pre_snapshot_count is None and r.post_empty_snapshots == 1
    assert r.z_score is None


def test_approx_distinct_option(spark):
    from dockstat.plans.context import Models
    from dockstat.plans.marts_ops import fleet_availability
    fact = Models.of(spark, "/root/testdata/sf0.01").fact
    exact = {r.ingested_at: r.total_stations for r in fleet_availability(fact, F.to_date("ingested_at")).collect()}
    approx = {r.ingested_at: r.total_stations
              for r in fleet_availability(fact, F.to_date("ingested_at"), approx=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= max(2, 0.15 * exact[k]) for k in exact)
