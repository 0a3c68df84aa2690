"""Physical-plan shape checks for the scale-critical operators."""

from dockstat.operators.nearest import _search
from dockstat.plans import fixtures as fx
from dockstat.plans.context import Models
from dockstat.plans.experiments import intervention_results, station_interventions
from dockstat.plans.marts_ops import station_daily_performance
from dockstat.operators.quality import check_no_future
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def outer_plan(df) -> str:
    """The plan without the text of cached (persisted) sub-plans."""
    return "\n".join(line for line in plan(df).splitlines() if "InMemoryRelation" not in line
                     and not line.startswith(" " * 60))


def test_status_join_broadcasts_the_station_dimension(spark):
    h = Models(spark, SF).history
    p = plan(h)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "InMemoryTableScan" in p  # the measured dimension is reused, not recomputed


def test_daily_rollup_aggregates_before_the_shuffle(spark):
    p = plan(station_daily_performance(Models(spark, SF).fact))
    assert p.count("HashAggregate") >= 2  # partial (map side) + final
    assert "Window" not in p.split("Exchange")[0]


def test_scan_reads_only_needed_columns_and_pushes_filters(spark):
    p = plan(check_no_future(Models(spark, SF).fact, "2024-01-25 00:00:00"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in p
    events_scan = [line for line in p.splitlines() if "events.parquet" in line][0]
    assert "event_type" not in events_scan and "props" not in events_scan


def test_windows_shuffle_whole_rows_once(spark):
    """The station-days are computed from the windows' own shuffle: AQE reuses its stage."""
    df = Models(spark, SF).windows
    df.collect()
    p = plan(df)
    final = p[:p.index("Initial Plan")]
    shuffles = [line for line in final.splitlines() if "REPARTITION_BY_COL" in line]
    assert ["ReusedExchange" in line for line in shuffles] == [False, True]
    assert final.count("events.parquet") == 1
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_a_dimension_of_wide_values_is_not_broadcast(spark):
    """The bound is on bytes as well as on rows."""
    from dockstat.operators.joins import bounded_broadcast, measured_size
    dim = spark.range(1000).select("id", F.repeat(F.lit("x"), 10_000).alias("text"), F.struct("id").alias("s"))
    rows, size = measured_size(dim)
    assert rows == 1000 and 10_000_000 < size < 10_200_000
    assert measured_size(dim.limit(0)) == (0, 0)
    fact = spark.range(100).withColumnRenamed("id", "id2")

    def hinted(max_bytes):
        joined = fact.join(bounded_broadcast(dim, max_bytes=max_bytes), F.col("id") == F.col("id2"))
        return "strategy=broadcast" in joined._jdf.queryExecution().analyzed().toString()
    assert not hinted(1 << 20) and hinted(1 << 24)


def test_the_station_pyramid_goes_down_in_few_jobs(spark, monkeypatch):
    """Local levels are one checkpoint each; the pyramid's 14 levels take one checkpoint and the result's own job."""
    from pyspark.sql.classic.dataframe import DataFrame
    from dockstat.operators.nearest import nearest_station
    calls, held = [], DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, *a, **k: calls.append(1) or held(self, *a, **k))
    m = Models(spark, SF)
    bikes = fx.bikes(spark, SF).withColumns({"latitude": F.lit(0.0), "longitude": F.lit(0.0)})
    out = nearest_station(bikes, m.enriched)
    assert len(calls) == 4 and out.filter("nearest_station_id is null").isEmpty()


def test_nearest_candidates_are_an_equi_join(spark):
    m = Models(spark, SF)
    bikes = fx.bikes(spark, SF).select("bike_id", F.col("latitude").alias("bike_latitude"),
                                       F.col("longitude").alias("bike_longitude"), "is_reserved",
                                       "is_disabled", "vehicle_type_id", "ingested_at")
    st = m.enriched.select(F.col("station_id").alias("nearest_station_id"),
                           F.col("station_name").alias("nearest_station_name"), "region_id", "region_name",
                           F.col("latitude").alias("_slat"), F.col("longitude").alias("_slon"))
    p = plan(_search(bikes, F.broadcast(st), 2 ** 15))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
    assert "BroadcastHashJoin" in p


def test_intervention_band_join_keeps_the_fact_in_place(spark):
    m = Models(spark, SF)
    iv = station_interventions(fx.interventions(spark, SF), m.dim_stations)
    p = outer_plan(intervention_results(iv, m.fact))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "BroadcastHashJoin" in p
