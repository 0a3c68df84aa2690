"""Registry of runnable queries and their oracle SQL.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame over the benchmark
tables in ``sf_dir``; ``ORACLE[name]`` is the same result stated in SQL
for DuckDB.  Column names match one to one.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockstat.functions import columns as C
from dockstat.operators.tiers import with_capacity_tier
from dockstat.operators.windows import rolling_mean_rate, with_lag, with_recency_rank, WINDOW_COLUMNS
from dockstat.plans import oracle as O
from dockstat.plans.context import Models
from dockstat.plans.marts_core import dim_pricing_plans
from dockstat.plans.marts_ops import (fleet_availability, number_stations, region_hour_presence, region_hourly_availability,
                                      region_hourly_parts, region_hourly_rollup, station_ids, top_priority_stations)
from dockstat.plans import fixtures as fx
from dockstat.operators.dedup import latest_per_key
from dockstat.operators.incremental import incremental_merge
from dockstat.operators.nearest import nearest_station
from dockstat.operators.quality import (NOT_NULL, check_no_future, check_not_null, check_rate_valid,
                                        check_score_bounded, run_checks)
from dockstat.operators.ranges import range_lookup
from dockstat.operators.scd2 import scd2_check, scd2_from_history, snapshot_capacity, snapshot_operational
from dockstat.operators.scd2_store import apply_run, read_history
from dockstat.operators.staging import (stage_bikes, stage_pricing_plans, stage_regions, stage_station_status,
                                        stage_stations)
from dockstat.session import use_utc, work_path
from dockstat.operators.enrich import stations_enriched
from dockstat.plans import jobs
from dockstat.plans.landed import land
from dockstat.sources.gbfs import FEEDS, read_gbfs
from dockstat.sources.seeds import bike_types, read_interventions, with_bike_type
from dockstat.sources.manifest import publish_table, read_published
from dockstat.sources.sinks import append_raw, read_latest_version
from dockstat.streaming.ingest import stream_status_to_fact
from dockstat.plans.experiments import (intervention_periods, intervention_results, station_interventions,
                                        with_station_names)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Add a query; every query runs with the session pinned to UTC."""
    def deco(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# -- joins and enrichment ----------------------------------------------------

@register("stations_enriched", O.q("enriched", "select * from enriched"))
def q_stations_enriched(spark, sf_dir):
    return Models.of(spark, sf_dir).enriched


@register("status_history", O.q("history", "select * from history"))
def q_status_history(spark, sf_dir):
    return Models.of(spark, sf_dir).history


@register("capacity_tiers", O.q(["enriched", "tiers"], """
select s.station_id, s.total_docks, ct.tier_name as capacity_tier,
       ct.description as capacity_tier_description
from enriched s left join tiers ct on s.total_docks between ct.min_docks and ct.max_docks"""))
def q_capacity_tiers(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return with_capacity_tier(m.enriched.select("station_id", "total_docks"), m.tiers)


_BANDS = """select n_name as band, cast(n_nationkey * 9876.5 as double) as low,
  cast(case when n_nationkey % 5 = 0 then 1000000000000 else n_nationkey * 19876.25 + 1000 end as double) as high from nation"""


@register("price_bands", f"""
select o_orderkey, cast(o_totalprice as double) as price, band from orders
left join ({_BANDS}) on cast(o_totalprice as double) between low and high""")
def q_price_bands(spark, sf_dir):
    """Orders in overlapping price bands, fractional and up to 10^12 wide."""
    prices = fx.table(spark, sf_dir, "orders").selectExpr("o_orderkey", "cast(o_totalprice as double) as price")
    bands = fx.table(spark, sf_dir, "nation").selectExpr("n_name as band", "cast(n_nationkey * 9876.5 as double) as low", """
        cast(case when n_nationkey % 5 = 0 then 1000000000000 else n_nationkey * 19876.25 + 1000 end as double) as high""")
    return range_lookup(prices, "price", bands, "low", "high", ["band"])


# -- windows -----------------------------------------------------------------

@register("rolling_availability", O.q("windows", """
select station_id, ingested_at, bike_availability_rate, rolling_3_bike_availability_rate from windows"""))
def q_rolling(spark, sf_dir):
    h = Models.of(spark, sf_dir).history_read_again.select(*WINDOW_COLUMNS)
    return rolling_mean_rate(h).select("station_id", "ingested_at", "bike_availability_rate",
                                       "rolling_3_bike_availability_rate")


@register("availability_lag", O.q("windows", """
select station_id, ingested_at, num_bikes_available, num_docks_available,
       prev_bikes_available, prev_docks_available from windows"""))
def q_lag(spark, sf_dir):
    h = Models.of(spark, sf_dir).history_read_again.select(*WINDOW_COLUMNS)
    return with_lag(h).select("station_id", "ingested_at", "num_bikes_available", "num_docks_available",
                              "prev_bikes_available", "prev_docks_available")


@register("recency_rank", O.q("windows", "select station_id, ingested_at, snapshot_recency_rank from windows"))
def q_recency(spark, sf_dir):
    h = Models.of(spark, sf_dir).history_read_again.select(*WINDOW_COLUMNS)
    return with_recency_rank(h).select("station_id", "ingested_at", "snapshot_recency_rank")


@register("availability_windows", O.q("windows", "select * from windows"))
def q_windows(spark, sf_dir):
    return Models.of(spark, sf_dir).windows


# -- column functions ------------------------------------------------------------

_BUCKET_SQL = """case when {r} is null then 'unknown' when {r} = 0 then 'empty' when {r} < 0.20 then 'critical'
  when {r} < 0.40 then 'low' when {r} < 0.70 then 'moderate' when {r} < 0.90 then 'good' else 'full' end"""


@register("availability_bucket", O.q("history", f"""
select station_id, ingested_at, bike_availability_rate,
  {_BUCKET_SQL.format(r='bike_availability_rate')} as bike_availability_bucket,
  {_BUCKET_SQL.format(r='dock_availability_rate')} as dock_availability_bucket
from history"""))
def q_bucket(spark, sf_dir):
    return Models.of(spark, sf_dir).history.select(
        "station_id", "ingested_at", "bike_availability_rate",
        C.availability_bucket("bike_availability_rate").alias("bike_availability_bucket"),
        C.availability_bucket("dock_availability_rate").alias("dock_availability_bucket"))


@register("composite_health_score", O.q("history", """
select station_id, ingested_at,
  floor((((coalesce(bb, 0) + coalesce(bd, 0)) * 3 * d1 + k * 10000 * d1 + low) * 2 + d1 * 12)
        / (d1 * 12 * 2)) / 100 as composite_health_score
from (select station_id, ingested_at,
        cast(round(bike_availability_rate * 10000) as bigint) as bb,
        cast(round(dock_availability_rate * 10000) as bigint) as bd,
        cast(is_installed as int) + cast(is_renting as int) + cast(is_returning as int) as k,
        case when total_docks = 0 then 1 else total_docks end as d1,
        case when total_docks = 0 then 30000
             when total_docks - num_bikes_disabled - num_docks_disabled is null then null
             else greatest(total_docks - num_bikes_disabled - num_docks_disabled, 0) * 30000 end as low
      from history)"""))
def q_composite(spark, sf_dir):
    return Models.of(spark, sf_dir).history.select(
        "station_id", "ingested_at",
        C.composite_health_score("bike_availability_rate", "dock_availability_rate", "is_installed",
                                 "is_renting", "is_returning", "num_bikes_disabled",
                                 "num_docks_disabled", "total_docks").alias("composite_health_score"))


# -- health and dimensions ---------------------------------------------------------

@register("health_scores", O.q("health", "select * from health"))
def q_health(spark, sf_dir):
    return Models.of(spark, sf_dir).health


@register("dim_stations", O.q("dim_st", "select * from dim_st"))
def q_dim_stations(spark, sf_dir):
    return Models.of(spark, sf_dir).dim_stations


@register("dim_regions", O.q(["dim_st", "rg"], """
select r.region_id, r.region_name, s.total_stations, s.total_docks, s.avg_health_score,
  s.healthy_stations, s.at_risk_stations, s.critical_stations, r.ingested_at
from rg r left join (
  select region_id, count(*) as total_stations, cast(sum(total_docks) as bigint) as total_docks,
    floor(sum(cast(round(health_score * 100) as bigint)) / nullif(count(health_score), 0) + 0.5) / 100
      as avg_health_score,
    cast(count_if(health_status = 'healthy') as bigint) as healthy_stations,
    cast(count_if(health_status = 'at_risk') as bigint) as at_risk_stations,
    cast(count_if(health_status = 'critical') as bigint) as critical_stations
  from dim_st group by region_id) s using (region_id)"""))
def q_dim_regions(spark, sf_dir):
    return Models.of(spark, sf_dir).dim_regions


@register("fct_status_snapshots", O.q("fact", "select * from fact"))
def q_fact(spark, sf_dir):
    return Models.of(spark, sf_dir).fact


# -- operations marts --------------------------------------------------------------

@register("station_daily_performance", O.q("daily", "select * from daily"))
def q_daily(spark, sf_dir):
    return Models.of(spark, sf_dir).daily


_HOURLY_BODY = f"""
select region_id, region_name, cast(hour(ingested_at) as int) as hour_of_day,
  cast(dayofweek(ingested_at) + 1 as int) as day_of_week,
  count(*) as snapshot_count, count(distinct station_id) as stations_observed,
  {O.avg4_sql('bike_availability_rate')} as avg_bike_availability,
  {O.avg4_sql('dock_availability_rate')} as avg_dock_availability,
  min(bike_availability_rate) as min_bike_availability,
  max(bike_availability_rate) as max_bike_availability,
  cast(count_if(num_bikes_available = 0) as bigint) as empty_station_snapshots,
  {O.ratio4_sql('count_if(num_bikes_available = 0)', 'count(*)')} as empty_station_rate
from fact group by 1, 2, 3, 4"""
_HOURLY_SQL = O.q("fact", _HOURLY_BODY)


@register("region_hourly_availability", _HOURLY_SQL)
def q_hourly(spark, sf_dir):
    return region_hourly_availability(Models.of(spark, sf_dir).fact)


@register("region_hourly_from_parts", _HOURLY_SQL)
def q_hourly_parts(spark, sf_dir):
    """The incremental form: per-day parts and station presence, rolled up."""
    fact = Models.of(spark, sf_dir).fact
    return region_hourly_rollup(region_hourly_parts(fact), region_hour_presence(fact, number_stations(station_ids(fact))))


_FLEET_BODY = f"""
select {{run}} as ingested_at,
  count(distinct station_id) as total_stations,
  cast(sum(num_bikes_available) as bigint) as total_bikes_available,
  cast(sum(num_ebikes_available) as bigint) as total_ebikes_available,
  cast(sum(num_bikes_available) - sum(num_ebikes_available) as bigint) as total_classic_bikes_available,
  cast(sum(num_bikes_disabled) as bigint) as total_bikes_disabled,
  cast(sum(num_docks_available) as bigint) as total_docks_available,
  cast(sum(num_docks_disabled) as bigint) as total_docks_disabled,
  {O.ratio4_sql('sum(num_bikes_available)', 'sum(num_bikes_available) + sum(num_docks_available)')}
    as fleet_utilisation_rate,
  {O.ratio4_sql('sum(num_ebikes_available)', 'sum(num_bikes_available)')} as ebike_share_rate,
  cast(count_if(num_bikes_available = 0) as bigint) as empty_stations,
  cast(count_if(num_docks_available = 0) as bigint) as full_stations,
  cast(count_if(not is_installed or not is_renting) as bigint) as inactive_stations
from fact group by 1"""


@register("fleet_availability", O.q("fact", _FLEET_BODY.format(run="date_trunc('hour', ingested_at)")))
def q_fleet(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return fleet_availability(m.fact, m.hour_run_key())


@register("top_priority_stations", O.q("daily", """
select * from daily
order by rebalancing_priority_score desc nulls last, snapshot_date desc, station_id asc, total_docks asc
limit 20"""))
def q_top_priority(spark, sf_dir):
    return top_priority_stations(Models.of(spark, sf_dir).daily, 20)


@register("dim_pricing_plans", """
select plan_id, plan_name, currency, price, is_taxable, description, ingested_at from (
  select o_custkey as plan_id, o_orderpriority as plan_name, 'USD' as currency, o_totalprice as price,
    o_orderstatus = 'F' as is_taxable, cast(o_orderkey as varchar) as description, o_orderdate as ingested_at,
    row_number() over (partition by o_custkey order by o_orderdate desc nulls last, o_orderkey desc nulls last) as rn
  from orders) where rn = 1""")
def q_dim_pricing_plans(spark, sf_dir):
    return dim_pricing_plans(fx.pricing_plans(spark, sf_dir), tiebreak="_tiebreak")


# -- geo -------------------------------------------------------------------------

@register("haversine", O.q("enriched", f"""
select station_id, {O.km_sql(O.hav_term_sql('latitude', 'longitude', '40.6', '-74.05'))} as km_from_origin
from enriched"""))
def q_haversine(spark, sf_dir):
    return Models.of(spark, sf_dir).enriched.select(
        "station_id", C.haversine_km("latitude", "longitude", F.lit(40.6), F.lit(-74.05)).alias("km_from_origin"))


@register("nearest_station", O.q(["bk", "enriched"], f"""
select bike_id, bike_latitude, bike_longitude, is_reserved, is_disabled, vehicle_type_id,
  nearest_station_id, nearest_station_name, region_id, region_name, {O.km_sql('a')} as distance_km, ingested_at
from (select b.bike_id, b.latitude as bike_latitude, b.longitude as bike_longitude, b.is_reserved,
        b.is_disabled, b.vehicle_type_id, b.ingested_at, s.station_id as nearest_station_id,
        s.station_name as nearest_station_name, s.region_id, s.region_name,
        {O.hav_term_sql('b.latitude', 'b.longitude', 's.latitude', 's.longitude')} as a,
        row_number() over (partition by b.bike_id, b.ingested_at
          order by {O.hav_term_sql('b.latitude', 'b.longitude', 's.latitude', 's.longitude')}, s.station_id) as rn
      from bk b cross join enriched s
      where s.latitude is not null and s.longitude is not null)
where rn = 1"""))
def q_nearest(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return nearest_station(fx.bikes(spark, sf_dir), m.enriched)


_FAR_SQL = """(select bike_id, case when bike_id % 5 = 0 then 0.0 when bike_id % 7 <> 0 then latitude end as latitude,
  case when bike_id % 5 = 0 then 0.0 else longitude end as longitude, is_reserved, is_disabled, vehicle_type_id, ingested_at from bk)"""


@register("nearest_station_far", O.q(["bk", "enriched"], f"""
select b.bike_id, b.latitude as bike_latitude, b.longitude as bike_longitude, s.nearest_station_id, s.distance_km
from {_FAR_SQL} b left join (
  select bike_id, station_id as nearest_station_id, {O.km_sql('a')} as distance_km from (
    select b.bike_id, s.station_id, {O.hav_term_sql('b.latitude', 'b.longitude', 's.latitude', 's.longitude')} as a,
      row_number() over (partition by b.bike_id
        order by {O.hav_term_sql('b.latitude', 'b.longitude', 's.latitude', 's.longitude')}, s.station_id) as rn
    from {_FAR_SQL} b cross join enriched s where b.latitude is not null)
  where rn = 1) s using (bike_id)"""))
def q_nearest_far(spark, sf_dir):
    """Bikes at (0, 0), far from every station, bikes without a latitude, and every row given twice."""
    far = F.col("bike_id") % 5 == 0
    bikes = fx.bikes(spark, sf_dir).withColumns({
        "latitude": F.when(far, F.lit(0.0)).when(F.col("bike_id") % 7 != 0, F.col("latitude")),
        "longitude": F.when(far, F.lit(0.0)).otherwise(F.col("longitude"))})
    return nearest_station(bikes.unionByName(bikes), Models.of(spark, sf_dir).enriched) \
        .select("bike_id", "bike_latitude", "bike_longitude", "nearest_station_id", "distance_km")


# -- experiments -----------------------------------------------------------------

@register("station_interventions", O.q("si", "select * from si"))
def q_station_interventions(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return station_interventions(fx.interventions(spark, sf_dir), m.dim_stations)


@register("intervention_periods", O.q("ivperiods", "select * from ivperiods"))
def q_intervention_periods(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return intervention_periods(with_station_names(fx.interventions(spark, sf_dir), m.enriched), m.fact)


@register("intervention_results", O.q("ivresults", "select * from ivresults"))
def q_intervention_results(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return intervention_results(with_station_names(fx.interventions(spark, sf_dir), m.enriched), m.fact)


@register("intervention_significance", O.q("ivresults", """
select *, z_score > 1.96 as is_significant from (
  select *, case when pre_snapshot_count = 0 or post_snapshot_count = 0 then null
    else round(abs(post_avg_availability - pre_avg_availability)
               / (0.25 * sqrt(1.0 / pre_snapshot_count + 1.0 / post_snapshot_count)), 4) end as z_score
  from ivresults)"""))
def q_intervention_significance(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return intervention_results(with_station_names(fx.interventions(spark, sf_dir), m.enriched), m.fact,
                                significance=True)


# -- staging ---------------------------------------------------------------------

_ST_FLAT = """select c_custkey as station_id, c_name as station_name, c_mktsegment as short_name,
  n_regionkey as region_id,
  cast(40.6 as double) + cast((c_custkey*53)%997 as double)/4000 as latitude,
  cast(-74.05 as double) + cast((c_custkey*71)%991 as double)/4000 as longitude,
  cast((c_custkey*7)%70 as bigint) as total_docks, c_nationkey%2=0 as has_kiosk
from customer join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey"""


@register("stage_stations", f"""
select cast(station_id as varchar) as station_id, station_name, short_name,
  cast(region_id as varchar) as region_id, latitude, longitude, total_docks, has_kiosk,
  {O.RUN_TS} as ingested_at
from ({_ST_FLAT})""")
def q_stage_stations(spark, sf_dir):
    return stage_stations(fx.raw_station_information(spark, sf_dir))


@register("stage_station_status", O.q("status", """
select cast(station_id as varchar) as station_id, num_bikes_available, num_ebikes_available,
  num_bikes_disabled, num_docks_available, num_docks_disabled, is_installed, is_renting, is_returning,
  make_timestamp((epoch_us(last_reported_at) // 1000000) * 1000000) as last_reported_at, ingested_at
from status"""))
def q_stage_status(spark, sf_dir):
    return stage_station_status(fx.raw_station_status(spark, sf_dir))


@register("stage_regions", f"""
select cast(r_regionkey as varchar) as region_id, r_name as region_name, {O.RUN_TS} as ingested_at
from region""")
def q_stage_regions(spark, sf_dir):
    return stage_regions(fx.raw_system_regions(spark, sf_dir))


@register("stage_bikes", O.q("bk", """
select cast(bike_id as varchar) as bike_id, latitude, longitude, is_reserved, is_disabled,
  vehicle_type_id, ingested_at from bk"""))
def q_stage_bikes(spark, sf_dir):
    return stage_bikes(fx.raw_free_bike_status(spark, sf_dir))


@register("stage_pricing_plans", """
select cast(o_custkey as varchar) as plan_id, o_orderpriority as plan_name, 'USD' as currency,
  o_totalprice as price, o_orderstatus = 'F' as is_taxable, cast(o_orderkey as varchar) as description,
  o_orderdate as ingested_at
from orders""")
def q_stage_plans(spark, sf_dir):
    return stage_pricing_plans(fx.raw_pricing_plans(spark, sf_dir))


@register("latest_per_key", O.q("status", """
select * exclude (rn) from (
  select *, row_number() over (partition by station_id
    order by ingested_at desc nulls last, last_reported_at desc nulls last) as rn from status)
where rn = 1"""))
def q_latest_per_key(spark, sf_dir):
    return latest_per_key(fx.status(spark, sf_dir), "station_id", "ingested_at", "last_reported_at")


# -- incremental fact --------------------------------------------------------------

SPLIT_AT = "2024-01-15 00:00:00"


@register("incremental_merge", O.q("fact", "select *, cast(ingested_at as date) as snapshot_date from fact"))
def q_incremental_merge(spark, sf_dir):
    """First run loads snapshots before the split, the second run the whole feed."""
    fact = Models.of(spark, sf_dir).fact
    path = work_path(spark, "fct_status_snapshots")
    incremental_merge(path, fact.filter(F.col("ingested_at") < F.lit(SPLIT_AT).cast("timestamp_ntz")))
    return incremental_merge(path, fact)


# -- SCD type 2 ------------------------------------------------------------------------

CAP_COLS = ["station_id", "station_name", "region_id", "region_name", "total_docks", "has_kiosk",
            "latitude", "longitude", "ingested_at"]
OPS_COLS = ["station_id", "station_name", "region_id", "region_name", "is_installed", "is_renting",
            "is_returning", "num_bikes_available", "num_docks_available", "last_reported_at", "ingested_at"]
RUNS3 = ["2024-01-02 06:00:00", "2024-01-03 06:00:00", "2024-01-04 06:00:00"]


def _cap_batches(m: Models):
    cur = latest_per_key(m.enriched, "station_id", "ingested_at").select(*CAP_COLS)
    run1 = cur.filter(F.col("station_id") % 19 != 0)
    run2 = (cur.filter(F.col("station_id") % 17 != 0)
            .withColumn("total_docks", F.when(F.col("station_id") % 10 == 0, F.col("total_docks") + 5)
                        .otherwise(F.col("total_docks"))))
    return [run1, run2, cur]


_CAP_CUR = "select " + ", ".join(CAP_COLS) + " from enriched"
_CAP_SQL = [
    _CAP_CUR + " where station_id % 19 <> 0",
    _CAP_CUR.replace("total_docks,", "case when station_id % 10 = 0 then total_docks + 5 else total_docks end"
                     " as total_docks,") + " where station_id % 17 <> 0",
    _CAP_CUR,
]


def _scd_oracle(runs, key, cols, check_cols, base):
    body = O.scd2_sql(runs, key, cols, check_cols)
    return O.with_ctes(*base).rstrip("\n") + ",\n" + body[len("with "):]


@register("scd2_merge", _scd_oracle(list(zip(RUNS3, _CAP_SQL)), "station_id", CAP_COLS,
                                    ["total_docks", "has_kiosk"], ["enriched"]))
def q_scd2_merge(spark, sf_dir):
    """Three runs: unchanged, changed, new, absent and returning stations."""
    snap = None
    for as_of, batch in zip(RUNS3, _cap_batches(Models.of(spark, sf_dir))):
        snap = scd2_check(snap, batch, "station_id", ["total_docks", "has_kiosk"], as_of)
    return snap


@register("scd2_delta_store", ORACLE["scd2_merge"])
def q_scd2_delta_store(spark, sf_dir):
    """The same three runs against a stored history, each writing only what it closes and opens."""
    path = work_path(spark, "scd2")
    for as_of, batch in zip(RUNS3, _cap_batches(Models.of(spark, sf_dir))):
        apply_run(batch, path, "station_id", ["total_docks", "has_kiosk"], as_of)
    return read_history(spark, path)


@register("snap_capacity", _scd_oracle(list(zip(RUNS3[:2], [_CAP_CUR, _CAP_SQL[1]])), "station_id", CAP_COLS,
                                       ["total_docks", "has_kiosk"], ["enriched"]))
def q_snap_capacity(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    b = _cap_batches(m)
    snap = snapshot_capacity(None, m.enriched, RUNS3[0])
    return scd2_check(snap, b[1], "station_id", ["total_docks", "has_kiosk"], RUNS3[1])


OPS_RUNS = ["2024-01-15 00:00:00", "2024-02-01 00:00:00"]
_OPS_CUR = ("select " + ", ".join(OPS_COLS) + " from (select *, row_number() over (partition by station_id "
            "order by ingested_at desc nulls last, last_reported_at desc nulls last) as rn from history {w}) "
            "where rn = 1")


@register("snap_operational", _scd_oracle(
    list(zip(OPS_RUNS, [_OPS_CUR.format(w=f"where ingested_at < timestamp '{SPLIT_AT}'"), _OPS_CUR.format(w="")])),
    "station_id", OPS_COLS, ["is_installed", "is_renting", "is_returning"], ["history"]))
def q_snap_operational(spark, sf_dir):
    h = Models.of(spark, sf_dir).history
    early = h.filter(F.col("ingested_at") < F.lit(SPLIT_AT).cast("timestamp_ntz"))
    snap = snapshot_operational(None, early, OPS_RUNS[0])
    return snapshot_operational(snap, h, OPS_RUNS[1])


_INTERVALS_SQL = O.q("history", """
select station_id, version, is_installed, is_renting, is_returning, valid_from, valid_to, last_seen, snapshots,
  floor((epoch_us(valid_to) - epoch_us(valid_from)) / 1000000) as duration_seconds
from (
  select station_id, version, min(ingested_at) as valid_from, max(ingested_at) as last_seen,
    count(*) as snapshots, any_value(is_installed) as is_installed, any_value(is_renting) as is_renting,
    any_value(is_returning) as is_returning,
    lead(min(ingested_at)) over (partition by station_id order by version) as valid_to
  from (
    select *, cast(sum(case when rn = 1 or ch then 1 else 0 end)
                over (partition by station_id order by ingested_at rows between unbounded preceding and current row)
              as bigint) as version
    from (select station_id, ingested_at, is_installed, is_renting, is_returning,
            row_number() over w as rn,
            (lag(is_installed) over w) is distinct from is_installed
              or (lag(is_renting) over w) is distinct from is_renting
              or (lag(is_returning) over w) is distinct from is_returning as ch
          from history window w as (partition by station_id order by ingested_at asc nulls first)))
  group by station_id, version)""")


@register("scd2_from_history", _INTERVALS_SQL)
def q_scd2_from_history(spark, sf_dir):
    return scd2_from_history(Models.of(spark, sf_dir).history, "station_id", "ingested_at",
                             ["is_installed", "is_renting", "is_returning"])


# -- data quality ------------------------------------------------------------------------

NO_FUTURE_AS_OF = "2024-01-25 00:00:00"


def _staged(spark, sf_dir):
    return {
        "stage_stations": stage_stations(fx.raw_station_information(spark, sf_dir)),
        "stage_station_status": stage_station_status(fx.raw_station_status(spark, sf_dir)),
        "stage_regions": stage_regions(fx.raw_system_regions(spark, sf_dir)),
        "stage_bikes": stage_bikes(fx.raw_free_bike_status(spark, sf_dir)),
        "stage_pricing_plans": stage_pricing_plans(fx.raw_pricing_plans(spark, sf_dir)),
    }


def _with_gaps(spark, sf_dir):
    """The staged tables with NULLs in a name, a count and a price, for the checks to find."""
    t = _staged(spark, sf_dir)
    return t | {
        "stage_stations": t["stage_stations"].withColumn(
            "station_name", F.expr("case when cast(station_id as bigint) % 29 <> 0 then station_name end")),
        "stage_station_status": t["stage_station_status"].withColumn(
            "num_bikes_available", F.expr("nullif(num_bikes_available, 7)")),
        "stage_pricing_plans": t["stage_pricing_plans"].withColumn(
            "price", F.expr("case when cast(description as bigint) % 31 <> 0 then price end"))}


def _with_bad_rates(fact):
    """Snapshots with three disabled bikes report a rate that is too high, closed stations one below zero."""
    return fact.withColumn("bike_availability_rate", F.expr(
        "bike_availability_rate + if(num_bikes_disabled = 3, 0.75D, 0D)")) \
        .withColumn("dock_availability_rate", F.expr("dock_availability_rate - if(is_installed, 0D, 0.5D)"))


def _with_bad_scores(health):
    return health.withColumn("health_score", F.expr("health_score * 2 - 70"))


_BAD_FACT = """(select * replace (
  bike_availability_rate + if(num_bikes_disabled = 3, 0.75, 0)::double as bike_availability_rate,
  dock_availability_rate - if(is_installed, 0, 0.5)::double as dock_availability_rate) from fact)"""
_BAD_HEALTH = "(select * replace (health_score * 2 - 70 as health_score) from health)"

_NN_SOURCES = {
    "stage_stations": ("st", {"station_id": "station_id",
                              "station_name": "case when station_id % 29 <> 0 then station_name end",
                              "latitude": "latitude", "longitude": "longitude",
                              "total_docks": "total_docks", "ingested_at": "ingested_at"}),
    "stage_station_status": ("status", {"station_id": "station_id", "num_bikes_available": "nullif(num_bikes_available, 7)",
                                        "num_docks_available": "num_docks_available",
                                        "last_reported_at": "last_reported_at", "ingested_at": "ingested_at"}),
    "stage_regions": ("rg", {"region_id": "region_id", "region_name": "region_name", "ingested_at": "ingested_at"}),
    "stage_bikes": ("bk", {"bike_id": "bike_id", "ingested_at": "ingested_at"}),
    "stage_pricing_plans": ("orders", {"plan_id": "o_custkey", "plan_name": "o_orderpriority",
                                       "price": "case when o_orderkey % 31 <> 0 then o_totalprice end", "ingested_at": "o_orderdate"}),
}


def _not_null_sql() -> str:
    parts = []
    for table, cols in NOT_NULL.items():
        src, mapping = _NN_SOURCES[table]
        for c in cols:
            parts.append(f"select 'not_null_{table}_{c}' as check_name, "
                         f"cast(count_if({mapping[c]} is null) as bigint) as failures from {src}")
    return "\nunion all\n".join(parts)


_DQ_NN = O.with_ctes("st", "rg", "status", "bk") + "select * from (" + _not_null_sql() + ")"


@register("dq_not_null", _DQ_NN)
def q_dq_not_null(spark, sf_dir):
    return check_not_null(_with_gaps(spark, sf_dir))


@register("dq_rate_valid", O.q("fact", f"""
select station_id, ingested_at, bike_availability_rate, dock_availability_rate from {_BAD_FACT}
where (bike_availability_rate is not null and (bike_availability_rate < 0 or bike_availability_rate > 1))
   or (dock_availability_rate is not null and (dock_availability_rate < 0 or dock_availability_rate > 1))"""))
def q_dq_rate_valid(spark, sf_dir):
    return check_rate_valid(_with_bad_rates(Models.of(spark, sf_dir).fact))


@register("dq_score_bounded", O.q("health", f"""
select station_id, station_name, health_score from {_BAD_HEALTH} where health_score < 0 or health_score > 100"""))
def q_dq_score_bounded(spark, sf_dir):
    return check_score_bounded(_with_bad_scores(Models.of(spark, sf_dir).health))


@register("dq_no_future", O.q("fact", f"""
select station_id, ingested_at from fact where ingested_at > timestamp '{NO_FUTURE_AS_OF}'"""))
def q_dq_no_future(spark, sf_dir):
    return check_no_future(Models.of(spark, sf_dir).fact, NO_FUTURE_AS_OF)


@register("dq_summary", O.with_ctes("st", "rg", "status", "bk", "fact", "health") + f"""
select check_name, failures, failures = 0 as passed from (
  {_not_null_sql()}
  union all
  select 'rate_valid', count(*) from {_BAD_FACT}
   where (bike_availability_rate is not null and (bike_availability_rate < 0 or bike_availability_rate > 1))
      or (dock_availability_rate is not null and (dock_availability_rate < 0 or dock_availability_rate > 1))
  union all
  select 'score_bounded', count(*) from {_BAD_HEALTH} where health_score < 0 or health_score > 100
  union all
  select 'no_future', count(*) from fact where ingested_at > timestamp '{NO_FUTURE_AS_OF}')""")
def q_dq_summary(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return run_checks(check_not_null(_with_gaps(spark, sf_dir)), {
        "rate_valid": check_rate_valid(_with_bad_rates(m.fact)),
        "score_bounded": check_score_bounded(_with_bad_scores(m.health)),
        "no_future": check_no_future(m.fact, NO_FUTURE_AS_OF)})


@register("bikes_with_type", O.q("bk", """
select b.vehicle_type_id, b.bike_id, b.latitude, b.longitude, b.is_reserved, b.is_disabled, b.ingested_at,
  t.bike_type, t.is_electric, t.typical_range_miles
from bk b left join (values
  ('classic', 'Classic Bike', false, cast(null as integer)),
  ('electric_bike', 'Electric Bike', true, 30),
  ('cargo_bike', 'Cargo Bike', false, cast(null as integer)))
  as t(vehicle_type_id, bike_type, is_electric, typical_range_miles) using (vehicle_type_id)"""))
def q_bikes_with_type(spark, sf_dir):
    return with_bike_type(fx.bikes(spark, sf_dir), bike_types(spark))


# -- readers, sinks, stream and jobs, over files landed from the tables ----------------

# the status view's columns, stamped with the event's fetch: the n-th of a station and quarter day is n seconds past its start
_STATUS_SELECT = O.CTE["status"][:O.CTE["status"].rindex("from events")]
O._cte("fetched", f"""select * exclude (ingested_at, _n, _quarter), _quarter + to_seconds(_n) as ingested_at from (
  {_STATUS_SELECT}, date_trunc('day', ts) + to_hours(hour(ts) // 6 * 6) as _quarter,
    row_number() over (partition by user_id, date_trunc('day', ts), hour(ts) // 6 order by ts, event_id) - 1 as _n
  from events)""")

_GBFS_SQL = {
    "station_information": O.q("st", """
select cast(station_id as varchar) as station_id, station_name as name, short_name, latitude as lat, longitude as lon,
  cast(region_id as varchar) as region_id, total_docks as capacity, cast(has_kiosk as varchar) as has_kiosk, ingested_at
from st"""),
    "station_status": O.q("fetched", """
select cast(station_id as varchar) as station_id, num_bikes_available, num_bikes_disabled, num_docks_available,
  num_docks_disabled, cast(is_installed as varchar) as is_installed, cast(is_renting as varchar) as is_renting,
  cast(is_returning as varchar) as is_returning, epoch_us(last_reported_at) // 1000000 as last_reported,
  num_ebikes_available, ingested_at
from fetched"""),
    "system_regions": O.q("rg", "select cast(region_id as varchar) as region_id, region_name as name, ingested_at from rg"),
    "free_bike_status": O.q("bk", """
select cast(bike_id as varchar) as bike_id, latitude as lat, longitude as lon, cast(is_reserved as varchar) as is_reserved,
  cast(is_disabled as varchar) as is_disabled, vehicle_type_id, ingested_at from bk"""),
    "system_pricing_plans": f"""
select cast(o_custkey as varchar) as plan_id, o_orderpriority as name, 'USD' as currency,
  cast(cast(o_totalprice as double) as varchar) as price, cast(o_orderstatus = 'F' as varchar) as is_taxable,
  cast(o_orderkey as varchar) as description, {O.RUN_TS} as ingested_at
from orders""",
}


def _gbfs_query(feed: str):
    def run(spark, sf_dir):
        return read_gbfs(spark, land(spark, sf_dir, feed, work_path(spark, "landed")), feed)
    run.__doc__ = f"Land the {feed} feed as JSON files and read it back."
    return run


for _feed, _sql in _GBFS_SQL.items():
    register(f"gbfs_{_feed}", _sql)(_gbfs_query(_feed))


@register("raw_append", O.q("status", "select *, cast(ingested_at as date) as ingest_date from status"))
def q_raw_append(spark, sf_dir):
    """Two batches of snapshots appended to one raw table."""
    path, rows = work_path(spark, "raw"), fx.status(spark, sf_dir)
    early = F.col("ingested_at") < F.lit(SPLIT_AT).cast("timestamp_ntz")
    append_raw(rows.filter(early), path)
    append_raw(rows.filter(~early), path)
    return spark.read.parquet(path)


@register("mart_publish", O.q("daily", "select * from daily"))
def q_mart_publish(spark, sf_dir):
    """A mart published whole, then half of its days again."""
    path, daily = work_path(spark, "mart"), Models.of(spark, sf_dir).daily
    publish_table(daily, path, partition_by="snapshot_date")
    publish_table(daily.filter(F.col("snapshot_date") < F.lit(SPLIT_AT[:10]).cast("date")), path, partition_by="snapshot_date")
    return read_published(spark, path)


@register("seed_interventions", O.q("iv", """
select cast(station_id as varchar) as station_id, cast(intervention_date as date) as intervention_date, intervention_type, notes
from iv"""))
def q_seed_interventions(spark, sf_dir):
    """Interventions written as a seed file and read with its schema."""
    path = work_path(spark, "seed")
    fx.interventions(spark, sf_dir).write.option("header", True).csv(path)
    return read_interventions(spark, path).select("station_id", "intervention_date", "intervention_type", "notes")


@register("general_upsert", O.q("history", """
select * exclude (rn) from (select station_id, station_name, num_bikes_available, last_reported_at, ingested_at,
    row_number() over (partition by station_id order by ingested_at desc, last_reported_at desc) as rn from history)
where rn = 1"""))
def q_general_upsert(spark, sf_dir):
    """A table of each station's newest snapshot, upserted on the station alone."""
    path = work_path(spark, "upsert")
    rows = Models.of(spark, sf_dir).history.select("station_id", "station_name", "num_bikes_available",
                                                   "last_reported_at", "ingested_at")
    early = rows.filter(F.col("ingested_at") < F.lit(SPLIT_AT).cast("timestamp_ntz"))
    for batch in (early, rows):
        merged = incremental_merge(path, latest_per_key(batch, "station_id", "ingested_at", "last_reported_at"),
                                   keys=["station_id"], partition_col=None)
    return merged


def _fetched_fact(docks: str) -> str:
    """The fact over the landed files, which carry last_reported in whole seconds."""
    return O.with_ctes("fetched", "enriched") + f""", fact as (
  select cast(h.station_id as varchar) as station_id, e.station_name, cast(e.region_id as varchar) as region_id, e.region_name,
    {docks} as total_docks, h.num_bikes_available, h.num_ebikes_available, h.num_bikes_disabled, h.num_docks_available,
    h.num_docks_disabled, h.is_installed, h.is_renting, h.is_returning,
    date_trunc('second', h.last_reported_at) as last_reported_at, h.ingested_at,
    {O.rate_sql('h.num_bikes_available', docks)} as bike_availability_rate,
    {O.rate_sql('h.num_docks_available', docks)} as dock_availability_rate
  from fetched h left join enriched e using (station_id))
"""


_FETCHED_FACT = _fetched_fact("e.total_docks")


@register("stream_ingest", _FETCHED_FACT + """select station_id, station_name, num_bikes_available,
  bike_availability_rate, ingested_at, cast(ingested_at as date) as snapshot_date from fact""")
def q_stream_ingest(spark, sf_dir):
    """Landed status files drained by the file stream into the fact."""
    root = work_path(spark, "stream")
    stations = stations_enriched(stage_stations(fx.raw_station_information(spark, sf_dir)),
                                 stage_regions(fx.raw_system_regions(spark, sf_dir)))
    stream_status_to_fact(spark, land(spark, sf_dir, "station_status", root), stations, f"{root}/fact",
                          f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/fact").select(
        "station_id", "station_name", "num_bikes_available", "bike_availability_rate", "ingested_at", "snapshot_date")


@register("refresh_then_daily", _FETCHED_FACT + O.CTE["daily"])
def q_refresh_then_daily(spark, sf_dir):
    """All five feeds landed, refreshed into raw tables and run through the daily job."""
    root = work_path(spark, "jobs")
    p = jobs.Paths(f"{root}/warehouse", f"{root}/landing")
    for feed in FEEDS:
        land(spark, sf_dir, feed, p.landing)
    jobs.run_refresh(spark, p)
    jobs.run_daily(spark, p, as_of="2024-03-01 00:00:00")
    return read_published(spark, p.mart("station_daily"))


# -- two daily runs, the first one repeated after more files have landed ------------------

DAILY_RUNS = [SPLIT_AT, "2024-03-01 00:00:00"]
_GROWN = "{docks} + case when {id} % 10 = 0{when} then 5 else 0 end"
_TWO_RUNS_FACT = _fetched_fact("(" + _GROWN.format(docks="e.total_docks", id="e.station_id",
                                                   when=f" and h.ingested_at >= timestamp '{SPLIT_AT}'") + ")")


def _two_daily_runs(spark: SparkSession, sf_dir: str) -> jobs.Paths:
    """Snapshots up to SPLIT_AT and a daily run; then the others, with more docks at every tenth
    station, a retry of that run (which must not take them) and the next run."""
    p = jobs.Paths((root := work_path(spark, "daily")) + "/warehouse", f"{root}/landing")
    early = F.col("ingested_at").cast("timestamp") < F.lit(SPLIT_AT).cast("timestamp")
    for feed in FEEDS:
        land(spark, sf_dir, feed, p.landing, (lambda rows: rows.filter(early)) if feed == "station_status" else lambda rows: rows)
    jobs.run_refresh(spark, p)
    jobs.run_daily(spark, p, as_of=DAILY_RUNS[0])
    land(spark, sf_dir, "station_status", p.landing, lambda rows: rows.filter(~early))
    land(spark, sf_dir, "station_information", p.landing, lambda rows: rows.filter(F.col("station_id").cast("long") % 10 == 0)
         .withColumns({"capacity": (F.col("capacity").cast("long") + 5).cast("string"), "ingested_at": F.lit(SPLIT_AT)}))
    jobs.run_refresh(spark, p)
    for as_of in DAILY_RUNS:
        jobs.run_daily(spark, p, as_of=as_of)
    return p


@register("two_runs_fleet", _TWO_RUNS_FACT + _FLEET_BODY.format(run="ingested_at"))
def q_two_runs_fleet(spark, sf_dir):
    return read_published(spark, _two_daily_runs(spark, sf_dir).mart("fleet_runs")).drop("run_date")


@register("two_runs_region_hourly", _TWO_RUNS_FACT + _HOURLY_BODY)
def q_two_runs_hourly(spark, sf_dir):
    return read_latest_version(spark, _two_daily_runs(spark, sf_dir).mart("region_hourly"))[0]


def _two_runs_scd(rows: list[str], cols: list[str], check: list[str]) -> str:
    return _TWO_RUNS_FACT.rstrip("\n") + ",\n" + O.scd2_sql(list(zip(DAILY_RUNS, rows)), "station_id", cols, check)[len("with "):]


_CAP_TEXT = ("select cast(station_id as varchar) as station_id, station_name, cast(region_id as varchar) as region_id, region_name, "
             "{docks} as total_docks, has_kiosk, latitude, longitude, {at} as ingested_at from enriched")


@register("two_runs_capacity_history", _two_runs_scd([
    _CAP_TEXT.format(docks="total_docks", at="ingested_at"),
    _CAP_TEXT.format(docks=_GROWN.format(docks="total_docks", id="station_id", when=""),
                     at=f"case when station_id % 10 = 0 then timestamp '{SPLIT_AT}' else ingested_at end")],
    CAP_COLS, ["total_docks", "has_kiosk"]))
def q_two_runs_capacity(spark, sf_dir):
    return read_history(spark, _two_daily_runs(spark, sf_dir).snapshot("station_capacity_history"))


@register("two_runs_operational_history", _two_runs_scd(
    [_OPS_CUR.replace("from history", "from fact").format(w=w) for w in (f"where ingested_at < timestamp '{SPLIT_AT}'", "")],
    OPS_COLS, ["is_installed", "is_renting", "is_returning"]))
def q_two_runs_operational(spark, sf_dir):
    return read_history(spark, _two_daily_runs(spark, sf_dir).snapshot("station_operational_history"))
