"""Station-shaped inputs derived from the benchmark tables.

There are no bike-share tables in the benchmark data, so these views map
the benchmark tables onto the feed's shape (stations from customers, status
snapshots from events, bikes from suppliers, interventions from customers).  The same mapping is written in SQL for the DuckDB
oracle (:mod:`dockstat.plans.oracle`).  Every view is a pure projection or
join of whole tables, so the work grows with the data.

Every customer is a station and has an intervention.  One event in thirteen reports an
id that no customer has (``-1 - user_id``): snapshots of stations unknown to
station_information, which keep NULL metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed timestamp of the one station_information / system_regions run the
# fixtures represent.
FIXTURE_RUN = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_STATION_EXPRS = [
    "c_custkey as station_id", "c_name as station_name", "c_mktsegment as short_name",
    "n_regionkey as region_id",
    "cast(40.6 as double) + cast((c_custkey * 53) % 997 as double) / 4000 as latitude",
    "cast(-74.05 as double) + cast((c_custkey * 71) % 991 as double) / 4000 as longitude",
    "cast((c_custkey * 7) % 70 as bigint) as total_docks", "c_nationkey % 2 = 0 as has_kiosk",
]


def _customer_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))


def v_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations with region names already attached (flat view)."""
    r = table(spark, sf_dir, "region")
    j = _customer_nation(spark, sf_dir).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    exprs = _STATION_EXPRS[:4] + ["r_name as region_name"] + _STATION_EXPRS[4:]
    return j.selectExpr(*exprs)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged-shape station rows (no region name) of one feed run."""
    return _customer_nation(spark, sf_dir).selectExpr(
        *_STATION_EXPRS, f"timestamp_ntz'{FIXTURE_RUN}' as ingested_at")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged-shape region rows of one feed run."""
    return table(spark, sf_dir, "region").selectExpr(
        "r_regionkey as region_id", "r_name as region_name", f"timestamp_ntz'{FIXTURE_RUN}' as ingested_at")


STATUS_EXPRS = [
    "case when event_id % 13 = 5 then -1 - user_id else user_id end as station_id",
    "floor(value) % 40 as num_bikes_available",
    "(floor(value) % 40) % 7 as num_ebikes_available",
    "event_id % 4 as num_bikes_disabled",
    "(event_id * 13) % 45 as num_docks_available",
    "event_id % 3 as num_docks_disabled",
    "event_type <> 'error' as is_installed",
    "event_id % 7 <> 0 as is_renting",
    "event_id % 11 <> 0 as is_returning",
    "ts as last_reported_at",
    "ts as ingested_at",
]


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged-shape station_status snapshots: one per event."""
    return table(spark, sf_dir, "events").selectExpr(*STATUS_EXPRS)


def bikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged-shape free-bike positions: one per supplier, one feed run."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as bike_id",
        "cast(40.6 as double) + cast((s_suppkey * 37) % 1000 as double) / 4000 as latitude",
        "cast(-74.05 as double) + cast((s_suppkey * 91) % 1000 as double) / 4000 as longitude",
        "s_suppkey % 9 = 0 as is_reserved",
        "s_suppkey % 10 = 0 as is_disabled",
        "case when s_suppkey % 3 = 0 then 'electric_bike' else 'classic' end as vehicle_type_id",
        f"timestamp_ntz'{FIXTURE_RUN}' as ingested_at")


_KIND = ("case c_custkey % 3 when 0 then 'rebalancing' when 1 then 'maintenance' "
         "else 'capacity_increase' end")


def interventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervention records: one per customer, dated inside the event month."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as station_id",
        "date_add(date'2024-01-08', cast(c_custkey % 15 as int)) as intervention_date",
        f"{_KIND} as intervention_type",
        f"concat('planned ', {_KIND}, ' for ', c_name) as notes")


def pricing_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged-shape pricing plan rows: one per order (plan = customer)."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as plan_id", "o_orderpriority as plan_name", "'USD' as currency",
        "o_totalprice as price", "o_orderstatus = 'F' as is_taxable",
        "cast(o_orderkey as string) as description", "o_orderdate as ingested_at",
        "o_orderkey as _tiebreak")


# -- raw-shaped (string) feeds, as landed by the ingest step ---------------------

def _iso(ts) -> F.Column:
    """ISO-8601 UTC text of a wall-clock UTC timestamp, like ``datetime.isoformat()``."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


_RUN_ISO = "2024-01-01T00:00:00+00:00"


def raw_station_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = v_stations(spark, sf_dir)
    return s.select(
        F.col("station_id").cast("string").alias("station_id"),
        F.col("station_name").alias("name"), "short_name",
        F.col("region_id").cast("string").alias("region_id"),
        F.col("latitude").cast("string").alias("lat"), F.col("longitude").cast("string").alias("lon"),
        F.col("total_docks").cast("string").alias("capacity"),
        F.col("has_kiosk").cast("string").alias("has_kiosk"),
        F.lit(_RUN_ISO).alias("ingested_at"))


def raw_station_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = status(spark, sf_dir)
    counts = ["num_bikes_available", "num_ebikes_available", "num_bikes_disabled",
              "num_docks_available", "num_docks_disabled"]
    flags = ["is_installed", "is_renting", "is_returning"]
    return s.select(
        F.col("station_id").cast("string").alias("station_id"),
        *[F.col(c).cast("string").alias(c) for c in counts + flags],
        F.unix_seconds(F.col("last_reported_at").cast("timestamp")).cast("string").alias("last_reported"),
        _iso(F.col("ingested_at")).alias("ingested_at"))


def raw_system_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("region_id"), F.col("r_name").alias("name"),
        F.lit(_RUN_ISO).alias("ingested_at"))


def raw_free_bike_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bikes(spark, sf_dir)
    return b.select(
        F.col("bike_id").cast("string").alias("bike_id"),
        F.col("latitude").cast("string").alias("lat"), F.col("longitude").cast("string").alias("lon"),
        F.col("is_reserved").cast("string").alias("is_reserved"),
        F.col("is_disabled").cast("string").alias("is_disabled"),
        "vehicle_type_id", F.lit(_RUN_ISO).alias("ingested_at"))


def raw_pricing_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pricing_plans(spark, sf_dir)
    return p.select(
        F.col("plan_id").cast("string").alias("plan_id"), F.col("plan_name").alias("name"), "currency",
        F.col("price").cast("string").alias("price"),
        F.col("is_taxable").cast("string").alias("is_taxable"), "description",
        _iso(F.col("ingested_at")).alias("ingested_at"))
