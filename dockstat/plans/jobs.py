"""The two scheduled jobs, as ``spark-submit`` entry points.

* ``refresh`` (every 30 minutes): landed feed files -> raw tables (append)
  -> staging -> intermediate models -> staging/intermediate checks.
* ``daily``: seeds -> marts (incremental fact, dimensions, operations and
  experiment marts) -> SCD-2 snapshots -> all checks.

Tables live under one root folder (``<root>/raw/<feed>``,
``<root>/marts/<table>``, ``<root>/snapshots/<table>``).  The daily job's
cost follows the new data: the fact takes only snapshots past its
watermark, the date-grained marts are rebuilt only for the dates that
received snapshots (dynamic partition overwrite), the region-hour mart is
rolled up from mergeable per-day parts (sums and station bitmaps), and
bikes are matched to stations only for runs not matched before.  Stations,
regions and plans are kept folded to their newest rows (``<root>/state``), so
no run reads their feeds' history, and SCD-2 history is stored as deltas.
The station-grained dimensions are small and rebuilt whole.

Usage: ``spark-submit --py-files dockstat.zip dockstat/plans/jobs.py refresh|daily --root R
--landing L [--seeds S] [--as-of 'YYYY-MM-DD HH:MM:SS']``
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockstat.operators.enrich import stations_enriched, status_history
from dockstat.operators.health import health_from_history, top_snapshots
from dockstat.operators.incremental import incremental_merge, table_watermark
from dockstat.operators.joins import release_broadcasts
from dockstat.operators.nearest import nearest_station
from dockstat.operators.quality import (check_no_future, check_not_null, check_rate_valid,
                                        check_score_bounded, run_checks)
from dockstat.operators.folded import fold, loads_after
from dockstat.operators.scd2 import CAPACITY_CHECK, OPERATIONAL_CHECK, capacity_rows, operational_rows
from dockstat.operators.scd2_store import apply_run, drop_old_bases, run_stamp
from dockstat.operators.staging import (stage_bikes, stage_pricing_plans, stage_regions,
                                        stage_station_status, stage_stations)
from dockstat.plans.experiments import intervention_results, station_interventions
from dockstat.plans.marts_core import (FACT_COLUMNS, dim_pricing_plans, dim_regions, dim_stations,
                                       fct_status_snapshots)
from dockstat.plans.marts_ops import (fleet_availability, number_stations, region_hour_presence, region_hourly_parts,
                                      region_hourly_rollup, station_daily_performance, station_ids)
from dockstat.session import build_session
from dockstat.sources.gbfs import FEEDS, raw_schema
from dockstat.sources.manifest import publish_table, read_published
from dockstat.sources.quarantine import load_new_files, quarantined
from dockstat.sources.seeds import capacity_tiers, read_interventions
from dockstat.sources.sinks import (append_version, children, newest_partition, prune_versions,
                                   read_latest_version, read_table, table_exists)


@dataclass
class Paths:
    root: str
    landing: str | None = None
    seeds: str | None = None

    def raw(self, feed: str) -> str:
        return f"{self.root}/raw/{feed}"

    def quarantine(self, feed: str) -> str:
        return f"{self.root}/quarantine/{feed}"

    def mart(self, name: str) -> str:
        return f"{self.root}/marts/{name}"

    def snapshot(self, name: str) -> str:
        return f"{self.root}/snapshots/{name}"

    def state(self, name: str) -> str:
        return f"{self.root}/state/{name}"


def publish_version(spark: SparkSession, df: DataFrame, path: str, run: str) -> DataFrame:
    """Publish ``df`` as version ``run`` unless it is already there; return the newest version."""
    _, version = read_latest_version(spark, path)
    if version is None or version < run:
        append_version(df, path, run)
    return read_latest_version(spark, path)[0]


#: Feeds that describe entities, with their keys: kept folded to the newest row of each.
ENTITY_KEYS = {"station_information": ["station_id"], "system_regions": ["region_id"], "system_pricing_plans": ["plan_id"]}


def raw_table(spark: SparkSession, p: Paths, feed: str) -> DataFrame:
    return read_table(spark, p.raw(feed), raw_schema(feed))


def current_entities(spark: SparkSession, p: Paths) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Newest row of each entity, folded forward over the loads not yet in the state, and the last load of each feed."""
    folded = {feed: fold(spark, p.raw(feed), raw_schema(feed), p.state(feed), keys) for feed, keys in ENTITY_KEYS.items()}
    return {f: rows for f, (rows, _) in folded.items()}, {f: load for f, (_, load) in folded.items()}


def staged(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Staged views of raw rows by feed; feeds that are left out are not staged."""
    views = {
        "station_information": ("stage_stations", stage_stations),
        "station_status": ("stage_station_status", stage_station_status),
        "system_regions": ("stage_regions", stage_regions),
        "free_bike_status": ("stage_bikes", stage_bikes),
        "system_pricing_plans": ("stage_pricing_plans", lambda df: stage_pricing_plans(df, on_error="null")),
    }
    return {views[feed][0]: views[feed][1](rows) for feed, rows in raw.items()}


def _since(df: DataFrame, last) -> DataFrame:
    if last is None:
        return df
    return df.filter((F.col("ingest_date") >= F.lit(last).cast("date")) & (F.col("ingested_at") > F.lit(last)))


def run_refresh(spark: SparkSession, p: Paths) -> DataFrame:
    """Load every landed file not loaded yet, once, then check what was loaded.

    The checks read only the rows of this run's loads (``load=`` partitions), and the current
    stations and regions are folded forward over the loads that are not in them yet.  A feed
    that has not landed yet, or landed without items, is an empty table.  A file that can't be
    read and an item that doesn't fit are put aside without stopping their feed; the result
    counts what is put aside (``quarantine_<feed>``), and a mended file comes in with the next load.
    """
    loads = {}
    for feed in FEEDS:
        landed = f"{p.landing}/{feed}"
        made = load_new_files(spark, landed, feed, p.raw(feed), p.quarantine(feed),
                              f"{p.root}/raw/_loaded/{feed}") if children(spark, landed) else []
        loads[feed] = [load.number for load in made]
    entities, _ = current_entities(spark, p)
    st = staged(entities)
    new = staged({feed: raw_table(spark, p, feed).filter(F.col("load").isin(loads[feed])) for feed in FEEDS})
    enriched = stations_enriched(st["stage_stations"], st["stage_regions"])
    history = status_history(new["stage_station_status"], enriched)
    try:
        checks = run_checks(check_not_null(new), {"rate_valid": check_rate_valid(history),
                                                  "no_future": check_no_future(history)}, raise_on_failure=True)
        return checks.unionByName(run_checks(failing={
            f"quarantine_{feed}": quarantined(spark, p.quarantine(feed)) for feed in FEEDS}))
    finally:
        release_broadcasts()


def _table_watermark(spark: SparkSession, path: str):
    return table_watermark(spark, path, "ingested_at", "snapshot_date") if table_exists(spark, path) else None


def _after(df: DataFrame, last) -> DataFrame:
    if last is None:
        return df
    return df.filter((F.col("snapshot_date") >= F.lit(last).cast("date")) & (F.col("ingested_at") > F.lit(last)))


def station_numbers(spark: SparkSession, p: Paths, fact: DataFrame, run: str) -> DataFrame:
    """Numbers of all stations seen so far; a run appends those of its new stations."""
    path = p.state("station_numbers")
    newest = newest_partition(spark, path, "snapshot_run")
    known = spark.read.parquet(path) if newest else None
    if newest is None or newest < run:
        ids = station_ids(fact)
        if known is not None:
            ids = ids.join(known, "station_id", "left_anti")
        start = known.agg(F.max("number")).first()[0] + 1 if known is not None else 0
        append_version(number_stations(ids, start), path, run)
    return spark.read.parquet(path).select("station_id", "number")


def run_daily(spark: SparkSession, p: Paths, as_of: str | None = None, keep_versions: int = 7) -> DataFrame:
    """Rebuild the marts and take the day's SCD-2 snapshots.

    Large inputs are read only past their watermarks: raw status and bike
    rows newer than what the fact and the bike match already hold (pruned
    to their ``ingest_date`` partitions), and the loads of stations, regions
    and plans that are not in their folded tables yet.
    """
    as_of = as_of or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    run = run_stamp(as_of)
    fact_path, bikes_path = p.mart("status_snapshots"), p.mart("bike_nearest_station")
    last, last_bike = _table_watermark(spark, fact_path), _table_watermark(spark, bikes_path)

    # The run's upper bound is fixed before anything else is written, so a retry of the run
    # covers the same snapshots even if more have landed since.
    bounds, version = read_latest_version(spark, p.mart("daily_bounds"))
    if version is None or version < run:
        append_version(raw_table(spark, p, "station_status").agg(F.max("ingested_at").alias("upper")), p.mart("daily_bounds"), run)
        bounds, _ = read_latest_version(spark, p.mart("daily_bounds"))
    upper = bounds.first()["upper"]

    entities, entity_loads = current_entities(spark, p)
    st = staged(entities)
    state, _ = read_latest_version(spark, p.mart("daily_state"))
    done = None if state is None else state.first()
    checked = {} if done is None else done["entity_loads"]
    new = staged({
        "station_status": _since(raw_table(spark, p, "station_status"), last),
        "free_bike_status": _since(raw_table(spark, p, "free_bike_status"), last_bike)} | {
        feed: loads_after(spark, p.raw(feed), raw_schema(feed), checked.get(feed, -1), load) for feed, load in entity_loads.items()})
    new["stage_station_status"] = new["stage_station_status"].filter(F.col("ingested_at") <= F.lit(upper))
    enriched = stations_enriched(st["stage_stations"], st["stage_regions"])
    fact = incremental_merge(fact_path, fct_status_snapshots(status_history(new["stage_station_status"], enriched)))

    # Everything below reads the fact rows past the watermark of the last
    # *completed* daily run (a job-state table written last), so a retry
    # after a failure part-way redoes the same work instead of skipping it.
    done_wm = None if done is None else done["fact_watermark"]
    fresh = _after(fact, done_wm).filter(F.col("ingested_at") <= F.lit(upper))
    touched = None if done_wm is None else [r[0] for r in fresh.select("snapshot_date").distinct().collect()]

    # Newest 3 snapshots per station, folded forward from the previous run:
    # top-3 of (previous top-3 + snapshots merged since) -- no history rescan.
    top, version = read_latest_version(spark, p.mart("station_top_snapshots"))
    if version is None or version < run:
        merged = fresh.select(*FACT_COLUMNS)
        if top is not None:
            # a run that failed after this step may have folded some of these in already
            merged = top.select(*FACT_COLUMNS).unionByName(merged).dropDuplicates(["station_id", "ingested_at"])
        append_version(top_snapshots(merged, 3), p.mart("station_top_snapshots"), run)
        top, _ = read_latest_version(spark, p.mart("station_top_snapshots"))
    health = health_from_history(top)

    # Whole-table marts are published as versions: readers keep the previous
    # one until the new one is committed, and a crash never leaves them empty.
    stations_dim = publish_version(spark, dim_stations(enriched, health, capacity_tiers(spark)),
                                   p.mart("dim_stations"), run)
    publish_version(spark, dim_regions(st["stage_regions"], stations_dim), p.mart("dim_regions"), run)
    publish_version(spark, dim_pricing_plans(st["stage_pricing_plans"]), p.mart("dim_pricing_plans"), run)

    # Date-grained marts: only the dates that received snapshots are rebuilt
    # (all dates on the first run), so the job's cost follows the new data.
    if touched is None or touched:
        days = fact if touched is None else fact.filter(F.col("snapshot_date").isin(touched))
        publish_table(station_daily_performance(days), p.mart("station_daily"), partition_by="snapshot_date")
        publish_table(fleet_availability(days).withColumn("run_date", F.to_date("ingested_at")),
                      p.mart("fleet_runs"), partition_by="run_date")
        publish_table(region_hourly_parts(days), p.mart("region_hourly_parts"), partition_by="snapshot_date")
        publish_table(region_hour_presence(days, station_numbers(spark, p, days, run)), p.mart("region_hour_presence"),
                      partition_by="snapshot_date")
        publish_version(spark, region_hourly_rollup(read_published(spark, p.mart("region_hourly_parts")),
                                                    read_published(spark, p.mart("region_hour_presence"))),
                        p.mart("region_hourly"), run)

    # Nearest station for bike snapshots not matched yet (same watermark rule).
    incremental_merge(bikes_path, nearest_station(new["stage_bikes"], enriched), keys=("bike_id", "ingested_at"))

    if p.seeds:
        iv = station_interventions(read_interventions(spark, f"{p.seeds}/station_interventions.csv"),
                                   stations_dim)
        iv = publish_version(spark, iv, p.mart("station_interventions"), run)
        publish_version(spark, intervention_results(iv, fact), p.mart("intervention_results"), run)

    apply_run(capacity_rows(enriched), p.snapshot("station_capacity_history"), "station_id", CAPACITY_CHECK, as_of)
    apply_run(operational_rows(top), p.snapshot("station_operational_history"), "station_id", OPERATIONAL_CHECK, as_of)

    try:
        checks = run_checks(check_not_null(new), {
            "rate_valid": check_rate_valid(fresh),
            "score_bounded": check_score_bounded(health),
            "no_future": check_no_future(fresh)}, raise_on_failure=True)
        loads = F.map_from_arrays(F.array(*[F.lit(f) for f in entity_loads]), F.array(*[F.lit(n).cast("long") for n in entity_loads.values()]))
        append_version(bounds.select(F.col("upper").alias("fact_watermark"), loads.alias("entity_loads")), p.mart("daily_state"), run)
        for table in ("daily_bounds", "dim_stations", "dim_regions", "dim_pricing_plans", "region_hourly",
                      "station_top_snapshots", "station_interventions", "intervention_results", "daily_state"):
            prune_versions(spark, p.mart(table), keep=keep_versions)
        for table in ("station_capacity_history", "station_operational_history"):
            drop_old_bases(spark, p.snapshot(table), keep=keep_versions)
        return checks
    finally:
        release_broadcasts()


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="dockstat.plans.jobs")
    ap.add_argument("job", choices=["refresh", "daily"])
    ap.add_argument("--root", required=True)
    ap.add_argument("--landing")
    ap.add_argument("--seeds")
    ap.add_argument("--as-of")
    a = ap.parse_args(argv)
    spark = build_session(app=f"dockstat-{a.job}")
    p = Paths(a.root, a.landing, a.seeds)
    result = run_refresh(spark, p) if a.job == "refresh" else run_daily(spark, p, a.as_of)
    result.show(truncate=False)


if __name__ == "__main__":
    main()
