"""Slowly changing dimension, type 2, with the "check" strategy.

A snapshot table holds the tracked columns plus ``dbt_scd_id``,
``dbt_updated_at``, ``dbt_valid_from`` and ``dbt_valid_to`` (NULL while a
version is current).  Each run compares the current open versions with the
incoming rows on the key:

* key unchanged (every check column equal, NULL-safe) -> kept as is;
* a check column changed -> the open version is closed at ``as_of`` and a
  new version opens at ``as_of``;
* new key -> a version opens;
* key absent from the input (with ``hard_deletes``) -> the open version closes;
* a key that comes back after being closed simply opens a new version.

One full outer join meets the open versions with the input; versions closed before pass
through it unmatched, so a run reads the snapshot once and a chain of runs has a plan that
grows by one join a run.  :mod:`dockstat.operators.scd2_store` keeps the history on disk and
writes only what a run changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockstat.operators.windows import join_null_safe

SCD_COLUMNS = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def _as_of(as_of: str):
    return F.lit(as_of).cast("timestamp_ntz")


def open_versions(current: DataFrame, key: str, as_of: str) -> DataFrame:
    """``current`` as versions that open at ``as_of``."""
    return current.select(
        *current.columns,
        F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(as_of))).alias("dbt_scd_id"),
        _as_of(as_of).alias("dbt_updated_at"),
        _as_of(as_of).alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"))


def compare(versions: DataFrame, current: DataFrame, key: str, check_cols: Sequence[str], as_of: str,
            hard_deletes: bool = True) -> DataFrame:
    """``_old`` (a stored version) beside ``_new`` (the incoming row as a version), and what to do.

    ``_close``: the version ends now; ``_open``: the incoming row starts one.  Versions closed
    before meet nothing.  A NULL key is a key.
    """
    columns = versions.columns
    old = versions.select(F.struct(*columns).alias("_old"), F.col(key).alias("_old_key"),
                          F.col("dbt_valid_to").isNull().alias("_is_open"))
    new = open_versions(current, key, as_of).select(F.struct(*columns).alias("_new"), F.col(key).alias("_new_key"))
    both = old.join(new, F.col("_old_key").eqNullSafe(F.col("_new_key")) & F.col("_is_open"), "full_outer")
    met = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    same = met
    for c in check_cols:
        same &= F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    ends = (F.lit(True) if hard_deletes else met) & ~same
    return both.select("_old", "_new", (F.coalesce(F.col("_is_open"), F.lit(False)) & ends).alias("_close"),
                       (F.col("_new").isNotNull() & ~same).alias("_open"))


def ended(as_of: str) -> Column:
    """``_old`` closed at ``as_of``."""
    return F.col("_old").withField("dbt_valid_to", _as_of(as_of))


def scd2_check(snapshot: DataFrame | None, current: DataFrame, key: str, check_cols: Sequence[str],
               as_of: str, hard_deletes: bool = True) -> DataFrame:
    """Apply one snapshot run; returns the full snapshot table after the run.

    ``current`` must hold one row per key (see
    :func:`dockstat.operators.dedup.latest_per_key`); ``as_of`` is the run
    time as ``'YYYY-MM-DD HH:MM:SS'``.
    """
    if snapshot is None:
        return open_versions(current, key, as_of)
    both = compare(snapshot, current, key, check_cols, as_of, hard_deletes)
    kept = F.when(F.col("_close"), ended(as_of)).otherwise(F.col("_old"))
    return both.select(F.explode(F.array_compact(F.array(kept, F.when(F.col("_open"), F.col("_new"))))).alias("_v")) \
        .select("_v.*").select(*snapshot.columns)


def scd2_from_history(history: DataFrame, key: str, time: str, check_cols: Sequence[str],
                      keep: Sequence[str] = (), bucket: Column | None = None) -> DataFrame:
    """Validity intervals of the check columns, derived from every snapshot.

    A run of consecutive snapshots with the same check values is one version:
    ``valid_from`` is its first snapshot, ``valid_to`` the first snapshot of the next
    version (NULL for the current one).  Unlike periodic snapshot runs this sees outages
    shorter than the run interval.  ``duration_seconds`` is NULL while the version is open.
    Snapshots are ordered by ``time`` (NULL first), then by the check and kept columns, so
    tied times have one order; a NULL key is one key.

    One plan, whatever the size:

    1. per (key, UTC day), a partial aggregate: the last row's check values, carried into
       the next day by a header row;
    2. one shuffle of the snapshots by (key, day): a row starts a version when its values
       differ from the row before; within its day it belongs to the local version that the
       running count of starts gives (0 continues the day before);
    3. partial aggregates per (key, day, local version); a day's offset is the number of
       starts in earlier days, and offset + local version numbers the versions of a key;
    4. a second partial aggregate merges their parts, and each part closes the version
       before its own -- no window ever runs over all versions of a key.
    """
    cols = [c for c in [*check_cols, *keep] if c != time]
    chk = F.struct(*check_cols)
    b = history.select(key, time, *cols).withColumn("_bk", F.to_date(time) if bucket is None else bucket)
    place = F.struct(time, *cols)
    by_day = Window.partitionBy(key).orderBy(F.col("_bk").asc_nulls_first())
    header = b.groupBy(key, "_bk").agg(F.max_by(chk, place).alias("_last")) \
        .select(key, "_bk", F.lag("_last").over(by_day).alias("_prev"), F.lit(0).alias("_kind"))
    rows = b.withColumn("_kind", F.lit(1)).unionByName(header, allowMissingColumns=True)
    w = Window.partitionBy(key, "_bk").orderBy("_kind", *(F.col(c).asc_nulls_first() for c in [time, *cols]))
    before = F.lag(F.when(F.col("_kind") == 0, F.col("_prev")).otherwise(chk)).over(w)
    rows = rows.withColumn("_start", F.when((F.col("_kind") == 1) & (before.isNull() | ~chk.eqNullSafe(before)), 1)
                           .otherwise(0)) \
        .withColumn("_local", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0))) \
        .filter(F.col("_kind") == 1)
    parts = rows.groupBy(key, "_bk", "_local").agg(
        F.count(F.lit(1)).alias("_n"), F.min(time).alias("_from"), F.max(time).alias("_to"),
        F.min_by(F.struct(*check_cols, *keep), place).alias("_vals"), F.min(place).alias("_place"))
    starts = parts.groupBy(key, "_bk").agg(F.max("_local").alias("_starts"))
    offsets = starts.withColumn("_offset", F.sum("_starts").over(by_day) - F.col("_starts"))
    parts = join_null_safe(parts, offsets.drop("_starts"), [key, "_bk"]) \
        .select(key, (F.col("_local") + F.col("_offset")).alias("version"), "_local", "_n", "_from", "_to",
                "_vals", "_place")
    closes = parts.filter("version > 1") \
        .select(key, (F.col("version") - 1).alias("version"), F.col("_from").alias("valid_to"))
    versions = parts.unionByName(closes, allowMissingColumns=True).groupBy(key, "version").agg(
        F.min("_from").alias("valid_from"), F.min("valid_to").alias("valid_to"), F.max("_to").alias("last_seen"),
        F.sum("_n").alias("snapshots"), F.min_by("_vals", "_place").alias("_vals"))
    return versions.select(
        key, F.col("version").cast("long").alias("version"),
        *[F.col(f"_vals.{c}").alias(c) for c in [*check_cols, *keep]], "valid_from", "valid_to", "last_seen", "snapshots",
        F.floor(F.timestamp_diff("MICROSECOND", F.col("valid_from"), F.col("valid_to")) / 1000000)
        .alias("duration_seconds"))


# Snapshot configurations: tracked columns and check columns per table.
CAPACITY_COLUMNS = ["station_id", "station_name", "region_id", "region_name", "total_docks", "has_kiosk",
                    "latitude", "longitude", "ingested_at"]
CAPACITY_CHECK = ["total_docks", "has_kiosk"]
OPERATIONAL_COLUMNS = ["station_id", "station_name", "region_id", "region_name", "is_installed",
                       "is_renting", "is_returning", "num_bikes_available", "num_docks_available",
                       "last_reported_at", "ingested_at"]
OPERATIONAL_CHECK = ["is_installed", "is_renting", "is_returning"]


def _latest(df: DataFrame, cols) -> DataFrame:
    from dockstat.operators.dedup import latest_per_key
    tiebreak = "last_reported_at" if "last_reported_at" in df.columns else None
    return latest_per_key(df, "station_id", "ingested_at", tiebreak).select(*cols)


def _of_roster(rows: DataFrame, source: DataFrame, roster: str) -> DataFrame:
    if roster != "latest_batch":
        return rows
    return rows.join(source.agg(F.max("ingested_at").alias("ingested_at")), "ingested_at", "left_semi").select(*rows.columns)


def capacity_rows(enriched: DataFrame, roster: str = "history") -> DataFrame:
    """Each station's newest row, as the capacity snapshot takes it.

    ``roster="latest_batch"`` keeps only stations of the newest load, so a
    station that leaves the feed is closed (otherwise an append-only input
    never loses a key).
    """
    return _of_roster(_latest(enriched, CAPACITY_COLUMNS), enriched, roster)


def operational_rows(history: DataFrame, roster: str = "history") -> DataFrame:
    """Each station's newest snapshot, as the operational snapshot takes it."""
    return _of_roster(_latest(history, OPERATIONAL_COLUMNS), history, roster)


def snapshot_capacity(snapshot: DataFrame | None, enriched: DataFrame, as_of: str,
                      roster: str = "history") -> DataFrame:
    """Capacity history (docks, kiosk) of each station's newest row."""
    return scd2_check(snapshot, capacity_rows(enriched, roster), "station_id", CAPACITY_CHECK, as_of)


def snapshot_operational(snapshot: DataFrame | None, history: DataFrame, as_of: str,
                         roster: str = "history") -> DataFrame:
    """Operational-flag history of each station's newest snapshot."""
    return scd2_check(snapshot, operational_rows(history, roster), "station_id", OPERATIONAL_CHECK, as_of)
