"""SCD type-2 history stored as deltas: a run writes only the versions it closes and opens.

Layout of a table folder::

    run=<stamp>/part=open     versions opened by the run
    run=<stamp>/part=closed   versions closed by the run, whole rows with their valid_to
    run=<stamp>/part=base     every version open after the run (only where it compacted)
    _manifests/<n>            which of them count (see sources.manifest)

The open versions are the newest base and everything opened since, without the ids closed
since.  A run joins them with the incoming rows once, full outer on the key, and writes the
rows that differ in one job, split by ``part``; unchanged versions are neither rewritten
nor copied, and closed history is never read again.  Once more rows were closed since the
base than are open, the run also writes a new base, so what a run scans stays below twice
the open versions and the rewriting is paid for by the changes that led to it.

A run is committed by one manifest.  One that fails before leaves folders that no manifest
names and that its repetition replaces; repeating a committed run, or running an earlier
stamp, changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dockstat.operators.scd2 import SCD_COLUMNS, compare, ended, open_versions
from dockstat.sources.manifest import commit, forget, manifest


def run_stamp(as_of: str) -> str:
    """``'YYYY-MM-DD HH:MM:SS'`` as a folder name that sorts by time."""
    return as_of.replace("-", "").replace(":", "").replace(" ", "T")


def _read(spark: SparkSession, path: str, state: dict, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], state["schema"])
    return spark.read.schema(state["schema"]).parquet(*[f"{path}/{f}" for f in folders])


def _since_base(state: dict, part: str) -> list[str]:
    return [f"run={r['run']}/part={part}" for r in state["runs"]
            if r[part] and (r["run"] > state["base"] if state["base"] else True)]


def read_open(spark: SparkSession, path: str) -> DataFrame | None:
    """The versions that are open now; None before the first run."""
    state = manifest(spark, path)
    return None if state is None else _open(spark, path, state)


def _open(spark: SparkSession, path: str, state: dict) -> DataFrame:
    base = [f"run={state['base']}/part=base"] if state["base"] else []
    opened = _read(spark, path, state, base + _since_base(state, "open"))
    closed = _since_base(state, "closed")
    if not closed:
        return opened
    return opened.join(_read(spark, path, state, closed).select("dbt_scd_id"), "dbt_scd_id", "left_anti") \
        .select(*opened.columns)


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """Every version, closed and open; None before the first run."""
    state = manifest(spark, path)
    if state is None:
        return None
    closed = [f"run={r['run']}/part=closed" for r in state["runs"] if r["closed"]]
    return _read(spark, path, state, closed).unionByName(_open(spark, path, state))


def delta(open_rows: DataFrame, current: DataFrame, key: str, check_cols: Sequence[str], as_of: str,
          hard_deletes: bool = True) -> DataFrame:
    """Versions to close and to open, told apart by ``part``: one join, both sides read once.

    ``current`` holds one row per key; a NULL key is a key.
    """
    cols = [c for c in open_rows.columns if c not in SCD_COLUMNS]
    both = compare(open_rows, current.select(*cols), key, check_cols, as_of, hard_deletes)
    closed = F.struct(F.lit("closed").alias("part"), ended(as_of).alias("row"))
    opened = F.struct(F.lit("open").alias("part"), F.col("_new").alias("row"))
    return both.select(F.explode(F.array_compact(F.array(F.when(F.col("_close"), closed), F.when(F.col("_open"), opened)))).alias("_v")) \
        .select("_v.part", "_v.row.*")


def apply_run(current: DataFrame, path: str, key: str, check_cols: Sequence[str], as_of: str,
              hard_deletes: bool = True) -> dict:
    """One snapshot run against the stored history; returns the committed manifest."""
    spark, run = current.sparkSession, run_stamp(as_of)
    state = manifest(spark, path)
    if state is not None and state["runs"][-1]["run"] >= run:
        return state
    if state is None:
        rows = open_versions(current, key, as_of).withColumn("part", F.lit("open"))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("part").schema)
        state = {"runs": [], "base": None, "schema": schema}
    else:
        rows = delta(_open(spark, path, state), current, key, check_cols, as_of, hard_deletes)
    counted = Observation()
    rows.observe(counted, F.count_if(F.col("part") == "open").alias("open"),
                 F.count_if(F.col("part") == "closed").alias("closed")) \
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("part").parquet(f"{path}/run={run}")
    n = counted.get
    state = state | {"runs": [*state["runs"], {"run": run, "open": n["open"], "closed": n["closed"]}]}
    since = [r for r in state["runs"] if not state["base"] or r["run"] > state["base"]]
    dead = sum(r["closed"] for r in since)
    live = sum(r["open"] - r["closed"] for r in state["runs"])
    if dead > live:
        _open(spark, path, state).write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .parquet(f"{path}/run={run}/part=base")
        state = state | {"base": run}
    commit(spark, path, state)
    return state


def drop_old_bases(spark: SparkSession, path: str, keep: int = 7) -> list[str]:
    """Remove manifests before the newest ``keep``, and bases that only those name."""
    return forget(spark, path, lambda s: [f"run={s['base']}/part=base"] if s["base"] else [], keep)
