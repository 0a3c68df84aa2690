"""Newest row per key kept as a state table, folded forward load by load.

``newest`` is a partial aggregate: the newest row of (state with new rows) is that of all rows
ever loaded, so a fold reads the state and the loads after it, never the whole feed.  The
state holds one row per key.  Each fold publishes a version named after the last load in it;
a fold that is repeated, or finds nothing new, changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockstat.sources.sinks import append_version, prune_versions, read_latest_version, read_table

KEEP_VERSIONS = 7


def newest(df: DataFrame, keys: Sequence[str], order: str = "ingested_at") -> DataFrame:
    """The row with the greatest ``order`` of each key, NULL being the least; ties go by all columns."""
    rest = [c for c in df.columns if c not in (*keys, order)]
    place = F.struct(order, *rest)
    return df.groupBy(*keys).agg(F.max(place).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def loads_after(spark: SparkSession, raw_path: str, schema: T.StructType, after: int, upto: int | None = None) -> DataFrame:
    """Rows of a raw table's loads ``after < load <= upto``; the other partitions are not listed in the scan."""
    rows = read_table(spark, raw_path, schema).filter(F.col("load") > after)
    return rows if upto is None else rows.filter(F.col("load") <= upto)


def fold(spark: SparkSession, raw_path: str, schema: T.StructType, state_path: str, keys: Sequence[str],
         order: str = "ingested_at") -> tuple[DataFrame, int]:
    """(newest row per key over all loads, number of the last load in it; -1 before the first)."""
    state, version = read_latest_version(spark, state_path)
    done = -1 if version is None else int(version)
    upto = loads_after(spark, raw_path, schema, done).agg(F.max("load")).first()[0]
    if upto is None:
        return (state if state is not None else read_table(spark, raw_path, schema).drop("ingest_date", "load").limit(0)), done
    fresh = loads_after(spark, raw_path, schema, done, upto).drop("ingest_date", "load")
    append_version(newest(fresh if state is None else state.unionByName(fresh), keys, order), state_path, f"{upto:012d}")
    prune_versions(spark, state_path, KEEP_VERSIONS)
    return read_latest_version(spark, state_path)[0], upto
