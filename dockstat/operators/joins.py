"""Dimension joins with a proven broadcast bound."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockstat.session import checkpoint_root

# A station dimension is a few thousand rows per system.  Both bounds are measured: a
# broadcast holds at most a million rows, and at most 256 MiB of values.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 256 << 20


_PERSISTED: list[DataFrame] = []


def release_broadcasts() -> None:
    """Unpersist what the operators persisted for a job: dimensions measured by
    :func:`bounded_broadcast` and per-bucket counts of the window plans."""
    while _PERSISTED:
        _PERSISTED.pop().unpersist()


def _value_bytes(field: T.StructField) -> Column:
    """Bytes of one value: the measured length of texts and nested values, 16 for the others."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0)) + 16
    return F.lit(16)


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and bytes of their values, in one aggregate."""
    width = reduce(Column.__add__, [_value_bytes(f) for f in df.schema.fields], F.lit(16)).cast("long")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return row["n"], row["bytes"]


def bounded_broadcast(dim: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES, read_again: bool = False) -> DataFrame:
    """Broadcast ``dim`` only when it is measured to hold at most ``max_rows`` rows and ``max_bytes`` of values.

    The dimension is persisted (memory, spilling to disk) and measured once; the measured
    size is the proof.  Within the bounds the broadcast hint keeps the large side of the join
    in place (no shuffle of the fact); beyond them the plain join lets Spark shuffle both
    sides, with AQE splitting skewed partitions.  ``max_rows=None`` skips the check and
    leaves the choice to Spark's own size estimate.

    ``read_again`` is for plans that read the joined rows more than once: the dimension is then
    checkpointed, because adaptive plans don't reuse a shuffle that stands above a persisted table.
    """
    dim, _, small = measured(dim, max_rows, max_bytes, read_again)
    return F.broadcast(dim) if small else dim


def measured(dim: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES,
             read_again: bool = False) -> tuple[DataFrame, int | None, bool]:
    """``dim`` as :func:`bounded_broadcast` keeps it, its rows if counted, and whether it is within the bounds."""
    if max_rows is None:
        return dim, None, False
    if read_again:
        checkpoint_root(dim.sparkSession)
        dim = dim.checkpoint(eager=True)
    else:
        dim = dim.persist(StorageLevel.MEMORY_AND_DISK)
        _PERSISTED.append(dim)
    rows, size = measured_size(dim)
    return dim, rows, rows <= max_rows and size <= max_bytes
