"""Reading a table of vectors: kept rows and numpy matrices of Arrow lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockstat.llm.common import importable


def finite(v: Column) -> Column:
    """True for an array that is there, not empty, and has neither null nor non-finite entries."""
    return F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))),
                      F.lit(False))


def kept_vectors(df: DataFrame, id_col: str, vec_col: str, *more: Column) -> DataFrame:
    """`vec_id`, `v` (doubles) and the columns of `more`, of the rows whose vector is finite."""
    importable(df.sparkSession)
    return df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                     F.col(f"`{vec_col}`").cast("array<double>").alias("v"), *more).filter(finite(F.col("v")))


def common_length(kept: DataFrame) -> tuple[int, int]:
    """(rows, entries of each vector); ValueError if vectors differ in length."""
    r = kept.agg(F.count("*").alias("n"), F.min(F.size("v")).alias("lo"), F.max(F.size("v")).alias("hi")).first()
    if r.lo != r.hi:
        raise ValueError(f"vectors have {r.lo} to {r.hi} entries; this operator needs one length")
    return r.n, r.lo or 0


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """(rows, dim) doubles of a list column without nulls."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
