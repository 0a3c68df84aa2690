"""Range lookup as an equi-join on dyadic blocks.

A range of integers is a union of aligned blocks of 2^level numbers, at most two a level, so of
O(log width) blocks; a number lies in exactly one block of each level.  Cutting the ranges
into their blocks turns ``value between low and high`` into equality of (level, block).  Bounds
and values may be fractional: blocks are of their floors, and the range itself is tested on what
meets.  Only distinct values are looked up, at the levels that occur, and the result is joined
back to the rows by value, so neither a range nor the rows are expanded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockstat.operators.joins import bounded_broadcast

LIMIT = 1 << 61  # floors are cut to this size; what lies beyond shares the outermost blocks
LEVELS = 62


def _floor(x: Column) -> Column:
    return F.floor(F.greatest(F.least(x.cast("double"), F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("long")


def _whole(x: Column, kind: str) -> Column:
    """The floor as a long; integers are taken as they are, doubles would round the large ones."""
    return x.cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else _floor(x)


def dyadic_blocks(ranges: DataFrame, low: str, high: str) -> DataFrame:
    """Each range beside its blocks: ``_level``, ``_block``.  Empty and NULL ranges have none."""
    kinds = dict(ranges.dtypes)
    lo = F.greatest(_whole(F.col(low), kinds[low]), F.lit(-LIMIT))
    hi = F.least(_whole(F.col(high), kinds[high]), F.lit(LIMIT))
    cut = ranges.filter(F.col(low) <= F.col(high)).select("*", lo.alias("_lo"), hi.alias("_hi")) \
        .withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    # blocks a..b of the level lie inside the range; those whose parent does too are left to it
    a = F.expr("-shiftright(-_lo, _level)")
    b = F.expr("shiftright(_hi + 1, _level) - 1")
    first = F.when((F.col("_a") <= F.col("_b")) & ((F.col("_a") % 2 != 0) | (F.col("_a") == F.col("_b"))), F.col("_a"))
    last = F.when((F.col("_a") < F.col("_b")) & (F.col("_b") % 2 == 0), F.col("_b"))
    return cut.select("*", a.alias("_a"), b.alias("_b")) \
        .withColumn("_block", F.explode(F.array_compact(F.array(first, last)))).drop("_lo", "_hi", "_a", "_b")


def range_lookup(df: DataFrame, value: str, ranges: DataFrame, low: str, high: str, take: Sequence[str]) -> DataFrame:
    """Left join of ``df`` to the columns ``take`` of the ranges with ``low <= value <= high``.

    A value in several ranges gives a row for each, a value in none (or NULL) one row with NULLs.
    """
    blocks = dyadic_blocks(ranges.select(F.col(low).alias("_low"), F.col(high).alias("_high"),
                                         F.struct(*take).alias("_take")), "_low", "_high")
    levels = [r[0] for r in blocks.select("_level").distinct().collect()]  # 63 at most
    whole = _whole(F.col("_value"), dict(df.dtypes)[value])
    values = df.select(F.col(value).alias("_value")).filter("_value is not null").distinct() \
        .select("_value", F.greatest(F.least(whole, F.lit(LIMIT)), F.lit(-LIMIT)).alias("_whole")) \
        .withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>"))) \
        .withColumn("_block", F.expr("shiftright(_whole, _level)"))
    met = values.join(blocks, ["_level", "_block"]).filter((F.col("_low") <= F.col("_value")) & (F.col("_value") <= F.col("_high"))) \
        .select("_value", "_take")
    return df.join(bounded_broadcast(met), F.col(value) == F.col("_value"), "left") \
        .select(*[df[c] for c in df.columns], "_take.*")
