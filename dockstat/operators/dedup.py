"""Keep the newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    if xs is None:
        return []
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def latest_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence | str = "ingested_at",
                   tiebreak: Sequence | str | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by order desc, tiebreak desc) = 1``.

    Catalyst turns the rank filter into a partial per-partition limit ahead
    of the shuffle (WindowGroupLimit), so a hot key is cut down map-side and
    only one candidate per key and map partition crosses the network.
    Explicit ``tiebreak`` columns make the choice deterministic.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_cols = [c.desc_nulls_last() for c in _cols(order) + _cols(tiebreak)]
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
