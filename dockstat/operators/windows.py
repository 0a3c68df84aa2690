"""Per-station snapshot windows: rolling mean, lag and recency rank.

One plan, whatever the size: windows are partitioned by (station, UTC day), so a
station that holds a large share of all snapshots is spread over its days.  The few
rows a day needs from before it (the last ``n - 1`` snapshots, for the rolling frame and
the lag) come from one row per station-day that holds its newest snapshots; the recency rank
adds the number of snapshots of later days, a total minus a running sum over per-day counts.
The snapshots are read and shuffled once, by (station, day): the station-days are computed
from the same shuffle as the windows, and join the windowed rows where they lie.  (Spark
reuses a shuffle only if no persisted table stands below it: pass a stored table, or a
history made with ``read_again``; with others the rows are read and shuffled twice.)

Snapshots of a station are in one total order: ``ingested_at`` (NULL first), then
``last_reported_at``, then the reported values (:data:`TIE_COLUMNS`).  Only rows equal in
all of these are interchangeable.  NULL stations are one station, and NULL times a day
of their own before all others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockstat.functions.columns import rate_to_bp

WINDOW_COLUMNS = ["station_id", "station_name", "region_id", "region_name", "total_docks",
                  "last_reported_at", "ingested_at", "num_bikes_available", "num_bikes_disabled",
                  "num_docks_available", "num_docks_disabled", "is_installed", "is_renting",
                  "is_returning", "bike_availability_rate", "dock_availability_rate"]
OUT_COLUMNS = WINDOW_COLUMNS + ["rolling_3_bike_availability_rate", "prev_bikes_available",
                                "prev_docks_available", "snapshot_recency_rank"]
TIE_COLUMNS = ["last_reported_at", "num_bikes_available", "num_docks_available", "num_bikes_disabled",
               "num_docks_disabled", "is_installed", "is_renting", "is_returning"]


def join_null_safe(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
    """Inner join on ``cols`` under which NULL equals NULL; they come once, from the left."""
    right = right.withColumnsRenamed({c: f"_right_{c}" for c in cols})
    on = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in cols])
    return left.join(right, on).drop(*(f"_right_{c}" for c in cols))


def _rate_sum(rows: Column, rate: str) -> tuple[Column, Column]:
    """Sum and number of the rates (in basis points) of an array of snapshots."""
    rates = F.filter(F.transform(rows, lambda r: rate_to_bp(r[rate])), lambda x: x.isNotNull())
    return F.aggregate(rates, F.lit(0).cast("long"), lambda a, x: a + x), F.size(rates)


def _windowed(df: DataFrame, n: int, key: str, order: str, rate: str | None, lags: dict[str, str],
              bucket: Column | None = None) -> DataFrame:
    """``df`` with ``_rolling`` (mean of the last n rates), one lag column per entry of ``lags``
    (source -> name) and ``_rank`` (1 = newest), per ``key`` in the total order."""
    out_cols = df.columns
    ties = [c for c in TIE_COLUMNS if c in out_cols and c != order]
    m = max(n - 1, 1)
    # the group is a struct, in which NULL equals NULL: one column to shuffle, join and window by
    group = F.struct(F.col(key).alias("key"), (F.to_date(order) if bucket is None else bucket).alias("bucket"))
    b = df.withColumn("_g", group).repartition("_g")

    def ordered(*by, descending=False):
        return Window.partitionBy(*by).orderBy(*(F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first()
                                                 for c in [order, *ties]))

    # one row per station-day: its number of snapshots and the newest m of them, oldest first; it reads
    # whole rows, as the windows below do, so both stand on the same shuffle
    days = (b.select("_g", F.struct(*out_cols).alias("_row"), F.row_number().over(ordered("_g", descending=True)).alias("_r"),
                     F.count(F.lit(1)).over(Window.partitionBy("_g")).alias("_cnt"))
            .filter(F.col("_r") <= m).groupBy("_g")
            .agg(F.first("_cnt").alias("_cnt"), F.collect_list(F.struct("_r", "_row")).alias("_newest"))
            .select("_g", "_cnt", F.transform(F.array_sort("_newest", lambda x, y: y["_r"] - x["_r"]),
                                              lambda x: x["_row"]).alias("_tail")))

    # with the snapshots in later days, and the m snapshots before the day (each earlier day
    # holds at least one, so the previous m days have them)
    by_day = Window.partitionBy("_g.key").orderBy(F.col("_g.bucket").asc_nulls_first())
    so_far = F.sum("_cnt").over(by_day.rowsBetween(Window.unboundedPreceding, 0))
    before = F.flatten(F.collect_list("_tail").over(by_day.rowsBetween(-m, -1)))
    days = days.select("_g", (F.sum("_cnt").over(Window.partitionBy("_g.key")) - so_far + F.col("_cnt")).alias("_from_here"),
                       F.when(F.size(before) > m, F.slice(before, -m, m)).otherwise(before).alias("_halo"))

    # frames within the day; its first snapshots reach back into the halo
    w = ordered("_g")
    local = {"_pos": F.row_number().over(w)} | {name: F.lag(c).over(w) for c, name in lags.items()}
    if rate:
        bp, frame = rate_to_bp(rate), w.rowsBetween(-(n - 1), 0)
        local |= {"_sum": F.sum(bp).over(frame), "_seen": F.count(bp).over(frame)}
    rows = b.select("_g", *out_cols, *[c.alias(name) for name, c in local.items()]).join(days, "_g")
    last = F.element_at("_halo", -1)
    extra = [F.when((F.col("_pos") == 1) & (F.size("_halo") > 0), last[c]).otherwise(F.col(name)).alias(name)
             for c, name in lags.items()]
    if rate:
        short = F.greatest(n - F.col("_pos"), F.lit(0))
        total, seen = _rate_sum(F.slice("_halo", F.greatest(F.size("_halo") - short + 1, F.lit(1)), short), rate)
        reach = F.col("_pos") < n
        extra.append((F.try_divide(F.coalesce("_sum", F.lit(0)) + F.when(reach, total).otherwise(0),
                                   F.col("_seen") + F.when(reach, seen).otherwise(0)) / 10000).alias("_rolling"))
    return rows.select(*out_cols, *extra, (F.col("_from_here") - F.col("_pos") + 1).cast("long").alias("_rank"))


LAGS = {"num_bikes_available": "prev_bikes_available", "num_docks_available": "prev_docks_available"}


def rolling_mean_rate(df: DataFrame, n: int = 3, key: str = "station_id", order: str = "ingested_at",
                      rate: str = "bike_availability_rate",
                      out: str = "rolling_3_bike_availability_rate") -> DataFrame:
    """Mean of the last ``n`` snapshots' rate (current included), NULLs skipped, unrounded."""
    return _windowed(df, n, key, order, rate, {}).withColumnRenamed("_rolling", out).drop("_rank")


def with_lag(df: DataFrame, cols=tuple(LAGS), key: str = "station_id", order: str = "ingested_at",
             names=tuple(LAGS.values())) -> DataFrame:
    """Previous snapshot's value per station; NULL for the first snapshot."""
    return _windowed(df, 2, key, order, None, dict(zip(cols, names))).drop("_rank")


def with_recency_rank(df: DataFrame, key: str = "station_id", order: str = "ingested_at",
                      out: str = "snapshot_recency_rank") -> DataFrame:
    """1 for the newest snapshot of each station, counting up into the past."""
    return _windowed(df, 1, key, order, None, {}).withColumnRenamed("_rank", out)


def availability_windows(history: DataFrame, n: int = 3, bucket: Column | None = None) -> DataFrame:
    """Rolling ``n``-snapshot mean, previous counts and recency rank per station.

    ``bucket`` replaces the UTC day by another time bucket; the result is the same.
    """
    out = _windowed(history.select(*WINDOW_COLUMNS), n, "station_id", "ingested_at",
                    "bike_availability_rate", LAGS, bucket)
    return out.withColumnsRenamed({"_rolling": "rolling_3_bike_availability_rate",
                                   "_rank": "snapshot_recency_rank"}).select(*OUT_COLUMNS)
