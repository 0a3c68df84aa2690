"""Nearest station for every free bike, without a cross join.

The reference ranks every (bike, station) pair.  Here distinct positions are searched
on a latitude/longitude grid:

1. A position first meets the stations in the 3 x 3 block of cells around it (an
   equi-join on the cell key), at the finest grid and the next ``LOCAL_LEVELS - 1``
   coarser ones.  The best candidate is *certified* when it is closer than any point
   outside the block could be.  The finest grid follows the stations: where they stand closer
   than ``cell_deg`` the cells get smaller, so a block holds a few dozen stations however many
   there are, and candidates grow with the positions alone.
2. Positions far from any station go down a cell pyramid instead: from the coarsest
   cells to the finest, a cell stays only while its least possible distance is not above
   the distance of the best cell's representative station.  So a far position meets the
   cells along the near edge of the network, never all its stations.

The result is exact: it equals the brute-force ranking, ties broken by station_id.
Distances are ranked on the haversine inner term (monotone in distance); kilometres are
computed only for the winners.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockstat.functions.columns import haversine_term, term_to_km
from dockstat.operators.dedup import latest_per_key
from dockstat.operators.joins import DEFAULT_BROADCAST_ROWS, bounded_broadcast, measured
from dockstat.session import checkpoint_root

NEAREST_COLUMNS = ["bike_id", "bike_latitude", "bike_longitude", "is_reserved", "is_disabled",
                   "vehicle_type_id", "nearest_station_id", "nearest_station_name", "region_id",
                   "region_name", "distance_km", "ingested_at"]
POSITION = ["bike_latitude", "bike_longitude"]
STATION = ["nearest_station_id", "nearest_station_name", "region_id", "region_name"]
LOCAL_LEVELS = 3
#: Levels of the pyramid that one job goes down.
LEVELS_A_JOB = 7
#: Stations that share a cell of the finest grid, in the mean over stations, and the level at which cells get no smaller.
CELL_STATIONS, FINEST_LEVEL = 8, 26
#: Positions that one task searches.
TASK_POSITIONS = 2_000
#: Stations that one task puts into cells.
TASK_STATIONS = 50_000

_RAD = math.pi / 180.0
_MARGIN = 1e-9
_TERM_MARGIN = 1e-12


def _levels(cell_deg: float) -> int:
    """Power of two of cells around the globe at the finest level."""
    return max(1, int(round(math.log2(360.0 / cell_deg))))


def _cells(lat, lon, n: int, size: float):
    cx = F.pmod(F.floor((lon + 180.0) / size), F.lit(n))
    cy = F.floor((lat + 90.0) / size)
    return cx, cy


def _finest_level(stations: DataFrame, p: int) -> int:
    """First level from ``p`` on at which a station shares its cell with few others."""
    finest = max(p, FINEST_LEVEL)
    while p < finest:
        cx, cy = _cells(F.col("_slat"), F.col("_slon"), 2 ** p, 360.0 / 2 ** p)
        n = F.col("n").cast("double")
        crowd = stations.groupBy(cx.alias("_cx"), cy.alias("_cy")).agg(F.count(F.lit(1)).alias("n")) \
            .agg(F.sum(n * n) / F.sum(n)).first()[0]
        if crowd is None or crowd <= CELL_STATIONS:
            break
        p += max(1, math.ceil(math.log(crowd / CELL_STATIONS, 4)))  # a level quarters the cells
    return min(p, finest)


def _spread(positions: DataFrame) -> tuple[DataFrame, int]:
    """The positions dealt out so that a task searches at most about ``TASK_POSITIONS``, and their number."""
    rows = positions.count()
    return positions.repartition(max(1, -(-rows // TASK_POSITIONS)), *POSITION), rows


def _search(pending: DataFrame, stations: DataFrame, n: int, small: bool = False) -> DataFrame:
    """Best station in the 3 x 3 block of each pending position at a grid of ``n`` columns.

    A cell's stations are one array, so a position meets nine rows; ``small`` cells are broadcast.
    """
    size = 360.0 / n
    blat, blon = F.col("bike_latitude"), F.col("bike_longitude")
    bcx, bcy = _cells(blat, blon, n, size)
    offsets = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                        for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    probe = (pending.withColumn("_bcx", bcx).withColumn("_bcy", bcy)
             .withColumn("_o", F.explode(offsets))
             .withColumn("_cx", F.pmod(F.col("_bcx") + F.col("_o.dx"), F.lit(n)))
             .withColumn("_cy", F.col("_bcy") + F.col("_o.dy"))
             .drop("_o"))
    if n <= 2:  # the wrapped neighbours repeat cells
        probe = probe.dropDuplicates(POSITION + ["_cx", "_cy"])
    scx, scy = _cells(F.col("_slat"), F.col("_slon"), n, size)
    cells = stations.groupBy(scx.alias("_cx"), scy.alias("_cy")).agg(
        F.collect_list(F.struct("_slat", "_slon", *STATION)).alias("_stations"))
    cand = probe.join(F.broadcast(cells) if small else cells, ["_cx", "_cy"], "left")
    of_cell = F.array_min(F.transform("_stations", lambda s: F.struct(
        haversine_term(blat, blon, s["_slat"], s["_slon"]).alias("a"), *[s[c].alias(c) for c in STATION])))
    best = cand.select(*POSITION, "_bcx", "_bcy", of_cell.alias("_of_cell")) \
        .groupBy(*POSITION, "_bcx", "_bcy").agg(F.min("_of_cell").alias("_best"))
    # Angular distance from the position to the edges of its 3 x 3 block.
    south = (F.col("_bcy") - 1) * size - 90.0
    north = (F.col("_bcy") + 2) * size - 90.0
    west = (F.col("_bcx") - 1) * size - 180.0
    east = (F.col("_bcx") + 2) * size - 180.0
    lon_pos = F.pmod(blon + 180.0, F.lit(360.0)) - 180.0
    dlon = F.least(lon_pos - west, east - lon_pos) * _RAD
    dlat = F.least(blat - south, north - blat) * _RAD
    lon_gap = F.when(dlon >= math.pi / 2, F.asin(F.cos(blat * _RAD))) \
        .otherwise(F.asin(F.cos(blat * _RAD) * F.sin(dlon)))
    theta = 2 * F.asin(F.sqrt(F.least(F.col("_best.a"), F.lit(1.0))))
    ok = (F.col("_best").isNotNull() & (south >= -90.0) & (north <= 90.0)
          & (theta * (1 + _MARGIN) + _MARGIN < F.least(dlat, lon_gap)))
    return best.withColumn("_ok", ok).drop("_bcx", "_bcy")


def _least_term(blat, blon, cx, cy, size):
    """Least haversine term between a position and any point of a cell."""
    phi, south = blat * _RAD, (cy * size - 90.0) * _RAD
    north = south + size * _RAD
    west = cx * size - 180.0
    inside = F.pmod(blon - west, F.lit(360.0)) <= size

    def along(dlon):
        """Greatest cosine of the distance to the meridian ``dlon`` away, within the cell's latitudes."""
        s, c = F.sin(phi), F.cos(phi) * F.cos(dlon)
        at = F.atan2(s, c)
        ends = F.greatest(s * F.sin(south) + c * F.cos(south), s * F.sin(north) + c * F.cos(north))
        return F.when((at >= south) & (at <= north), F.sqrt(s * s + c * c)).otherwise(ends)

    cosine = F.when(inside, along(F.lit(0.0))) \
        .otherwise(F.greatest(along((blon - west) * _RAD), along((blon - west - size) * _RAD)))
    return (1 - cosine) / 2


def _pyramid(stations: DataFrame, p: int) -> DataFrame:
    """One representative position for each cell that holds a station, at all levels from 4 columns to 2 ** p."""
    cx, cy = _cells(F.col("_slat"), F.col("_slon"), 2 ** p, 360.0 / 2 ** p)
    # a station on the pole belongs to the last row of cells
    finest = stations.groupBy(cx.alias("_x"), F.least(cy, F.lit(2 ** (p - 1) - 1)).alias("_y")) \
        .agg(F.min(F.struct("_slat", "_slon")).alias("_rep"))
    # a cell's representative is one of those of its quarters
    return finest.select("_x", "_y", "_rep", F.explode(F.sequence(F.lit(2), F.lit(p))).alias("_level")) \
        .groupBy("_level", (F.lit(360.0) / F.expr("shiftleft(1L, _level)")).alias("_size"),
                 F.expr(f"shiftright(_x, {p} - _level)").alias("_cx"), F.expr(f"shiftright(_y, {p} - _level)").alias("_cy")) \
        .agg(F.min("_rep").alias("_rep"))


def _descend(pending: DataFrame, stations: DataFrame, p: int, broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Best station of each position by the cell pyramid, from 4 columns down to 2 ** p."""
    pyramid = bounded_broadcast(_pyramid(stations, p), broadcast_rows)
    blat, blon = F.col("bike_latitude"), F.col("bike_longitude")
    # the same expressions at every level, so Spark compiles them once
    low = _least_term(blat, blon, F.col("_cx"), F.col("_cy"), F.col("_size"))
    up = F.min(haversine_term(blat, blon, F.col("_rep._slat"), F.col("_rep._slon"))).over(Window.partitionBy(*POSITION))
    halves = F.expr("explode(array(struct(0 as x, 0 as y), struct(0 as x, 1 as y), struct(1 as x, 0 as y), struct(1 as x, 1 as y))) as _o")
    held = pending.select(*POSITION, F.expr("explode(sequence(0L, 3L)) as _cx")) \
        .select(*POSITION, "_cx", F.expr("explode(sequence(0L, 1L)) as _cy"))
    for level in range(2, p + 1):
        near = held.join(pyramid.filter(F.col("_level") == level), ["_cx", "_cy"]) \
            .select(*POSITION, "_cx", "_cy", low.alias("_low"), up.alias("_up")) \
            .filter(F.col("_low") <= F.col("_up") + _TERM_MARGIN)
        if level < p:
            near = near.select(*POSITION, "_cx", "_cy", halves) \
                .selectExpr(*POSITION, "_cx * 2 + _o.x as _cx", "_cy * 2 + _o.y as _cy")
            if (level - 1) % LEVELS_A_JOB == 0:
                near = near.checkpoint(eager=True)
        held = near.select(*POSITION, "_cx", "_cy")
    n = 2 ** p
    scx, scy = _cells(F.col("_slat"), F.col("_slon"), n, 360.0 / n)
    cells = stations.withColumn("_cx", scx).withColumn("_cy", F.least(scy, F.lit(n // 2 - 1)))
    a = haversine_term(blat, blon, F.col("_slat"), F.col("_slon"))
    return held.join(cells, ["_cx", "_cy"]).groupBy(*POSITION) \
        .agg(F.min(F.struct(a.alias("a"), *STATION)).alias("_best"))


def nearest_station(bikes: DataFrame, stations: DataFrame, cell_deg: float = 0.01,
                    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """One row per (bike_id, ingested_at) with its nearest station and distance in km.

    ``bikes``: bike_id, latitude, longitude, is_reserved, is_disabled,
    vehicle_type_id, ingested_at.  ``stations``: station_id, station_name,
    region_id, region_name, latitude, longitude.  Of several rows of a bike and time the
    greatest by position, then the other columns, stays.  Bikes without coordinates, and
    all bikes if no station has any, keep a NULL station and distance; stations without
    coordinates take no part.  ``cell_deg`` should be near the typical station spacing:
    a position's candidates are the stations in its 3 x 3 block of cells, which are made
    smaller where that block would be crowded.

    Each local level's result and every ``LEVELS_A_JOB``-th of the pyramid is checkpointed (to
    the shared checkpoint folder).  The station
    side is broadcast when its measured row count is within ``broadcast_rows`` (positions
    then never move for the candidate join); otherwise both sides are shuffled on the
    cell key.
    """
    checkpoint_root(bikes.sparkSession)
    p = max(2, _levels(cell_deg))
    bikes = bikes.select("bike_id", F.col("latitude").alias("bike_latitude"),
                         F.col("longitude").alias("bike_longitude"), "is_reserved", "is_disabled",
                         "vehicle_type_id", "ingested_at")
    bikes = latest_per_key(bikes, ["bike_id", "ingested_at"], "bike_latitude",
                           ["bike_longitude", "is_reserved", "is_disabled", "vehicle_type_id"])
    pending = bikes.select(*POSITION).dropna().distinct()
    st = (stations.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
          .groupBy(F.col("latitude").alias("_slat"), F.col("longitude").alias("_slon"))
          # Of stations sharing a position only the smallest id can win (ties
          # rank by station_id), so co-located stations -- e.g. many feeds'
          # placeholder (0, 0) -- never pile up in one cell.
          .agg(F.min(F.struct(F.col("station_id").alias("nearest_station_id"),
                              F.col("station_name").alias("nearest_station_name"),
                              "region_id", "region_name")).alias("_s"))
          .select("_s.*", "_slat", "_slon"))
    st, rows, small = measured(st, broadcast_rows)
    if rows is not None:
        st = st.coalesce(max(1, -(-rows // TASK_STATIONS)))
    p = _finest_level(st, p)
    pending, left = _spread(pending)
    found = []
    for level in range(p, max(1, p - LOCAL_LEVELS), -1):
        best = _search(pending, st, 2 ** level, small).checkpoint(eager=True)
        found.append(best.filter(F.col("_ok")).drop("_ok"))
        pending, left = _spread(best.filter(~F.col("_ok")).select(*POSITION))
        if not left:
            break
    if left:
        found.append(_descend(pending, F.broadcast(st) if small else st, p, broadcast_rows))
    out = bikes.join(reduce(DataFrame.unionByName, found), POSITION, "left")
    return out.select(
        "bike_id", *POSITION, "is_reserved", "is_disabled", "vehicle_type_id",
        F.col("_best.nearest_station_id").alias("nearest_station_id"),
        F.col("_best.nearest_station_name").alias("nearest_station_name"),
        F.col("_best.region_id").alias("region_id"),
        F.col("_best.region_name").alias("region_name"),
        F.when(F.col("_best.a").isNotNull(), term_to_km(F.col("_best.a"))).alias("distance_km"),
        "ingested_at")
