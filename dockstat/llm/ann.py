"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector x to the bucket floor((a_i . x + b_i) / w), i = 1..m, with
Gaussian a_i; whether two vectors meet depends on their Euclidean distance alone.  A
query visits its own bucket and those next to it in the order of their estimated
success: the squared distances to the bucket walls crossed, added up, least first.
Candidates of all tables are merged and ranked by exact distance.

Fit.  From a bounded sample (SAMPLE_QUERIES x SAMPLE_ROWS) the distance of the k-th
neighbour among all rows is read off the distance distribution; `m` is the largest
number of projections with which, for random pairs at that distance, TABLES tables of
PROBES buckets still meet TARGET of them.  So buckets get finer as rows get denser.

Run.  Equal vectors are one entry with their k+1 smallest ids, so a vector that a third
of all rows repeat costs one.  Every row is indexed; the index is written with its
bucket keys.  Queries are a stated set, read in blocks of BLOCK: each block goes to all
tasks, which probe their rows and report the best k+1 entries per query.  Queries that
meet fewer than k others that way are searched again over all rows.

Defined cases: vectors null, empty, zero or with null or non-finite components take no
part; only vectors of equal length are compared; repeated rows of a vec_id and vector
are one candidate; a vec_id repeated with other vectors is a candidate and a query with
each; a null vec_id is neither; ties go to the smaller vec_id; other columns are not
read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockstat.llm.common import importable, mix, signed, staged

TABLES, PROBES, TARGET = 8, 64, 0.97
SAMPLE_QUERIES, SAMPLE_ROWS = 64, 20_000
MAX_PROJECTIONS, BLOCK = 24, 1024
FOUND_SCHEMA = "query_no long, query_id long, distance double, first long, ids array<long>"


class Hashing:
    """The tables for vectors of one length."""

    def __init__(self, dim: int, m: int, width: float, seed: int = 5):
        rng = np.random.default_rng([seed, dim, m])
        self.m, self.width = m, width
        self.a = rng.normal(size=(TABLES, dim, m))
        self.b = rng.uniform(0, width, size=(TABLES, 1, m))
        self.salt = mix(rng.integers(1, 1 << 62, size=(TABLES, m)).astype(np.uint64))

    def places(self, x: np.ndarray) -> np.ndarray:
        """Projections in bucket widths, (tables, vectors, m)."""
        return (x @ self.a + self.b) / self.width

    def keys(self, cells: np.ndarray, table: int) -> np.ndarray:
        """Bucket key of integer cells (..., m) in one table."""
        with np.errstate(over="ignore"):
            return mix((mix(cells.astype(np.int64).view(np.uint64) + np.uint64(table)) * self.salt[table])
                       .sum(axis=-1, dtype=np.uint64))

    def probes(self, place: np.ndarray, count: int) -> np.ndarray:
        """Cells of the `count` likeliest buckets of one projected vector, likeliest first."""
        cell = np.floor(place)
        low = place - cell
        wall = np.concatenate([low, 1 - low]) ** 2          # cost of a step down, of a step up
        order = np.argsort(wall, kind="stable")
        cost = wall[order].tolist()
        cells, heap = [cell], [(cost[0], (0,))]
        while heap and len(cells) < count:
            total, picks = heapq.heappop(heap)
            dims = [order[p] % self.m for p in picks]
            if len(set(dims)) == len(dims):                 # not down and up at once
                moved = cell.copy()
                for p in picks:
                    moved[order[p] % self.m] += -1 if order[p] < self.m else 1
                cells.append(moved)
            last = picks[-1]
            if last + 1 < len(cost):
                heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*picks[:-1], last + 1)))
                heapq.heappush(heap, (total + cost[last + 1], (*picks, last + 1)))
        return np.array(cells)


@lru_cache(maxsize=64)
def hashing(dim: int, m: int, width: float) -> Hashing:
    return Hashing(dim, m, width)


def success(m: int, width: float, distance: float, pairs: int = 300, dim: int = 32) -> float:
    """Share of random pairs at `distance` that meet in some probed bucket."""
    rng = np.random.default_rng(17)
    h = Hashing(dim, m, width, seed=23)
    x, step = rng.normal(size=(pairs, dim)), rng.normal(size=(pairs, dim))
    y = x + distance * step / np.linalg.norm(step, axis=1, keepdims=True)
    px, py = h.places(x), np.floor(h.places(y))
    return float(np.mean([any((h.probes(px[t, i], PROBES) == py[t, i]).all(axis=1).any() for t in range(TABLES))
                          for i in range(pairs)]))


def fit(vectors: DataFrame, queries: DataFrame, k: int) -> tuple[int, float]:
    """(projections, bucket width) from a sample bounded by SAMPLE_QUERIES and SAMPLE_ROWS."""
    n = vectors.count()
    rows = [r.v for r in vectors.select("v", "first").orderBy(F.xxhash64("first"), "first").limit(SAMPLE_ROWS).collect()]
    asked = [r.v for r in queries.select("v", "vec_id").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_QUERIES).collect()]
    far = []
    for q in asked:
        same = [r for r in rows if len(r) == len(q)]
        d = np.sqrt(((np.array(same) - np.array(q)) ** 2).sum(axis=1)) if same else np.zeros(0)
        d = np.sort(d[d > 0])
        if len(d):
            far.append(d[min(len(d) - 1, round(k * len(rows) / n))])
    if not far:
        return 1, 1.0
    distance = float(np.quantile(far, 0.75))
    width = 2 * distance
    m = 1
    while m < MAX_PROJECTIONS and success(m + 1, width, distance) >= TARGET:
        m += 1
    return m, width


def _index(m: int, width: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.zeros((b.num_rows, TABLES), np.uint64)
            for rows, x in by_dimension(b["v"]):
                h = hashing(x.shape[1], m, width)
                cells = np.floor(h.places(x))
                for t in range(TABLES):
                    keys[rows, t] = h.keys(cells[t], t)
            offsets = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * TABLES)
            yield pa.RecordBatch.from_arrays(
                [b["v"], b["first"], b["ids"], pa.ListArray.from_arrays(offsets, pa.array(signed(keys.reshape(-1))))],
                ["v", "first", "ids", "buckets"])
    return run


def by_dimension(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) of the vectors of each length."""
    at = lists.offsets.to_numpy()
    flat, size = lists.flatten().to_numpy(zero_copy_only=False), np.diff(at)
    for dim in np.unique(size).tolist():
        rows = np.flatnonzero(size == dim)
        yield rows, flat[(at[rows] - at[0])[:, None] + np.arange(dim)]


class QueryBlock:
    """Queries of one length: vectors and, per table, probed keys with the query they belong to."""

    def __init__(self, queries: list[tuple[int, int, list[float]]], hashes: Hashing | None):
        self.number = np.array([q[0] for q in queries])
        self.ids = np.array([q[1] for q in queries])
        self.x = np.array([q[2] for q in queries], np.float64)
        self.probes = []
        if hashes is not None:
            places = hashes.places(self.x)
            for t in range(TABLES):
                probed = [hashes.keys(hashes.probes(p, PROBES), t) for p in places[t]]
                of = np.repeat(np.arange(len(queries)), [len(p) for p in probed])
                key = np.concatenate(probed)
                order = np.argsort(key, kind="stable")
                self.probes.append((key[order], of[order]))

    def candidates(self, buckets: np.ndarray) -> np.ndarray:
        """(queries, rows) matrix of which rows some probe of the query meets."""
        if not self.probes:
            return np.ones((len(self.ids), len(buckets)), bool)
        met = np.zeros((len(self.ids), len(buckets)), bool)
        for t, (key, of) in enumerate(self.probes):
            own = buckets[:, t]
            lo, hi = np.searchsorted(key, own, "left"), np.searchsorted(key, own, "right")
            row = np.repeat(np.arange(len(own)), hi - lo)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)
            met[of[lo[row] + nth], row] = True
        return met


def _search(block: list[tuple[int, int, list[float]]], m: int, width: float, keep: int, everything: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, QueryBlock] = {}
        for dim in {len(q[2]) for q in block}:
            blocks[dim] = QueryBlock([q for q in block if len(q[2]) == dim],
                                     None if everything else hashing(dim, m, width))
        best: dict[int, list[tuple]] = {}
        for whole in batches:
            for b in (whole.slice(lo, 1024) for lo in range(0, whole.num_rows, 1024)):
                first, ids = b["first"].to_numpy(), b["ids"].to_pylist()
                buckets = np.array(b["buckets"].to_pylist(), np.int64).view(np.uint64).reshape(-1, TABLES)
                for rows, x in by_dimension(b["v"]):
                    if x.shape[1] not in blocks:
                        continue
                    q = blocks[x.shape[1]]
                    met = q.candidates(buckets[rows])
                    for i in np.flatnonzero(met.any(axis=1)).tolist():
                        c = np.flatnonzero(met[i])
                        d = np.sqrt(((x[c] - q.x[i]) ** 2).sum(axis=1))
                        if len(c) > keep:  # ties at the last place stay in
                            near = d <= np.partition(d, keep - 1)[keep - 1]
                            c, d = c[near], d[near]
                        got = best.setdefault(int(q.number[i]), [])
                        got += [(float(e), int(first[rows[j]]), ids[rows[j]], int(q.ids[i])) for e, j in zip(d, c)]
                        if len(got) > 4 * keep:
                            best[int(q.number[i])] = heapq.nsmallest(keep, got)
        rows = [(n, x[3], x[0], x[1], x[2]) for n, got in best.items() for x in heapq.nsmallest(keep, got)]
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             [f.split()[0] for f in FOUND_SCHEMA.split(", ")])
    return run


def _in_blocks(index: DataFrame, queries: DataFrame, m: int, width: float, k: int, everything: bool) -> DataFrame:
    """Best k+1 entries per query and task; queries are read and sent block by block."""
    found, block = None, []

    def search(part: list) -> DataFrame:
        one = index.mapInArrow(_search(part, m, width, k + 1, everything), FOUND_SCHEMA)
        return one if found is None else found.unionByName(one)

    for r in queries.select("query_no", "vec_id", "v").toLocalIterator():
        block.append((r.query_no, r.vec_id, r.v))
        if len(block) == BLOCK:
            found, block = search(block), []
    if block or found is None:
        found = search(block)
    return staged(found, "found")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    per = Window.partitionBy("query_no")
    near = found.withColumn("r", F.row_number().over(per.orderBy("distance", "first"))).filter(F.col("r") <= k + 1)
    each = near.select("query_no", "query_id", "distance", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    return each.withColumn("rank", F.row_number().over(per.orderBy("distance", "vec_id"))).filter(F.col("rank") <= k) \
        .select("query_no", "query_id", "rank", "vec_id", F.col("distance").alias("score"))


def nearest_neighbours(embeddings: DataFrame, asked: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows of each row that meets `asked`."""
    importable(embeddings.sparkSession)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & sound & F.exists("v", lambda x: x != 0)) \
        .groupBy("vec_id", "v").agg(F.lit(1).alias("one")).drop("one")
    ids = Window.partitionBy("v").orderBy("vec_id")
    vectors = staged(rows.withColumn("r", F.row_number().over(ids)).filter(F.col("r") <= k + 1)
                     .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                     .select("v", F.col("ids")[0].alias("first"), "ids"), "vectors")
    queries = staged(rows.filter(asked).withColumn("query_no", F.monotonically_increasing_id()), "queries")
    m, width = fit(vectors, queries, k)
    index = staged(vectors.mapInArrow(_index(m, width), "v array<double>, first long, ids array<long>, buckets array<long>"),
                   "index")
    met = staged(_ranked(_in_blocks(index, queries, m, width, k, False), k), "met")
    full = met.groupBy("query_no").agg(F.count("*").alias("n")).filter(F.col("n") >= k).select("query_no")
    short = queries.join(full, "query_no", "left_anti")
    again = _ranked(_in_blocks(index, short, m, width, k, True), k)
    return met.join(full, "query_no", "left_semi").unionByName(again).drop("query_no")
