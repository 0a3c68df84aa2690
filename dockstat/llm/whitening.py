"""Embedding whitening by an incremental eigendecomposition.

Entries become integers, floor(scale * x) + offset, whose sums over all vectors are exact; a
vector is centred as n*x - S in integers before anything is multiplied.  Then:

* each task builds the spectrum of its own scatter by rank-one updates: V D V' + u u' has
  the roots of the secular equation 1 + sum z_j^2 / (d_j - r) = 0 (z = V'u) as eigenvalues.
  Entries of z that are zero and equal eigenvalues are deflated first, each root is
  bracketed between two poles and found by bisection on its distance to the nearer pole,
  and z is recomputed from the roots so that the new vectors are orthogonal.  A block of
  centred rows is first turned by QR into as many rows as there are dimensions, which have
  the same scatter; these are the updates;
* spectra are combined FAN at a time: each eigenpair of one is a rank-one update of the other;
* the combined vectors are refined by Rayleigh-Ritz: one pass over the table adds up the
  covariance within their span, whose small eigenproblem gives the final pairs.

What tasks exchange and the driver gets are spectra and matrices of dimension x dimension;
rows are never collected, and no shuffle carries rows.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries are
dropped; vectors of different lengths, or with entries beyond 2^40 as integers, raise
ValueError; a component without variance (one vector, equal vectors, fewer vectors than
dimensions) has whitened 0.0 and explained 0.0 and takes no part in identity_error; a null
vec_id is kept; repeated rows count each; an empty table gives an empty result; columns
other than the two named ones are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockstat.llm.common import staged
from dockstat.llm.vectors import common_length, kept_vectors, matrix

COMPONENTS, SCALE, OFFSET = 32, 64, 1_000_000
BLOCK_BYTES = 16 << 20  # of a block of vectors as doubles
FAN = 8
EPS = np.finfo(np.float64).eps

PART_SCHEMA = "part long, data array<double>"
EXACT = pa.decimal128(38, 0)


# ---- the spectrum of a symmetric matrix under rank-one updates ----------------------

def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + zz' and the matrix d_j - root_i, for rising d and no zero in z."""
    m, z2 = len(d), z * z
    upper = np.append(d[1:], d[-1] + z2.sum())
    gap = np.append(np.diff(d), z2.sum())
    middle = d + gap / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        value = 1 + (z2[:, None] / (d[:, None] - middle[None])).sum(axis=0)
    left = (value > 0) | (np.arange(m) == m - 1)       # the root is nearer to the pole below it
    origin, sign = np.where(left, d, upper), np.where(left, 1.0, -1.0)
    delta = d[:, None] - origin[None]
    high = np.where(np.arange(m) == m - 1, gap, gap / 2)
    low = high * 2.0 ** -220
    for _ in range(72):
        mid = np.where(high > 4 * low, np.sqrt(low) * np.sqrt(high), low + (high - low) / 2)
        below = 1 + (z2[:, None] / (delta - (sign * mid)[None])).sum(axis=0) < 0   # the root is above
        up = below == left
        low, high = np.where(up, mid, low), np.where(up, high, mid)
    step = sign * (low + (high - low) / 2)
    return origin + step, delta - step[None]


def update(values: np.ndarray, vectors: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum (values rising, vectors in columns) of vectors diag(values) vectors' + uu'."""
    z = vectors.T @ u
    norm = float(z @ z)
    if norm == 0:
        return values, vectors
    tiny = 8 * EPS * max(abs(values[-1]), abs(values[0]), norm)
    z, vectors, values = z.copy(), vectors.copy(), values.copy()
    lo = 0
    while lo < len(values):                            # equal values: turn their part of z into one entry
        hi = int(np.searchsorted(values, values[lo] + tiny, "right"))
        if hi - lo > 1:
            part = z[lo:hi].copy()
            size = np.linalg.norm(part)
            if size > 0:
                w = part.copy()
                w[-1] += np.copysign(size, part[-1])
                w /= np.linalg.norm(w)
                vectors[:, lo:hi] -= np.outer(vectors[:, lo:hi] @ w, 2 * w)
                z[lo:hi] = 0
                z[hi - 1] = -np.copysign(size, part[-1])
            values[lo:hi] = values[hi - 1]
        lo = hi
    live = np.flatnonzero(np.abs(z) > 8 * EPS * np.sqrt(norm))
    if np.sqrt(norm) <= EPS * np.sqrt(max(values[-1], 0)):
        return values, vectors                         # below what the values can hold
    d, zl = values[live], z[live]
    roots, apart = secular_roots(d, zl)
    # entries of z for which the found roots are exact
    m = len(d)
    below = np.arange(m)[None] < np.arange(m)[:, None]
    pole = np.where(below, d[None], np.append(d[1:], 0)[None]) - d[:, None]
    pole[:, -1] = 1
    exact = np.sqrt(np.abs(np.prod(-apart / pole, axis=1)))
    w = np.copysign(exact, zl)[:, None] / apart
    w /= np.linalg.norm(w, axis=0)
    values[live] = roots
    vectors[:, live] = vectors[:, live] @ w
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def add_rows(values: np.ndarray, vectors: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum after the scatter of centred rows is added."""
    if len(rows) > len(values):
        rows = np.linalg.qr(rows, mode="r")
    for u in rows:
        values, vectors = update(values, vectors, u)
    return values, vectors


def add_spectrum(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return add_rows(*a, (b[1] * np.sqrt(np.maximum(b[0], 0))).T[b[0] > 0])


# ---- passes over the table ----------------------------------------------------------

class Grid:
    """How entries become centred integers: x - floor(S/n), and the rest of S/n."""

    def __init__(self, n: int, sums: list[int], scale: int, offset: int):
        self.n, self.scale, self.offset = n, scale, offset
        self.base = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def shifted(self, v: np.ndarray) -> np.ndarray:
        return integers(v, self.scale, self.offset) - self.base

    def centred(self, v: np.ndarray) -> np.ndarray:
        """x - S/n."""
        return self.shifted(v) - self.rest / self.n

    def deviation(self, v: np.ndarray) -> pa.Array:
        """Sum of (n*x - S)^2 as exact decimals."""
        x = self.shifted(v)
        if not x.size or (self.n * (float(np.abs(x).max()) + 1)) ** 2 * x.shape[1] < 2.0 ** 62:
            return pa.array(((self.n * x - self.rest) ** 2).sum(axis=1)).cast(EXACT)
        return pa.array([Decimal(t) for t in ((self.n * x.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)], EXACT)


def integers(v: np.ndarray, scale: int, offset: int) -> np.ndarray:
    x = np.floor(scale * v)
    if x.size and np.abs(x).max() > 2.0 ** 40:
        raise ValueError("vector entries are too large for exact integer sums")
    return x.astype(np.int64) + offset


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    rows = max(4 * dim, BLOCK_BYTES // (8 * dim))
    for whole in batches:
        for lo in range(0, whole.num_rows, rows):
            b = whole.slice(lo, rows)
            yield b, matrix(b["v"], dim)


def exact_sums(kept: DataFrame, dim: int, scale: int, offset: int) -> list[int]:
    """Sum of each dimension's integers over all vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dim
        for _, v in _blocks(batches, dim):
            total = [t + s for t, s in zip(total, integers(v, scale, offset).sum(axis=0).tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([Decimal(t) for t in total], EXACT)], ["at", "total"])

    sums = kept.select("v").mapInArrow(run, "at int, total decimal(38,0)").groupBy("at").agg(F.sum("total").alias("total"))
    by = {r.at: int(r.total) for r in sums.collect()}
    return [by[i] for i in range(dim)]


def _one(part: int, data: np.ndarray) -> pa.RecordBatch:
    flat = np.ascontiguousarray(data, np.float64).reshape(-1)
    return pa.RecordBatch.from_arrays([pa.array([part]), pa.ListArray.from_arrays([0, len(flat)], pa.array(flat))], ["part", "data"])


def combined(parts: DataFrame, merge: Callable[[np.ndarray, np.ndarray], np.ndarray], name: str) -> np.ndarray:
    """One array from the tasks' arrays, merged FAN at a time."""
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group["part"].to_pylist(), group["data"].combine_chunks().to_pylist()))
        data = np.array(rows[0][1])
        for _, other in rows[1:]:
            data = merge(data, np.array(other))
        return pa.Table.from_batches([_one(rows[0][0] // FAN, data)])

    left = staged(parts, name)
    last = left.agg(F.max("part")).first()[0]
    while last > 0:
        left = staged(left.groupBy(F.floor(F.col("part") / FAN).alias("at")).applyInArrow(run, PART_SCHEMA), name)
        last //= FAN
    return np.array(left.select("data").first().data)


def _per_task(work: Callable[[Iterator[np.ndarray]], np.ndarray | None], dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = work(v for _, v in _blocks(batches, dim))
        if data is not None:
            yield _one(TaskContext.get().partitionId(), data)
    return run


def spectrum(kept: DataFrame, dim: int, grid: Grid) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and vectors of the whole scatter, from the tasks' spectra."""
    def work(blocks: Iterator[np.ndarray]) -> np.ndarray:
        values, vectors = np.zeros(dim), np.eye(dim)
        for v in blocks:
            values, vectors = add_rows(values, vectors, grid.centred(v))
        return np.vstack([values, vectors])

    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = a.reshape(dim + 1, dim), b.reshape(dim + 1, dim)
        return np.vstack(add_spectrum((a[0], a[1:]), (b[0], b[1:]))).reshape(-1)

    data = combined(kept.select("v").mapInArrow(_per_task(work, dim), PART_SCHEMA), merge, "spectra").reshape(dim + 1, dim)
    return data[0], data[1:]


def moments(kept: DataFrame, dim: int, grid: Grid, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance (divisor n) of the centred vectors times `basis`, in one pass."""
    k = basis.shape[1]

    def work(blocks: Iterator[np.ndarray]) -> np.ndarray:
        total = np.zeros((k + 1, k))
        for v in blocks:
            y = grid.centred(v) @ basis
            total[0] += y.sum(axis=0)
            total[1:] += y.T @ y
        return total

    total = combined(kept.select("v").mapInArrow(_per_task(work, dim), PART_SCHEMA), np.add, "moments").reshape(k + 1, k) / grid.n
    return total[0], total[1:] - np.outer(total[0], total[0])


def components(kept: DataFrame, dim: int, grid: Grid, wanted: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(variances falling, unit vectors in columns, trace of the covariance) of the leading components."""
    basis, _ = np.linalg.qr(spectrum(kept, dim, grid)[1][:, ::-1])
    _, within = moments(kept, dim, grid, basis)
    e, turn = np.linalg.eigh((within + within.T) / 2)
    return e[::-1][:wanted], (basis @ turn)[:, ::-1][:, :wanted], float(np.trace(within))


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components_wanted: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id, component, n, deviation (exact decimal), whitened, explained and identity_error.

    `df` is read six times; stage it first if it is costly to compute.
    """
    kept = kept_vectors(df, id_col, vec_col)
    n, dim = common_length(kept)
    if not n:
        return kept.selectExpr("vec_id", "0 as component", "0L as n", "cast(0 as decimal(38,0)) as deviation",
                               "0d as whitened", "0d as explained", "0d as identity_error")
    grid = Grid(n, exact_sums(kept, dim, scale, offset), scale, offset)
    e, vectors, trace = components(kept, dim, grid, min(components_wanted, dim))
    varied = e > 4 * dim * EPS * max(e[0], 0)
    to = np.where(varied, vectors / np.sqrt(np.where(varied, e, 1.0)), 0.0)
    explained = np.where(varied, e, 0.0) / (trace if trace > 0 else 1.0)
    _, white = moments(kept, dim, grid, to)
    error = float(np.abs(white - np.diag(varied.astype(float))).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, v in _blocks(batches, dim):
            y = grid.centred(v) @ to
            cuts = pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1])
            yield pa.RecordBatch.from_arrays([b["vec_id"], grid.deviation(v), pa.ListArray.from_arrays(cuts, pa.array(y.reshape(-1)))],
                                             ["vec_id", "deviation", "y"])

    shares = F.array(*[F.lit(float(x)) for x in explained])
    return kept.mapInArrow(run, "vec_id long, deviation decimal(38,0), y array<double>") \
        .select("vec_id", "deviation", F.posexplode("y").alias("at", "whitened")) \
        .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
