"""Vector code compression: codes of vector parts, nearest entries found through memoised grid cells.

A vector's entries become integers, floor(scale * x), and the vector is cut into `parts`
equal consecutive parts.  Each part position has a codebook of integer entries: first that
part of the `entries` smallest vec_ids, then, for a number of rounds, the floored mean of
the parts assigned to it (unused entries stay).  A part's code is its nearest entry by
squared Euclidean distance, ties to the lower index.

Finding the nearest entry: space is cut into cubes, a part falls into one, and the cube's
coordinates are the hash key of a memo.  For a cube seen first, the least and the greatest
distance from its box to every entry are computed; an entry whose least distance is above
some other entry's greatest distance is nearest to no point of the box.  The others are
remembered, and only they are evaluated exactly, for this part and each later one that falls
into the cube.  So the result does not depend on the cubes' side, which only sets the work.

Spark does a round as one pass over the table: each task assigns its parts and adds them
up by (position, entry), those sums are added up by a shuffle that carries at most
entries x dimensions rows a task, and the driver gets one codebook, whose size is set by the
parameters.  No row is collected or shuffled; equal or hot vectors weigh nothing extra.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries are
dropped; vectors of different lengths, of a length that `parts` does not divide, or so large
that squared distances pass 64 bits raise ValueError; with fewer than `entries` rows the
codebooks are that much shorter; a null vec_id sorts last and is kept; rows that repeat a
vec_id are rows of their own, in the order of their vectors; an empty table gives an empty
result; columns other than the three named ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockstat.llm.common import ragged, staged
from dockstat.llm.vectors import common_length, kept_vectors, matrix

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
SIDE = 0.7            # of a cell, as a share of the typical distance between neighbouring entries
MEMO_CELLS = 1 << 16  # remembered per part position; a full memo is started anew
SLICE_ROWS = 4096

SUMS_SCHEMA = "slot long, at int, n long, total long"
CODES_SCHEMA = "vec_id long, label_key string, code string, error long"


def integers(v: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * v) as integers; ValueError where squared distances would pass 64 bits."""
    x = np.floor(scale * v)
    if x.size and np.abs(x).max() >= np.sqrt(2.0 ** 61 / x.shape[1]):
        raise ValueError("vector entries are too large for exact 64-bit distances")
    return x.astype(np.int64)


class GridCodebook:
    """One part position: its entries and the memo of cells."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.side = self._side()
        self._start()

    def _side(self) -> int:
        if len(self.entries) < 2:
            return 1 << 20
        apart = ((self.entries[:, None] - self.entries[None]) ** 2).sum(axis=2).astype(np.float64)
        np.fill_diagonal(apart, np.inf)
        return max(1, int(SIDE * np.sqrt(np.median(apart.min(axis=1)))))

    def _start(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.first, self.size, self.held = np.zeros(256, np.int64), np.zeros(256, np.int64), 0
        self.kept = np.zeros(0, np.int64)

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """(cells, entries): entries that may be nearest to some point of the cell."""
        low = (cells * self.side)[:, None, :]
        high = low + self.side - 1
        c = self.entries[None]
        least = (np.maximum(np.maximum(low - c, c - high), 0) ** 2).sum(axis=2)
        most = (np.maximum(np.abs(c - low), np.abs(high - c)) ** 2).sum(axis=2)
        return least <= most.min(axis=1, keepdims=True)

    def _numbers(self, cells: np.ndarray) -> np.ndarray:
        """Memo number of each of some distinct cells, new ones entered."""
        if self.held + len(cells) > MEMO_CELLS:
            self._start()
        keys = [c.tobytes() for c in np.ascontiguousarray(cells)]
        numbers = np.array([self.memo.get(k, -1) for k in keys], np.int64)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            row, entry = np.nonzero(self.undominated(cells[new]))
            size = np.bincount(row, minlength=len(new))
            numbers[new] = self.held + np.arange(len(new))
            self.memo.update((keys[i], n) for i, n in zip(new.tolist(), numbers[new].tolist()))
            need = self.held + len(new)
            if need > len(self.first):
                grow = max(need, 2 * len(self.first)) - len(self.first)
                self.first, self.size = np.pad(self.first, (0, grow)), np.pad(self.size, (0, grow))
            self.first[self.held:need] = len(self.kept) + np.cumsum(size) - size
            self.size[self.held:need] = size
            self.kept = np.concatenate([self.kept, entry])
            self.held = need
        return numbers

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of integer parts."""
        cells, inverse = np.unique(x // self.side, axis=0, return_inverse=True)
        number = self._numbers(cells)[inverse.reshape(-1)]
        size = self.size[number]
        rows = np.repeat(np.arange(len(x)), size)
        entry = self.kept[ragged(self.first[number], size)]
        d = ((x[rows] - self.entries[entry]) ** 2).sum(axis=1)
        starts = np.cumsum(size) - size
        best = np.minimum.reduceat(d, starts)
        code = np.minimum.reduceat(np.where(d == best[rows], entry, len(self.entries)), starts)
        return code, best


def _books(books: np.ndarray) -> list[GridCodebook]:
    return [GridCodebook(b) for b in books]


def _pieces(batches: Iterator[pa.RecordBatch], dim: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole in batches:
        for lo in range(0, whole.num_rows, SLICE_ROWS):
            b = whole.slice(lo, SLICE_ROWS)
            yield b, integers(matrix(b["v"], dim), scale)


def _sums(books: np.ndarray, scale: int):
    """Per task, count and sum of the parts by (position, entry)."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids, dim = _books(books), parts * width
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for _, x in _pieces(batches, dim, scale):
            for p, g in enumerate(grids):
                part = x[:, p * width:(p + 1) * width]
                code, _ = g.nearest(part)
                n[p] += np.bincount(code, minlength=entries)
                np.add.at(total[p], code, part)
        used = np.repeat(np.flatnonzero(n), width)
        if len(used):
            at = np.tile(np.arange(width, dtype=np.int32), len(used) // width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(at), pa.array(n.reshape(-1)[used]), pa.array(total.reshape(-1, width)[used, at])],
                ["slot", "at", "n", "total"])
    return run


def _codes(books: np.ndarray, scale: int):
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = _books(books)
        for b, x in _pieces(batches, parts * width, scale):
            code, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p, g in enumerate(grids):
                code[:, p], d = g.nearest(x[:, p * width:(p + 1) * width])
                error += d
            text = code.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [b["vec_id"], b["label_key"], pa.array([text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)], pa.string()),
                 pa.array(error)], ["vec_id", "label_key", "code", "error"])
    return run


def fit_codebooks(kept: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                  scale: int = SCALE) -> np.ndarray:
    """(parts, entries, dim / parts) integers after `rounds` passes over all kept vectors."""
    if dim % parts:
        raise ValueError(f"{dim} entries can't be cut into {parts} equal parts")
    order = F.col("vec_id").asc_nulls_last()
    ids = [r.vec_id for r in kept.select("vec_id").orderBy(order).limit(entries).collect()]
    if ids[-1] is not None:  # so that only tasks with such ids send vectors
        kept_first = kept.filter(F.col("vec_id") <= ids[-1])
    else:
        kept_first = kept
    first = kept_first.orderBy(order, "v").limit(entries).select("v").collect()
    books = integers(np.array([r.v for r in first], np.float64), scale).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    width = dim // parts
    for _ in range(rounds):
        sums = kept.select("v").mapInArrow(_sums(books, scale), SUMS_SCHEMA) \
            .groupBy("slot", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        for r in sums.collect():  # at most entries x dim rows
            books[r.slot // len(first), r.slot % len(first), r.at] = r.total // r.n
    assert books.shape == (parts, len(first), width)
    return books


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every kept row.

    `df` is read rounds + 3 times; stage it first if it is costly to compute.
    """
    if not 0 < entries <= 256:
        raise ValueError("codes are two hex digits: 1 to 256 entries")
    kept = kept_vectors(df, id_col, vec_col, F.col(f"`{label_col}`").cast("string").alias("label_key"))
    n, dim = common_length(kept)
    if not n:
        return kept.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    books = fit_codebooks(kept, dim, parts, entries, rounds, scale)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    coded = staged(kept.mapInArrow(_codes(books, scale), CODES_SCHEMA), "codes")
    by_label = staged(coded.groupBy("label_key").agg(F.sum("error").alias("label_error")), "label-errors") \
        .withColumnRenamed("label_key", "label_of")
    return coded.join(by_label, F.col("label_key").eqNullSafe(F.col("label_of"))) \
        .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
