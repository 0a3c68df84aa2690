"""Best-fit packing of token pieces into fixed-length sequences.

Which pieces share a sequence depends on their lengths alone, so the packing is
solved on the histogram of lengths (at most `capacity` rows, whatever the
corpus) and pieces take places by their rank within their length:

* Large items, above a third of the capacity, can meet at most twice in a
  sequence.  From the longest down, each is matched greedily with the longest
  other one that still fits.
* Smaller items, from the longest down, go where they leave the least room.

Equal lengths move together, so a step settles a whole run of sequences; the plan
is a list of runs (length, first rank, first sequence, items per sequence,
offset) whose number is bounded by the capacity and not by the corpus.

Defined cases: a null or empty text is its end id alone; rows that repeat are
packed each; a null doc_id is kept; an empty table gives no pieces; columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockstat.llm.common import slices, staged, id_and_text
from dockstat.llm.tokens import crc, default_tokenizer, encoder, with_end

CAPACITY = 4096
PIECE_SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
                "block int, local_rank long")


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, block = encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for b in slices(batches, cap=4 << 20):
            ids, at = with_end(*enc.encode(b["text"]), end_id)
            size = np.diff(at)
            count = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(size[row] - start, capacity)
            begin = at[row] + start
            order = np.argsort(length, kind="stable")
            same = length[order]
            first = np.concatenate([[0], np.flatnonzero(np.diff(same)) + 1]) if len(same) else same
            runs = np.diff(np.append(first, len(same)))
            rank = np.empty(len(row), np.int64)
            rank[order] = np.arange(len(row)) - np.repeat(first, runs) + seen[same]
            np.add.at(seen, length, 1)
            sums = [crc(ids[s:s + n]) for s, n in zip(begin.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(sums, pa.int64()),
                 pa.array(np.full(len(row), block), pa.int32()), pa.array(rank, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "block", "local_rank"])
    return run


def packing_plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Runs (length, rank_from, sequence_from, per_sequence, offset), sorted by length and rank.

    Items of `length` with ranks from rank_from up to the next run's lie
    per_sequence to a sequence, from sequence_from on, the first at `offset`.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    taken = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # room -> runs of sequences (first, count)
    sequences = 0

    def place(n: int, count: int, first: int, per: int, offset: int) -> None:
        runs.append((n, taken[n], first, per, offset))
        taken[n] += count
        left[n] -= count

    def open_gap(room: int, first: int, count: int) -> None:
        if room > 0 and count > 0:
            gaps.setdefault(room, []).append((first, count))

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for i, n in enumerate(large):
        for m in large[i:]:  # the longest partner that fits, then shorter ones
            if left[n] == 0:
                break
            if n + m > capacity or left[m] == 0:
                continue
            pairs = left[n] // 2 if m == n else min(left[n], left[m])
            if pairs == 0:
                continue
            if m == n:
                place(n, 2 * pairs, sequences, 2, 0)
            else:
                place(n, pairs, sequences, 1, 0)
                place(m, pairs, sequences, 1, n)
            open_gap(capacity - n - m, sequences, pairs)
            sequences += pairs
        if left[n]:
            count = left[n]
            place(n, count, sequences, 1, 0)
            open_gap(capacity - n, sequences, count)
            sequences += count

    rooms = sorted(gaps)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        # rooms below n stay out of this round; they are still there for shorter items
        heap = [r for r in rooms if r >= n and gaps.get(r)]
        heapq.heapify(heap)
        while left[n]:
            while heap and not gaps.get(heap[0]):
                heapq.heappop(heap)
            if not heap:
                per = capacity // n
                count = -(-left[n] // per)
                gaps.setdefault(capacity, []).append((sequences, count))
                sequences += count
                heapq.heappush(heap, capacity)
            room = heap[0]
            first, count = gaps[room].pop()
            per, offset = room // n, capacity - room
            whole = min(count, left[n] // per)
            if whole:
                place(n, whole * per, first, per, offset)
                open_gap(room - per * n, first, whole)
                open_gap(room, first + whole, count - whole)
            else:
                some = left[n]
                place(n, some, first, some, offset)
                open_gap(room - some * n, first, 1)
                open_gap(room, first + 1, count - 1)
        rooms = sorted(r for r, v in gaps.items() if v)
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def _places(plan: np.ndarray):
    key = plan[:, 0] << 44 | plan[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, rank = b["length"].to_numpy(), b["rank"].to_numpy()
            at = plan[np.searchsorted(key, n << 44 | rank, side="right") - 1]
            k = rank - at[:, 1]
            seq = at[:, 2] + k // at[:, 3]
            offset = at[:, 4] + k % at[:, 3] * n
            keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in keep), pa.array(seq), pa.array(offset)],
                                             [*keep, "sequence_id", "offset"])
    return run


def pack_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1,
                   capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their sequence and offset; gapless from 0 within each sequence."""
    docs = id_and_text(docs)
    pieces = staged(docs.mapInArrow(_pieces(tokenizer or default_tokenizer(), end_id, capacity),
                                    PIECE_SCHEMA), "pieces")
    # ranks within a length: local ranks shifted by what earlier blocks hold of that length
    counts = pieces.groupBy("length", "block").agg(F.count("*").alias("held"))
    shifts = counts.withColumn("shift", F.sum("held").over(
        Window.partitionBy("length").orderBy("block")) - F.col("held")).drop("held")
    histogram = {r["length"]: r["n"] for r in  # at most `capacity` rows
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = packing_plan(histogram, capacity)
    ranked = pieces.join(shifts, ["length", "block"]) \
        .withColumn("rank", F.col("local_rank") + F.col("shift")).drop("local_rank", "shift", "block")
    return ranked.mapInArrow(_places(plan), "doc_id long, piece int, start long, length long, "
                             "ids_crc32 long, sequence_id long, offset long")
