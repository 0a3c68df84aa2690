"""Benchmark decontamination by SimHash over item-sized windows.

For every benchmark item, each run of as many words in a document is a window.
Items and windows get a 64-bit SimHash of their five-word shingles, weighted by how
often they occur.  A multi-index finds items within RADIUS bits of a window: with
BLOCKS blocks of 8 bits, fingerprints that differ in at most RADIUS bits differ in at
most RADIUS // BLOCKS bits of some block, so looking up every block value that near
misses none of them.  Candidates are then verified exactly: the sum of the smaller
over the sum of the larger shingle weights must reach `similarity`.

A window can only reach 0.8 if at least 0.8 of its shingles occur in the item, so
windows with fewer than half of their shingles anywhere in the benchmark are passed
over before fingerprinting; that loses nothing.

Windows are looked up in slices of neighbouring ones, each against those items that have a shingle
in common with the slice -- no other item can reach a positive similarity -- and in steps
of at most CELLS pairs, so memory follows neither the length of a document nor how many items
it holds.

The benchmark is sent to tasks in blocks of at most BLOCK_CHARS characters, each
block over all documents, so memory stays bounded whatever its size.

Words are lower-cased runs of letters and digits.  Items of fewer than five words
have one shingle, the whole.  A document shorter than an item is one window.

Defined cases: null, empty and word-less documents and items never match; repeated
document rows match each; repeated items report each item_id; a null doc_id or item_id
is carried through; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockstat.llm.common import hash_words, id_and_text, importable, ragged, shingle_hashes, slices
from dockstat.llm.toxicity import text_words

SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 20, 8
BLOCK_CHARS = 4 << 20
SPAN, CELLS = 4096, 1 << 20  # words that a slice of windows starts in; pairs looked up at once
HIT_SCHEMA = "doc_id long, item_id long, start_word long, n_words long, hamming int, similarity double"


def _signs(h: np.ndarray) -> np.ndarray:
    """Bits of each hash as +1 and -1, (hashes, 64)."""
    return (np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int8) << 1) - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    """64-bit SimHash of each row of bit sums, as 8 bytes."""
    return np.packbits(sums > 0, axis=1)


def simhash(shingles: np.ndarray) -> np.ndarray:
    return _fingerprints(_signs(shingles).sum(axis=0, dtype=np.int32)[None])[0]


BYTE_BITS = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class BenchmarkIndex:
    """Items grouped by length, with their fingerprints' block lookups and shingle weights."""

    def __init__(self, items: list[tuple[int | None, str]], radius: int = RADIUS):
        words = text_words(pa.array([t for _, t in items], pa.string()))
        hashed = hash_words(words.vocab)[words.codes]
        shingles: dict[int, list[np.ndarray]] = {}
        self.radius, self.classes, known = radius, {}, [np.empty(0, np.uint64)]
        for i, (s, e) in enumerate(zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist())):
            if e > s:
                sh = shingle_hashes(hashed[s:e], SHINGLE)
                known.append(sh)
                shingles.setdefault(e - s, []).append(np.unique(sh))
                self.classes.setdefault(e - s, []).append((items[i][0], Counter(sh.tolist()), simhash(sh)))
        self.known = np.unique(np.concatenate(known))
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.known >> np.uint64(44)] = True
        self.least = min((max(1, (n - SHINGLE + 1) // 2) for n in self.classes), default=1)
        value = np.arange(256, dtype=np.uint8)
        self.near, self.postings = {}, {}
        for n, group in self.classes.items():
            key, item = np.concatenate(shingles[n]), np.repeat(np.arange(len(group)), [len(x) for x in shingles[n]])
            order = np.argsort(key, kind="stable")
            self.postings[n] = (key[order], item[order])
            prints = np.stack([g[2] for g in group])                             # (items, 8)
            apart = BYTE_BITS[prints.T[:, None, :] ^ value[None, :, None]]       # (8, 256, items)
            self.near[n] = (prints, apart <= radius // BLOCKS)

    def member(self, h: np.ndarray) -> np.ndarray:
        """Which hashes are shingles of some item."""
        out = self.sieve[h >> np.uint64(44)]
        at = np.flatnonzero(out)
        if len(at) and len(self.known):
            out[at] = self.known[np.searchsorted(self.known, h[at]).clip(max=len(self.known) - 1)] == h[at]
        return out

    def sharing(self, n: int, shingles: np.ndarray) -> np.ndarray:
        """Items of n words that have one of the shingles."""
        key, item = self.postings[n]
        own = np.unique(shingles)
        first = np.searchsorted(key, own, "left")
        return np.unique(item[ragged(first, np.searchsorted(key, own, "right") - first)])

    def within(self, n: int, prints: np.ndarray, mine: np.ndarray) -> list[tuple[int, int, int]]:
        """(window, item, bits apart) of the windows and items of `mine` within the radius, by the multi-index."""
        items, near = self.near[n]
        near = near[:, :, mine]
        candidate = near[0][prints[:, 0]]
        for b in range(1, BLOCKS):
            candidate |= near[b][prints[:, b]]
        w, i = np.nonzero(candidate)
        apart = BYTE_BITS[prints[w] ^ items[mine[i]]].sum(axis=1, dtype=np.int32)
        close = np.flatnonzero(apart <= self.radius)
        return list(zip(w[close].tolist(), mine[i[close]].tolist(), apart[close].tolist()))

    def search(self, words: np.ndarray, similarity: float) -> list[tuple]:
        """Best window of each contained item: (item_id, start, n, hamming, similarity)."""
        found: dict[tuple[int, int], tuple] = {}
        by_width: dict[int, tuple] = {}
        for n in sorted(self.classes):
            size = min(n, len(words))
            k = min(SHINGLE, size)
            if k not in by_width:
                sh = shingle_hashes(words, k) if k < SHINGLE or len(words) >= SHINGLE else words
                mem = np.concatenate([[0], np.cumsum(self.member(sh))])
                by_width[k] = (sh, mem)
            sh, mem = by_width[k]
            run = size - k + 1
            shared = mem[run:] - mem[:-run]
            starts = np.flatnonzero(2 * shared >= run)
            if not len(starts):
                continue
            span = max(SPAN, run)
            for part in np.split(starts, np.flatnonzero(np.diff(starts // span)) + 1):
                lo, hi = int(part[0]), int(part[-1]) + run
                mine = self.sharing(n, sh[lo:hi])
                sums = np.concatenate([np.zeros((1, 64), np.int32),
                                       np.cumsum(_signs(sh[lo:hi]), axis=0, dtype=np.int32)])
                step = max(1, CELLS // max(1, len(mine)))
                for at in (part[i:i + step] for i in range(0, len(part), step)):
                    prints = _fingerprints(sums[at - lo + run] - sums[at - lo])
                    for w, i, d in self.within(n, prints, mine):
                        s = int(at[w])
                        item, weights, _ = self.classes[n][i]
                        own = Counter(sh[s:s + run].tolist())
                        common = sum((own & weights).values())
                        sim = common / (run + sum(weights.values()) - common)
                        best = found.get((n, i))
                        if sim >= similarity and (best is None or sim > best[4]):
                            found[n, i] = (item, s, size, d, sim)
        return list(found.values())


def _documents(index: BenchmarkIndex, similarity: float, texts: pa.Array) -> Iterator[tuple[int, list[tuple]]]:
    """(position in the batch, hits) of the texts that contain an item."""
    words = text_words(texts)
    hashed = hash_words(words.vocab)[words.codes]
    short = min(index.classes, default=SHINGLE) < SHINGLE
    if len(hashed) < SHINGLE:
        shared = np.zeros(len(hashed) + 1, np.int64)
    else:  # shingles across two texts only make a text be looked at in vain
        hits = np.concatenate([index.member(shingle_hashes(hashed, SHINGLE)), np.zeros(SHINGLE - 1, bool)])
        shared = np.concatenate([[0], np.cumsum(hits)])
    for d, (s, e) in enumerate(zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist())):
        if e > s and (short or e - s < SHINGLE or shared[e] - shared[s] >= index.least):
            found = index.search(hashed[s:e], similarity)
            if found:
                yield d, found


def benchmark_blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[BenchmarkIndex]:
    """Indexes over at most `chars` characters of items each, read one after the other."""
    block, held = [], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text") \
            .filter("text is not null").toLocalIterator():
        if block and held + len(r.text) > chars:
            yield BenchmarkIndex(block)
            block, held = [], 0
        block.append((r.item_id, r.text))
        held += len(r.text)
    if block:
        yield BenchmarkIndex(block)


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each document and item it contains, with the best window."""
    docs, out = id_and_text(docs), None

    def find(index: BenchmarkIndex):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64()]
            names = [f.split()[0] for f in HIT_SCHEMA.split(", ")]
            for b in slices(batches):
                ids = b["doc_id"].to_pylist()
                rows = [(ids[d], *hit) for d, hits in _documents(index, similarity, b["text"]) for hit in hits]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        return run

    for index in benchmark_blocks(benchmark):
        part = docs.mapInArrow(find(index), HIT_SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], HIT_SCHEMA)


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Rows of `docs` that contain no benchmark item, every column as it was."""
    importable(docs.sparkSession)
    schema = docs.schema

    def clean(index: BenchmarkIndex):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                keep = np.ones(b.num_rows, bool)
                keep[[d for d, _ in _documents(index, similarity, b["text"])]] = False
                yield b.filter(pa.array(keep))
        return run

    for index in benchmark_blocks(benchmark):
        docs = docs.mapInArrow(clean(index), schema)
    return docs
