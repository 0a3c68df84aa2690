"""Substring dedup by content-defined chunks.

A gear hash rolls over a document's words: each word adds a random 64-bit number to
the hash shifted left by one, kept to the last GEAR_WORDS words.  The document is cut
after a word whose hash is the least within RADIUS words on either side, so a cut
depends on nothing further off: an insertion moves at most the chunks around it, and a
passage that stands in two documents falls into the same chunks but for its first and
last few words.  Chunks come out about 2 * RADIUS + 1 words long.  The hash rolls over two
words only because each word more would cost every passage one more word at its start.

What is deduplicated is WINDOW consecutive chunks, by a 64-bit digest of their words; a
document of fewer chunks is one window.  Every place of a window has a code, a random
number of its document row plus its position, so that windows which follow each other in a
document have codes that follow each other.  A repeated window keeps the least and the
greatest code of its places: two partners, one of which is another place.  A repeated
passage is a run of windows whose partners follow each other as well; so it stands
elsewhere as a whole, and pieces that are shared with different documents are never
joined.  Runs are looked for along either partner, and those within another are left out.
Passages of at least MIN_WORDS words are reported: one of 50 words keeps about 37 of them
in whole chunks.

A passage is original in the document of the smallest doc_id that has it.

Words lie between ASCII white space, ASCII letters in lower case.

Defined cases: null, empty and word-less texts have no chunks; a word repeated over and over
has no cut, so such a stretch is one chunk and equal only to stretches as long; repeated rows
of a doc_id are places of their own, original if their doc_id is the smallest; documents
without a doc_id count as the largest; empty tables give no rows; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockstat.llm.common import hash_words, id_and_text, mix, signed, slices, split_words, staged

GEAR_WORDS, RADIUS, WINDOW = 2, 3, 3
MIN_WORDS = 25
GEAR_SEED = 77
NO_ID = (1 << 63) - 1
CHUNK_SCHEMA = "doc_id long, digests array<long>, sizes array<int>"


def cuts(words: np.ndarray) -> np.ndarray:
    """Chunk ends within a sequence of word hashes; the last word always ends one."""
    gear = mix(words ^ np.uint64(GEAR_SEED))
    h = gear.copy()
    with np.errstate(over="ignore"):
        for j in range(1, GEAR_WORDS):
            h[j:] += gear[:-j] << np.uint64(j)
    h = mix(h)
    least = np.ones(len(h), bool)
    for j in range(1, min(RADIUS, len(h) - 1) + 1):
        least[j:] &= h[j:] < h[:-j]
        least[:-j] &= h[:-j] < h[j:]
    ends = np.flatnonzero(least) + 1
    if not len(ends) or ends[-1] != len(h):
        ends = np.append(ends, len(h))
    return ends


def chunk_digests(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit digest of each chunk: its words mixed with their positions in it, and its length."""
    starts = np.concatenate([[0], ends[:-1]])
    size = ends - starts
    nth = (np.arange(len(words)) - np.repeat(starts, size)).astype(np.uint64)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64),
                                np.cumsum(mix(words + mix(nth + np.uint64(0x2545F4914F6CDD1D))))])
        return mix(total[ends] - total[starts] + mix(size.astype(np.uint64)))


def window_digests(chunks: np.ndarray) -> np.ndarray:
    """Digest of each run of WINDOW chunks; fewer chunks are one run."""
    k = min(WINDOW, len(chunks))
    out = np.full(len(chunks) - k + 1, k, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + chunks[j:len(chunks) - k + 1 + j])
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        words = split_words(b["text"])
        hashed = hash_words(words.vocab)[words.codes]
        digests, sizes = [], []
        for s, e in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
            ends = cuts(hashed[s:e]) if e > s else np.empty(0, np.int64)
            digests.append(signed(window_digests(chunk_digests(hashed[s:e], ends))) if e > s else ends)
            sizes.append(np.diff(ends, prepend=0))
        yield pa.RecordBatch.from_arrays(
            [b["doc_id"], pa.array(digests, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32()))],
            ["doc_id", "digests", "sizes"])


def passages(sizes: np.ndarray, pos: np.ndarray, partners: list[np.ndarray], places: np.ndarray, original: np.ndarray,
             least: int) -> list[tuple]:
    """(start word, words, places, original) of a document's repeated passages.

    `pos` are its repeated windows in order; along each of `partners` a run goes on while
    position and partner go up by one and `original` stays.
    """
    start = np.concatenate([[0], np.cumsum(sizes)])
    width = min(WINDOW, len(sizes))
    found = set()
    for partner in partners:
        breaks = np.flatnonzero((np.diff(pos) != 1) | (np.diff(partner) != 1) | (original[1:] != original[:-1])) + 1
        for lo, hi in zip([0, *breaks.tolist()], [*breaks.tolist(), len(pos)]):
            begin, end = int(start[pos[lo]]), int(start[pos[hi - 1] + width])
            if end - begin >= least:
                found.add((begin, -end, int(places[lo:hi].max()), bool(original[lo])))
    out, reach = [], -1
    for begin, end, n, first in sorted(found):
        if -end > reach:                          # not within one before it
            out.append((begin, -end - begin, n, first))
            reach = -end
    return out


def _runs(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, base, sizes, found in zip(b["doc_id"].to_pylist(), b["base"].to_pylist(), b["sizes"].to_pylist(), b["found"]):
                found = found.values
                order = np.argsort(found.field("pos").to_numpy())
                pos, places, low, high = (found.field(f).to_numpy()[order] for f in ("pos", "places", "low", "high"))
                original = found.field("original").to_numpy(zero_copy_only=False)[order]
                own = base + pos
                rows = passages(np.array(sizes), pos, [np.where(low != own, low, high), np.where(high != own, high, low)],
                                places, original, least)
                out += [(doc, *r, sum(sizes)) for r in rows]
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    ["doc_id", "start_word", "n_words", "n_places", "original", "doc_words"])
    return run


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per repeated passage: doc_id, start_word, n_words, n_places, original, doc_words.

    `original` is true for the first place of a passage, which a dedup keeps; `n_places` counts the
    places of its most repeated window.
    """
    docs = id_and_text(docs)
    # half of a hash, so that positions can be added to it
    whole = staged(docs.mapInArrow(_chunks, CHUNK_SCHEMA).filter(F.size("sizes") > 0)
                   .withColumn("base", F.shiftright(F.xxhash64(F.monotonically_increasing_id()), 1)), "chunks")
    each = whole.select("base", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.posexplode("digests").alias("pos", "digest")) \
        .withColumn("code", F.col("base") + F.col("pos"))
    # partial counts and extremes: a window of a third of all documents is one row per task
    repeated = staged(each.groupBy("digest").agg(F.count("*").alias("places"), F.min("doc").alias("origin"),
                                                 F.min("code").alias("low"), F.max("code").alias("high"))
                      .filter("places > 1"), "repeated")
    found = each.join(repeated, "digest").groupBy("base").agg(F.collect_list(F.struct(  # windows of one document
        F.col("pos").cast("long").alias("pos"), "places", "low", "high", (F.col("doc") == F.col("origin")).alias("original"))).alias("found"))
    return whole.select("base", "doc_id", "sizes").join(found, "base") \
        .mapInArrow(_runs(min_words), "doc_id long, start_word long, n_words long, n_places long, "
                                      "original boolean, doc_words long")
