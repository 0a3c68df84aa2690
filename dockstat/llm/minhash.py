"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

Sketch.  A document's set is its distinct word shingles.  In round i each element
is hashed to one bin and leaves a value that grows with i, so earlier rounds win;
rounds go on until every bin is full, and after `size` rounds all elements go to
one fixed bin per round, which fills the last ones for certain.  Every coordinate
therefore holds an element's value, whatever the set's size, and the share of
equal coordinates estimates the Jaccard similarity with Chernoff-type bounds.

Candidates.  Coordinates are cut into `BANDS` bands of `ROWS`; sets equal in one
band meet in a bucket.  At similarity 0.8 a pair stays apart with probability
(1 - 0.8^ROWS)^BANDS, about 1e-5.

Links without all pairs.  Documents with equal sets are one class from the start.
Each class is verified against the most central leader of its buckets, and what is
linked merges; a few rounds follow in which every component that still shares a bucket
with another tries TRIES pairs.  What is left is verified in full: in buckets that
still hold more than one component, members outside the largest one against all
members of other components.  That goes in blocks of bounded size, each pair of blocks
one step inside a task, which reports only links that join components.  Pairs inside a
component need no test, as they can't change it.  So no group is expanded into pairs of
rows, and none is collected whole.

Defined cases: a null or word-less text has an empty set and is linked with nothing
(component_id is its doc_id); rows that repeat a doc_id stay, each with its own
set's component; a document without a doc_id takes the component of documents with
an equal set, but makes no links and is not kept; empty tables give no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockstat.llm.common import (hash_words, mix, ragged, shingle_hashes, signed, slices, split_words,
                                 staged, id_and_text)
from dockstat.llm.graph import components

ROWS, BANDS = 7, 48
ROUNDS, TRIES = 1, 3
MEMBER_BLOCK, OUTSIDE_BLOCK = 400_000, 100_000  # shingles
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = split_words(texts)
    hashed = hash_words(words.vocab)[words.codes]
    out = []
    for s, e in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        h = np.sort(shingle_hashes(hashed[s:e], k))
        out.append(h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h)
    return out


def similarity_sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Fast similarity sketches, one row of `size` coordinates per set; empty sets keep EMPTY."""
    out = np.full((len(sets), size), EMPTY)
    flat = out.reshape(-1)
    open_ = [i for i, s in enumerate(sets) if len(s)]
    length = np.array([len(sets[i]) for i in open_], np.int64)
    owner = np.array(open_, np.int64)
    elements = np.concatenate([sets[i] for i in open_]) if open_ else np.empty(0, np.uint64)
    for i in range(2 * size):
        if not len(owner):
            break
        of = np.repeat(owner, length)
        with np.errstate(over="ignore"):
            h = mix(elements + np.uint64(i + 1) * np.uint64(0x9E3779B97F4A7C15))
            value = np.uint64(i) << np.uint64(48) | mix(h ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(16)
        if i < size:
            place = ((h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            place = np.full(len(h), i - size)
        np.minimum.at(flat, of * size + place, value)
        still = (out[owner] == EMPTY).any(axis=1)
        if not still.all():
            first = np.cumsum(length) - length
            elements = elements[ragged(first[still], length[still])]
            owner, length = owner[still], length[still]
    return out


def band_keys(sketches: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One 64-bit key per band, the band's number mixed in."""
    keys = np.empty((len(sketches), bands), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            key = np.full(len(sketches), b + 1, np.uint64)
            for j in range(b * rows, (b + 1) * rows):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sketches[:, j])
            keys[:, b] = key
    return keys


def _classes(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), "<i8").reshape(-1, 2)
    return digest[:, 0], digest[:, 1]


def _sketch(k: int, rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = shingle_sets(b["text"], k)
            c1, c2 = _classes(sets)
            keys = signed(band_keys(similarity_sketches(sets, rows * bands), rows, bands))
            offsets = np.arange(len(sets) + 1, dtype=np.int32) * bands
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(c1), pa.array(c2),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1)))],
                ["doc_id", "n_shingles", "c1", "c2", "bands"])
    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = shingle_sets(b["text"], k)
            c1, c2 = _classes(sets)
            same = (c1 == b["c1"].to_numpy()) & (c2 == b["c2"].to_numpy())
            yield pa.RecordBatch.from_arrays(
                [b["node"].filter(pa.array(same)),
                 pa.array([signed(s) for s, x in zip(sets, same) if x], pa.list_(pa.int64()))],
                ["node", "shingles"])
    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb, ...) whose full sets reach the similarity; other columns stay."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b") \
        .withColumn("common", F.size(F.array_intersect("sa", "sb"))) \
        .filter(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))) \
        .drop("sa", "sb", "common", "na", "nb")


def _unsettled(named: DataFrame) -> DataFrame:
    """(key, node, n, mates, component) of buckets that hold more than one component."""
    named = named.select("key", "node", "n", "mates", "component")
    open_ = named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    return staged(named.join(open_, "key", "left_semi"), "unsettled")


def _tries(named: DataFrame, attempt: int) -> DataFrame:
    """TRIES pairs (a, b, na, nb, ca, cb) a component: one of its members in a bucket, and the
    most central member there of the bucket's largest component."""
    per = named.groupBy("key", "component").agg(
        F.count("*").alias("size"),
        F.min_by(F.struct("node", "n"), F.xxhash64("node", "key", F.lit(attempt))).alias("rep"),
        F.max_by(F.struct("node", "n"), F.struct("mates", "node")).alias("centre"))
    hubs = per.groupBy("key").agg(F.max_by(F.struct("component", "centre"), F.struct("size", "component")).alias("hub"))
    pairs = per.join(hubs, "key").filter("component <> hub.component")
    pick = [F.min_by(F.struct("rep", "hub"), F.xxhash64("rep.node", "hub.centre.node", F.lit(i))) for i in range(TRIES)]
    return pairs.groupBy("component").agg(F.array(*pick).alias("picked")) \
        .select(F.col("component").alias("ca"), F.explode(F.array_distinct("picked")).alias("p")) \
        .select(F.col("p.rep.node").alias("a"), F.col("p.rep.n").alias("na"), F.col("p.hub.centre.node").alias("b"),
                F.col("p.hub.centre.n").alias("nb"), "ca", F.col("p.hub.component").alias("cb"))


def _block_links(outside: list[tuple], members: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links between blocks of (node, component, shingles) that join components, a spanning few."""
    sets = [x[2] for x in outside] + [x[2] for x in members]
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    size = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(size)
    base, own = int(ends[len(outside) - 1]), size[len(outside):]
    theirs, first = number[base:], (ends - size)[len(outside):] - base
    component = np.array([x[1] for x in members])
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    mark, links = np.zeros(int(number.max()) + 1, bool), []
    for i, (node, comp, _) in enumerate(outside):
        ids = number[ends[i] - size[i]:ends[i]]
        mark[ids] = True
        common = np.add.reduceat(mark[theirs], first, dtype=np.int64)
        mark[ids] = False
        for j in np.flatnonzero((100 * common >= percent * (size[i] + own - common)) & (component != comp)).tolist():
            x, y = root(comp), root(int(component[j]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((node, members[j][0]))
    return links


def _left_over(named: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) found among all pairs that are left, block against block within buckets."""
    largest = named.groupBy("key", "component").agg(F.count("*").alias("size"), F.sum("n").alias("sum_n")) \
        .groupBy("key").agg(F.max_by("component", "size").alias("largest"), F.sum("sum_n").alias("all_n"),
                            F.max_by("sum_n", "size").alias("largest_n"))
    rows = named.join(largest, "key").withColumn("outside", F.col("component") != F.col("largest")) \
        .withColumn("m", F.ceil(F.col("all_n") / MEMBER_BLOCK).cast("int")) \
        .withColumn("o", F.ceil((F.col("all_n") - F.col("largest_n")) / OUTSIDE_BLOCK).cast("int")) \
        .select("key", "node", "component", "outside", "m", "o").join(sets, "node")
    member = rows.withColumn("i", F.pmod(F.hash("node"), "m")) \
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("o") - 1))).withColumn("outside", F.lit(False))
    outside = rows.filter("outside").withColumn("j", F.pmod(F.hash("node"), "o")) \
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, sides = None, ([], [])

        def found():
            links = _block_links(sides[1], sides[0], percent) if sides[0] and sides[1] else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

        for b in batches:
            shingles, at = b["shingles"].values.to_numpy(), b["shingles"].offsets.to_numpy()
            for r, (key, i, j, out, node, comp) in enumerate(zip(*(b[c].to_pylist() for c in (
                    "key", "i", "j", "outside", "node", "component")))):
                if group != (key, i, j):
                    if group is not None:
                        yield found()
                    group, sides = (key, i, j), ([], [])
                sides[out].append((node, comp, shingles[at[r]:at[r + 1]]))
        if group is not None:
            yield found()

    keep = ["key", "i", "j", "outside", "node", "component", "shingles"]
    return member.select(keep).unionByName(outside.select(keep)) \
        .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "outside").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80,
                    rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    docs = id_and_text(docs)
    marked = staged(docs.mapInArrow(_sketch(shingle_words, rows, bands),
                                    "doc_id long, n_shingles long, c1 long, c2 long, bands array<long>"), "sketches")
    # one node per distinct set; its number is fixed by being written
    nodes = staged(marked.filter("n_shingles > 0").groupBy("c1", "c2")
                   .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"))
                   .withColumn("node", F.monotonically_increasing_id()), "nodes")
    one = marked.join(nodes.select("c1", "c2", "node", "n", F.col("rep").alias("doc_id")), ["c1", "c2", "doc_id"])
    # a repeated row only repeats its set's entries, which changes no link
    bucketed = staged(one.select(F.explode("bands").alias("key"), "node", "n"), "bands")
    shared = bucketed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    members = bucketed.join(shared, "key")
    # central nodes share buckets with many: they hold a group of near copies together
    members = staged(members.join(members.groupBy("node").agg(F.sum("size").alias("mates")), "node")
                     .select("key", "node", "n", "mates"), "members")
    similar = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")

    wanted = members.select("node").distinct().join(nodes, "node") \
        .select("node", "c1", "c2", F.col("rep").alias("doc_id"))
    sets = staged(docs.join(wanted, "doc_id").select("node", "c1", "c2", "text")
                  .mapInArrow(_sets(shingle_words), "node long, shingles array<long>"), "sets")

    rank = F.struct("mates", -F.col("node"))
    leaders = members.groupBy("key").agg(F.max_by(F.struct("node", "n", "mates"), rank).alias("leader"))
    first = members.join(leaders, "key").filter("node <> leader.node") \
        .groupBy(F.col("node").alias("b")).agg(
            F.max_by("leader", F.struct("leader.mates", -F.col("leader.node"))).alias("leader"), F.first("n").alias("nb")) \
        .select(F.col("leader.node").alias("a"), "b", F.col("leader.n").alias("na"), "nb")
    links = staged(_verified(first.filter(similar), sets, percent).select("a", "b"), "links")
    named = _unsettled(members.join(components(links), "node", "left")
                       .withColumn("component", F.coalesce("component", "node")))
    for attempt in range(ROUNDS):
        new = staged(_verified(_tries(named, attempt).filter(similar), sets, percent), "new-links")
        if new.isEmpty():
            break
        links = links.union(new.select("a", "b"))
        moved = components(new.select(F.col("ca").alias("a"), F.col("cb").alias("b"))) \
            .select(F.col("node").alias("component"), F.col("component").alias("to"))
        named = _unsettled(named.join(moved, "component", "left")
                           .withColumn("component", F.coalesce("to", "component")).drop("to"))
    final = components(links.union(_left_over(named, sets, percent)))

    # smallest doc_id of each component, told to every set in it
    whole = nodes.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = whole.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_set = whole.join(smallest, "component").select("c1", "c2", "component_id")
    return marked.drop("bands").join(by_set, ["c1", "c2"], "left") \
        .select("doc_id", "n_shingles",
                F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """Rows of `docs` that are the kept document of their component.

    A repeated doc_id is kept once; rows without a doc_id can't be told apart and all stay.
    """
    kept = near_duplicates(docs, **options).filter("kept").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns) \
        .unionByName(docs.filter("doc_id is null"))
