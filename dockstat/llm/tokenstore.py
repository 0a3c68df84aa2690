"""Token-ID files with directly addressable codes.

Documents are encoded with a public tokenizer file and written in ascending
doc_id order as blocks.  A block cuts each id into 8-bit chunks, level by level:
level 0 holds the low chunk of every id, a continuation bitmap marks the ids
that go on, level 1 holds the next chunk of those only, and so on.  A rank
directory per bitmap (ones before each group of 512 bits) leads from any token
position through the levels without decoding its neighbours.

Each block is a complete binary image (`pack_block`), written by Spark's Parquet
committer as one row (shard, block, payload), so lost or repeated tasks leave no
half files and any shared store will do.

Defined cases: null and empty texts hold the end id alone; a null doc_id sorts
first; rows that repeat a doc_id all stay, ordered by their ids' bytes; an empty
table gives no blocks and no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockstat.llm.common import slices, staged, id_and_text
from dockstat.llm.tokens import crc, default_tokenizer, encoder, with_end

MAGIC = b"DACB0001"
GROUP = 512  # bits of a bitmap for each entry of its rank directory
ROWS_PER_SHARD = 20_000
BLOCK_TOKENS = 1 << 20


# ---- the block format -------------------------------------------------------

def pack_block(doc_ids: list[int | None], starts: np.ndarray, ids: np.ndarray) -> bytes:
    """Image of one block: header, document table, then each level's chunks, bitmap and ranks."""
    present = np.array([d is not None for d in doc_ids], np.uint8)
    table = np.array([d if d is not None else 0 for d in doc_ids], "<i8")
    levels, rest = [], ids.astype(np.uint32)
    while True:
        chunk, rest = (rest & 0xFF).astype(np.uint8), rest >> np.uint32(8)
        more = rest > 0
        if not more.any():
            levels.append((chunk, None, None))
            break
        bits = np.packbits(more, bitorder="little")
        groups = np.add.reduceat(more, np.arange(0, len(more), GROUP), dtype=np.int64)
        levels.append((chunk, bits, np.concatenate([[0], np.cumsum(groups)]).astype("<u4")))
        rest = rest[more]
    out = [MAGIC, np.array([len(doc_ids), len(ids), len(levels)], "<i8").tobytes(),
           present.tobytes(), table.tobytes(), starts.astype("<i8").tobytes()]
    for chunk, bits, ranks in levels:
        out.append(np.array([len(chunk), 0 if bits is None else len(bits),
                             0 if ranks is None else len(ranks)], "<i8").tobytes())
        out.append(chunk.tobytes())
        if bits is not None:
            out += [bits.tobytes(), ranks.tobytes()]
    return b"".join(out)


class Block:
    """A block opened over its bytes; nothing is decoded until asked for."""

    def __init__(self, payload: bytes):
        if payload[:8] != MAGIC:
            raise ValueError("not a token block")
        at = 8

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(payload, kind, n, at)
            at += got.nbytes
            return got

        n_docs, self.n_tokens, n_levels = take("<i8", 3).tolist()
        present, table = take("u1", n_docs), take("<i8", n_docs)
        self.doc_ids = [d if p else None for d, p in zip(table.tolist(), present.tolist())]
        self.starts = take("<i8", n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            n, n_bits, n_ranks = take("<i8", 3).tolist()
            self.levels.append((take("u1", n), take("u1", n_bits), take("<u4", n_ranks)))

    def token(self, i: int) -> int:
        """The id at position i, by one step in each of its levels."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = shift = 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not len(bits) or not (bits[i >> 3] >> (i & 7)) & 1:
                break
            group = i // GROUP
            head = np.unpackbits(bits[group * GROUP // 8:(i >> 3) + 1], bitorder="little")
            i = int(ranks[group]) + int(head[:i - group * GROUP].sum())
            shift += 8
        return value

    def all(self) -> np.ndarray:
        """All ids, level by level from the last."""
        above = None
        for chunks, bits, _ in reversed(self.levels):
            ids = chunks.astype(np.uint32)
            if above is not None:
                more = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
                ids[more] |= above << np.uint32(8)
            above = ids
        return above


# ---- Spark ------------------------------------------------------------------

IDS_SCHEMA = "shard int, doc_id long, ids binary"
BLOCK_SCHEMA = "shard int, block int, n_tokens long, payload binary"
DOC_SCHEMA = "shard int, block int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def packed(ids: np.ndarray) -> bytes:
    """Ids for the shuffle: two bytes each where that is enough, else four; the width comes first."""
    return b"\x02" + ids.astype("<u2").tobytes() if int(ids.max(initial=0)) < 1 << 16 else b"\x04" + ids.tobytes()


def unpacked(row: bytes) -> np.ndarray:
    return np.frombuffer(row, f"<u{row[0]}", offset=1).astype(np.uint32)


def _encode(path: str, end_id: int, bounds: list[int]):
    limits = np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches, cap=4 << 20):
            ids, at = with_end(*enc.encode(b["text"]), end_id)
            doc = b["doc_id"].to_pylist()
            shard = [0 if d is None else int(s) for d, s in
                     zip(doc, np.searchsorted(limits, [d or 0 for d in doc], side="left"))]
            rows = [packed(ids[s:e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), b["doc_id"], pa.array(rows, pa.binary())],
                ["shard", "doc_id", "ids"])
    return run


def _blocks(block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, docs, parts, held = None, 0, [], [], 0

        def flush():
            nonlocal block, docs, parts, held
            ids = np.concatenate(parts)
            starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            row = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()),
                 pa.array([held], pa.int64()), pa.array([pack_block(docs, starts, ids)], pa.binary())],
                ["shard", "block", "n_tokens", "payload"])
            block, docs, parts, held = block + 1, [], [], 0
            return row

        for b in batches:
            for s, d, ids in zip(b["shard"].to_pylist(), b["doc_id"].to_pylist(), b["ids"].to_pylist()):
                if docs and (s != shard or held >= block_tokens):
                    yield flush()
                if s != shard:
                    shard, block = s, 0
                docs.append(d)
                parts.append(unpacked(ids))
                held += len(parts[-1])
        if docs:
            yield flush()
    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for s, k, payload in zip(b["shard"], b["block"], b["payload"]):
            block = Block(payload.as_py())
            ids, at = block.all().astype("<u4"), block.starts.tolist()
            n = len(block.doc_ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([s.as_py()] * n, pa.int32()), pa.array([k.as_py()] * n, pa.int32()),
                 pa.array(block.doc_ids, pa.int64()), pa.array(at[:-1], pa.int64()),
                 pa.array(np.diff(block.starts), pa.int64()),
                 pa.array([crc(ids[x:y]) for x, y in zip(at[:-1], at[1:])], pa.int64())],
                ["shard", "block", "doc_id", "local_start", "n_tokens", "ids_crc32"])


def write_token_blocks(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2,
                       rows_per_shard: int = ROWS_PER_SHARD,
                       block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Encode, order and write; returns the written blocks (shard, block, n_tokens, payload).

    Shards are doc_id ranges between approximate quantiles of the ids alone, so
    texts are read and encoded once and only packed ids are shuffled.
    """
    docs = id_and_text(docs)
    n_rows = docs.count()
    n = max(1, -(-n_rows // rows_per_shard))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n)
                    .alias("q")).first()["q"] if n > 1 else []
    cuts = sorted(set(cuts or []))
    ids = docs.mapInArrow(_encode(tokenizer or default_tokenizer(), end_id, cuts), IDS_SCHEMA)
    ordered = ids.repartitionById(len(cuts) + 1, F.col("shard")) \
        .sortWithinPartitions("shard", "doc_id", "ids")
    return staged(ordered.mapInArrow(_blocks(block_tokens), BLOCK_SCHEMA), "token-blocks")


def read_token_blocks(blocks: DataFrame) -> DataFrame:
    """Documents of written blocks: doc_id, start, n_tokens, ids_crc32 (and shard, block)."""
    within = Window.partitionBy("shard").orderBy("block")
    places = blocks.select("shard", "block", "n_tokens") \
        .withColumn("before", F.sum("n_tokens").over(within) - F.col("n_tokens"))
    # one row for each shard, a few thousand at any size
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("in_shard")) \
        .withColumn("shard_start", F.sum("in_shard").over(Window.orderBy("shard")) - F.col("in_shard"))
    places = places.join(shards, "shard") \
        .select("shard", "block", (F.col("before") + F.col("shard_start")).alias("block_start"))
    return blocks.select("shard", "block", "payload").mapInArrow(_read, DOC_SCHEMA) \
        .join(places, ["shard", "block"]) \
        .select("doc_id", (F.col("local_start") + F.col("block_start")).alias("start"),
                "n_tokens", "ids_crc32", "shard", "block")


def token_store(docs: DataFrame, **options) -> DataFrame:
    """Write `docs` as token blocks and report each document as read back from them."""
    return read_token_blocks(write_token_blocks(docs, **options))
