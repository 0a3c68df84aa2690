"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockstat.session import checkpoint_root

SLICE_BYTES = 2 << 20  # text that one vectorised step holds at a time


def importable(spark: SparkSession) -> None:
    """Let Python workers of a local master import this package wherever the driver started.

    On a cluster the package comes with --py-files.
    """
    sc = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if sc.master.startswith("local") and root not in sc.environment.get("PYTHONPATH", "").split(os.pathsep):
        sc.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, sc.environment.get("PYTHONPATH")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """Arrow batches of at most `rows` rows to Python workers while a job is run."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(key))
    spark.conf.set(key, str(min(before, rows) if before > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, str(before))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each query go as soon as it ends, for loops whose results are read once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def staged(df: DataFrame, name: str, rows_a_file: int = 0) -> DataFrame:
    """Write to the shared checkpoint folder and read back.

    Cuts lineage, so that a lost executor never repeats the work above and no
    later stage evaluates it twice.  `rows_a_file` bounds the files of large rows.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    with small_batches(spark):
        df.write.option("compression", "zstd").option("maxRecordsPerFile", rows_a_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, group: str, wanted: dict, id_col: str = "doc_id") -> DataFrame:
    """`wanted[g]` rows of each group, those whose id hashes lowest; fewer where a group has fewer.

    Group sizes are counted first, and only rows below about four times the share wanted
    go on to be ranked, so no task ranks more than a few times the sample.
    """
    sizes = {r[0]: r[1] for r in df.groupBy(group).agg(F.count("*")).collect() if r[0] in wanted}
    if not sizes:
        return df.filter(F.lit(False))
    share = F.create_map(*[F.lit(x) for g, n in sizes.items() for x in (g, min(1.0, 4 * wanted[g] / n))])
    low = F.pmod(F.xxhash64(id_col), F.lit(1 << 32)) / float(1 << 32)
    ranked = Window.partitionBy(group).orderBy(low, id_col)
    return df.filter(low < share[F.col(group)]).withColumn("__rank", F.row_number().over(ranked)) \
        .filter(F.col("__rank") <= F.create_map(*[F.lit(x) for g in sizes for x in (g, wanted[g])])[F.col(group)]) \
        .drop("__rank")


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names, whatever else the table holds."""
    importable(df.sparkSession)
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           cap: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that `column` holds about `cap` bytes in each piece."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // cap
        cuts = np.flatnonzero(np.diff(part)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(lo, hi - lo)
        pa.default_memory_pool().release_unused()  # two workers share what the JVM leaves of an executor


class Words(NamedTuple):
    """Words of a batch of texts: `codes[bounds[d]:bounds[d+1]]` index `vocab` for text d."""
    codes: np.ndarray
    bounds: np.ndarray
    vocab: list[str]


def split_words(texts: pa.Array, lower_ascii: bool = True) -> Words:
    """Words between ASCII white space (space, 0x09-0x0D); null texts have none."""
    texts = pc.fill_null(texts, "")
    if lower_ascii:
        texts = pc.ascii_lower(texts)
    return coded(pc.ascii_split_whitespace(texts))


def coded(lists: pa.Array) -> Words:
    """Dictionary-code the words of string lists, leaving out empty ones."""
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds -= bounds[0]
    enc = lists.flatten().dictionary_encode()
    codes = enc.indices.to_numpy(zero_copy_only=False)
    empty = pc.index(enc.dictionary, "").as_py()
    if empty >= 0:
        full = codes != empty
        bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
        codes = codes[full]
    return Words(codes, bounds, enc.dictionary.to_pylist())


def hash_words(vocab: list[str], seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in vocab), np.uint64, len(vocab))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, elementwise."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of each run of k word hashes; a shorter sequence counts as one run."""
    n = len(words)
    if n == 0:
        return words
    k = min(k, n)
    with np.errstate(over="ignore"):
        h = np.full(n - k + 1, k, np.uint64)
        for j in range(k):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[j:n - k + 1 + j])
    return h


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges starts[i] .. starts[i]+lengths[i], in the type of `starts`."""
    ends = np.cumsum(lengths)
    out = np.repeat((starts - (ends - lengths)).astype(starts.dtype), lengths)
    out += np.arange(len(out), dtype=starts.dtype)
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
