"""From raw documents to packed training sequences: the corpus pipeline over the llm operators.

Stages, in order; each works on all that the one before kept, and all but the last
return the columns of `documents`:

1. language ID: documents of no learned language go (null or letterless texts, and texts that
   cross-parsing can't put together from any language's phrases);
2. line dedup: lines of recurring templates go, but for their first document; near copies count
   as one document, so that they keep the same lines and the next stage still finds them;
3. near dedup: of each group of near duplicates (five-word shingles, 0.8) one stays;
4. decontamination: documents that contain a benchmark item go;
5. packing: pieces of the remaining documents in sequences of 4096 tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockstat.llm import decontam, langid, linededup, minhash, packing
from dockstat.llm.common import staged, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.split_rest("doc_id", 4) == 2)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copies = staged(minhash.near_duplicates(docs, shingle_words=5, percent=80).filter("component_id <> doc_id")
                    .select("doc_id", F.col("component_id").alias("unit")).distinct().dropDuplicates(["doc_id"]), "copies")
    kept = linededup.drop_recurring_lines(docs, groups=copies)
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one_of_each(docs, shingle_words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Cross-parsing, templates and packing are beyond SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
