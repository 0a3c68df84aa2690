"""Line dedup by a fixed-depth tree of line templates.

A line's path in the tree is its token count and its LEADING first tokens; tokens with
a digit are variable from the start.  In a leaf that MIN_DOCS documents reach, a token's
support at its position is the number of documents that have it there, added up over the
leaf's distinct lines; support below MIN_DOCS is none.  A line's core is FIXED_PERCENT of
its tokens without a digit (FIXED_LEAST at least, all if it has fewer), never below
LEAST_CORE tokens unless the line has but one.  Its best-supported tokens, as many as the
core has, and any that tie with the last of them, are fixed and form the line's template;
all others are variable fields, and a line with too few supported tokens has no template.
A field's value never has more support than the words around it, so ranks, unlike a bar
for each token, choose the same tokens however large the leaf is.  A template that MIN_DOCS
or more documents share is recurring.  Lines of a recurring template are dropped, except in
the document of the smallest doc_id that has one.  A whole line of WHOLE_WORDS or more
tokens without a digit is no chance match: it is recurring from WHOLE_DOCS documents on,
with all that differ from it in digit tokens only.

Documents may be grouped: a group then counts as one document, named by its smallest
doc_id.  With groups of near copies, lines recur between texts that are not copies anyway,
and what one copy keeps the others keep, so that they are still copies afterwards.

Everything is counted with partial aggregation over distinct lines, so a line or a
leaf that a third of all documents share is one row per task before any shuffle; and
only lines of leaves that many documents reach are ever taken apart into tokens.

Lines end at newlines; tokens lie between ASCII white space and are compared in lower
case.  Lines of fewer than `min_tokens` tokens (3 by default, as shorter ones recur by
chance) are left alone; with 1 every line takes part.

Defined cases: null and empty texts have no lines and stay as they are; repeated rows
of a doc_id are one document, and each of its texts loses its own lines; rows without a
doc_id stay unchanged and count for nothing; a document whose every line is dropped goes;
empty tables give no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockstat.llm.common import coded, hash_words, id_and_text, importable, mix, signed, slices, staged

LEADING, MIN_DOCS, MIN_TOKENS = 3, 10, 3
WHOLE_DOCS, WHOLE_WORDS = 2, 6
FIXED_PERCENT, FIXED_LEAST, LEAST_CORE = 75, 4, 2
VARIABLE = "<*>"
LINE_SCHEMA = "doc_id long, text_key long, line_no int, n_tokens int, n_words int, leaf long, skeleton long"


class Lines:
    """The lines of a batch of texts that have enough tokens, with their place in the tree."""

    def __init__(self, texts: pa.Array, leading: int, least: int):
        lines = pc.split_pattern(pc.fill_null(texts, ""), "\n")
        at = lines.offsets.to_numpy().astype(np.int64)
        at -= at[0]
        self.words = coded(pc.ascii_split_whitespace(pc.utf8_lower(lines.flatten())))
        self.variable = pc.match_substring_regex(pa.array(self.words.vocab, pa.string()), r"\d") \
            .to_numpy(zero_copy_only=False)
        hashed = hash_words(self.words.vocab)
        hashed[self.variable] = hash_words([VARIABLE])
        token, bounds = hashed[self.words.codes], self.words.bounds
        n = np.diff(bounds)
        doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
        keep = np.flatnonzero(n >= least)
        self.start, self.n, self.doc = bounds[:-1][keep], n[keep], doc[keep]
        self.line_no = keep - at[self.doc]
        leaf = mix(self.n.astype(np.uint64))
        with np.errstate(over="ignore"):
            for j in range(leading):
                has = self.n > j
                leaf[has] = mix(leaf[has] * np.uint64(31) + token[self.start[has] + j])
            # a sum over all tokens of the line, each mixed with its position
            nth = (np.arange(len(token)) - np.repeat(bounds[:-1], n)).astype(np.uint64)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(token ^ mix(nth + np.uint64(1))))])
            skeleton = mix(total[self.start + self.n] - total[self.start] + leaf)
        plain = np.concatenate([[0], np.cumsum(~self.variable[self.words.codes])])
        self.n_words = plain[self.start + self.n] - plain[self.start]
        self.leaf, self.skeleton = signed(leaf), signed(skeleton)

    def tokens(self, i: int) -> list[str]:
        codes = self.words.codes[self.start[i]:self.start[i] + self.n[i]].tolist()
        return [VARIABLE if self.variable[c] else self.words.vocab[c] for c in codes]


def _lines(leading: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = Lines(b["text"], leading, least)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].take(pa.array(x.doc)), b["text_key"].take(pa.array(x.doc)), pa.array(x.line_no, pa.int32()), pa.array(x.n, pa.int32()),
                 pa.array(x.n_words, pa.int32()), pa.array(x.leaf), pa.array(x.skeleton)],
                ["doc_id", "text_key", "line_no", "n_tokens", "n_words", "leaf", "skeleton"])
    return run


def _tokens(leading: int, least: int):
    """Tokens of the requested lines, found again by their skeletons."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x, wanted = Lines(b["text"], leading, least), [set(w) for w in b["wanted"].to_pylist()]
            got = {s: i for i, (d, s) in enumerate(zip(x.doc.tolist(), x.skeleton.tolist())) if s in wanted[d]}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(got), pa.int64()), pa.array([x.tokens(i) for i in got.values()], pa.list_(pa.string()))],
                ["skeleton", "tokens"])
    return run


def recurring_lines(docs: DataFrame, leading: int = LEADING, min_docs: int = MIN_DOCS,
                    min_tokens: int = MIN_TOKENS, groups: DataFrame | None = None) -> DataFrame:
    """One row per line of a recurring template: doc_id, line_no, template_id, n_docs, dropped, text_key.

    `groups` (doc_id, unit) names the documents that count as another one.
    """
    docs = id_and_text(docs).filter("doc_id is not null").withColumn("text_key", F.xxhash64("text"))
    lines = docs.mapInArrow(_lines(leading, min_tokens), LINE_SCHEMA)
    if groups is None:
        lines = lines.withColumn("unit", F.col("doc_id"))
    else:
        lines = lines.join(groups.select("doc_id", "unit"), "doc_id", "left").withColumn("unit", F.coalesce("unit", "doc_id"))
    lines = staged(lines, "lines")
    busy = lines.select("leaf", "unit").distinct().groupBy("leaf").agg(F.count("*").alias("n")) \
        .filter(F.col("n") >= min_docs).select("leaf")
    # distinct lines, with the documents that have them and one place to read them
    whole = (F.col("n_docs") >= WHOLE_DOCS) & (F.col("n_words") >= WHOLE_WORDS)
    counted = staged(
        lines.groupBy("leaf", "skeleton", "unit").agg(F.first("n_tokens").alias("n_tokens"), F.first("n_words").alias("n_words"),
                                                      F.min("doc_id").alias("doc_id"))
        .groupBy("leaf", "skeleton").agg(F.count("*").alias("n_docs"), F.first("n_tokens").alias("n_tokens"),
                                         F.first("n_words").alias("n_words"), F.min("doc_id").alias("doc_id"),
                                         F.min("unit").alias("first_unit"))
        .join(busy.withColumn("busy", F.lit(True)), "leaf", "left").filter(whole | F.col("busy")), "skeletons")
    skeletons = counted.filter("busy")
    wanted = skeletons.groupBy("doc_id").agg(F.collect_list("skeleton").alias("wanted"))  # lines of one document
    read = staged(docs.join(wanted, "doc_id").select("text", "wanted")
                  .mapInArrow(_tokens(leading, min_tokens), "skeleton long, tokens array<string>")
                  .dropDuplicates(["skeleton"])  # a doc_id may have come twice
                  .join(skeletons.select("skeleton", "leaf", "n_tokens", "n_words", "n_docs"), "skeleton"), "line-tokens")
    placed = read.select("leaf", "skeleton", "n_tokens", "n_words", "n_docs", F.posexplode("tokens").alias("pos", "token")) \
        .filter(F.col("token") != VARIABLE)
    # a document's variants of a line count each; all the tokens that they share gain alike, and only ranks matter
    support = placed.groupBy("leaf", "pos", "token").agg(F.sum("n_docs").alias("support")) \
        .filter(F.col("support") >= min_docs)
    share = F.least(F.col("n_words"), F.greatest(F.lit(FIXED_LEAST), F.ceil(F.col("n_words") * FIXED_PERCENT / 100)))
    enough = F.greatest(share, F.least(F.lit(LEAST_CORE), F.col("n_tokens"))).cast("int")
    ranked = placed.join(support, ["leaf", "pos", "token"]).groupBy("leaf", "skeleton", "n_tokens", "n_words") \
        .agg(F.sort_array(F.collect_list(F.struct("support", "pos", "token")), asc=False).alias("ranked")) \
        .withColumn("enough", enough).filter(F.size("ranked") >= F.col("enough")) \
        .withColumn("least", F.expr("ranked[enough - 1].support"))
    template = staged(ranked.select("leaf", "skeleton", F.xxhash64("leaf", F.expr(
        "array_sort(transform(filter(ranked, x -> x.support >= least), x -> struct(x.pos, x.token)))")).alias("template_id")),
        "templates")
    documents = lines.join(template, ["leaf", "skeleton"]).select("template_id", "unit").distinct() \
        .groupBy("template_id").agg(F.count("*").alias("n_docs"), F.min("unit").alias("first_unit")) \
        .filter(F.col("n_docs") >= min_docs)
    recurring = staged(template.join(documents, "template_id").select("leaf", "skeleton", "template_id", "n_docs", "first_unit"),
                       "recurring")
    alone = counted.filter(whole).join(recurring, ["leaf", "skeleton"], "left_anti") \
        .select("leaf", "skeleton", F.xxhash64("leaf", "skeleton").alias("template_id"), "n_docs", "first_unit")
    return lines.select("doc_id", "unit", "text_key", "line_no", "leaf", "skeleton").distinct() \
        .join(recurring.unionByName(alone), ["leaf", "skeleton"]) \
        .select("doc_id", "line_no", "template_id", "n_docs", (F.col("unit") != F.col("first_unit")).alias("dropped"), "text_key")


def drop_recurring_lines(docs: DataFrame, **options) -> DataFrame:
    """`docs` without the dropped lines; documents that lose every line go, all else stays as it was."""
    importable(docs.sparkSession)
    schema = docs.schema
    dropped = recurring_lines(docs, **options).filter("dropped") \
        .groupBy(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key")) \
        .agg(F.sort_array(F.collect_set("line_no")).alias("__dropped"))
    key = F.xxhash64(docs["text"].cast("string"))
    marked = docs.join(dropped, (docs["doc_id"] == F.col("__doc")) & (key == F.col("__key")), "left").drop("__doc", "__key")
    at = schema.fieldNames().index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts, keep = [], []
            for text, gone in zip(b["text"].to_pylist(), b["__dropped"].to_pylist()):
                if text is not None and gone:
                    gone = set(gone)
                    lines = [x for i, x in enumerate(text.split("\n")) if i not in gone]
                    keep.append(any(x.strip() for x in lines))
                    text = "\n".join(lines)
                else:
                    keep.append(True)
                texts.append(text)
            columns = b.columns[:-1]
            columns[at] = pa.array(texts, b["text"].type)
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames()).filter(pa.array(keep))
    return marked.mapInArrow(run, schema)
