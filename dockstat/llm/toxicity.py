"""Toxicity scores by a convolutional text classifier in numpy.

A word's vector is the sum of hashed embeddings of the word and of its beginnings,
so inflected forms share what is learned.  Filters of several widths slide over the
whole text, each keeps its largest response (max pooling), and a logistic layer
turns these into a logit.  Thresholds are calibrated by language, the language being
predicted from the text itself (cross-parsing, `langid`), and shifted so that a
score of 0.5 is the threshold.

The network learns from the whole texts of all labelled rows that aren't held out.  A hash
of the id deals them into shards of about SHARD_CHARS characters, coded once.  In each
epoch every shard goes through its rows from the same network, side by side, and the
networks it returns are averaged: a word's vector over the shards that changed it, all else
over all shards.  One row in five doesn't teach but calibrates the thresholds, by exact
counts of both labels in steps of 1 / STEPS logit.  The network itself (vectors of at most
BUCKETS word buckets) is all that the driver holds.

Defined cases: null and empty texts are scored as a text without words; labels other
than 0 and 1 are not learned from, and 1 wins where a doc_id has both; if only one
class is labelled every score is that class, and 0 without any label; repeated rows
are scored each; a null doc_id counts as not held out; other columns are not read.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockstat.llm import langid
from dockstat.llm.common import Words, coded, importable, ragged, slices, shuffles_dropped, small_batches, staged
from dockstat.operators.joins import bounded_broadcast
from dockstat.session import work_path

BUCKETS = 1 << 22
PREFIXES = (4, 5, 6)
DIM, FILTERS, WIDTHS = 12, 8, (1, 2, 3)
PAD = max(WIDTHS)  # so that even a text without words has a window of every width
SHARD_CHARS = 8_000_000
BLOCK = 1 << 13  # word vectors that are averaged by one group
BLOCKS_A_READ = 16
STEPS = 64       # of a threshold, to a logit
MIN_DOCS, EPOCHS, BATCH, RATE, DECAY = 3, 8, 64, 0.1, 1e-5


def text_words(texts: pa.Array) -> Words:
    """Lower-cased runs of letters and digits."""
    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\pL\pN]+", " ")
    return coded(pc.split_pattern(plain, " "))


def word_features(vocab: list[str]) -> np.ndarray:
    """Buckets of each word and of its beginnings, (words, 1 + len(PREFIXES))."""
    h = xxhash.xxh3_64_intdigest
    out = np.empty((len(vocab), 1 + len(PREFIXES)), np.int64)
    out[:, 0] = np.fromiter((h(w) % BUCKETS for w in vocab), np.int64, len(vocab))
    for j, n in enumerate(PREFIXES):
        out[:, j + 1] = np.fromiter((h(w[:n], n) % BUCKETS for w in vocab), np.int64, len(vocab))
    return out


def padded(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word codes from 1 on with PAD zeros after each text, and the texts' bounds."""
    n = np.diff(words.bounds) + PAD
    at = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(int(at[-1]), np.int32)
    mask = np.ones(len(out), bool)
    for j in range(1, PAD + 1):
        mask[at[1:] - j] = False
    out[mask] = words.codes[words.bounds[0]:words.bounds[-1]] + 1
    return out, at


@dataclass
class Network:
    buckets: np.ndarray                # learned buckets, sorted
    embedding: np.ndarray              # their vectors, and a last row of zeros for all others
    filters: dict[int, np.ndarray]     # width -> (width, DIM, FILTERS)
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float

    def vectors(self, features: np.ndarray) -> np.ndarray:
        """Word vectors with a first row of zeros for padding."""
        at = np.searchsorted(self.buckets, features).clip(max=len(self.buckets) - 1)
        rows = np.where(self.buckets[at] == features, at, len(self.buckets))
        return np.concatenate([np.zeros((1, DIM), np.float32), self.embedding[rows].sum(axis=1)])

    def pooled(self, vectors: np.ndarray, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Largest response of every filter over each text, (texts, filters of all widths)."""
        parts = []
        for w in WIDTHS:
            n = len(codes) - w + 1
            response = np.zeros((n, FILTERS), np.float32)
            for j in range(w):
                response += (vectors @ self.filters[w][j])[codes[j:j + n]]
            ends = np.stack([at[:-1], at[1:] - w + 1], axis=1).reshape(-1)[:-1]
            parts.append(np.maximum.reduceat(response, ends, axis=0)[::2] + self.bias[w])
        return np.maximum(np.concatenate(parts, axis=1), 0)

    def logits(self, texts: pa.Array) -> np.ndarray:
        if len(texts) == 0:
            return np.zeros(0)
        words = text_words(texts)
        codes, at = padded(words)
        return self.pooled(self.vectors(word_features(words.vocab)), codes, at) @ self.out + self.out_bias


def new_network(buckets: np.ndarray, rng: np.random.Generator) -> Network:
    if not len(buckets):
        buckets = np.array([-1], np.int32)
    embedding = np.zeros((len(buckets) + 1, DIM), np.float32)
    for lo in range(0, len(buckets), BLOCK):
        embedding[lo:min(lo + BLOCK, len(buckets))] = rng.normal(0, 0.1, (min(BLOCK, len(buckets) - lo), DIM))
    return Network(buckets, embedding,
                   {w: rng.normal(0, 0.5 / w ** 0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS},
                   {w: np.zeros(FILTERS, np.float32) for w in WIDTHS},
                   rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32), 0.0)


@dataclass
class Trained:
    """A network between two epochs, with Adagrad's sums; `rng` as it was before the first epoch."""
    network: Network
    rng: np.random.Generator
    past_rows: np.ndarray
    past: dict[str, np.ndarray]

    def dense(self) -> np.ndarray:
        """All parameters but the word vectors, and their sums, as one vector."""
        n = self.network
        params = [*(n.filters[w] for w in WIDTHS), *(n.bias[w] for w in WIDTHS), n.out, np.array([n.out_bias])]
        return np.concatenate([x.ravel() for x in [*params, *(self.past[k] for k in sorted(self.past))]]).astype(np.float64)

    def load_dense(self, flat: np.ndarray) -> None:
        n, at = self.network, 0

        def take(like: np.ndarray) -> np.ndarray:
            nonlocal at
            at += like.size
            return flat[at - like.size:at].reshape(like.shape).astype(np.float32)
        n.filters = {w: take(n.filters[w]) for w in WIDTHS}
        n.bias = {w: take(n.bias[w]) for w in WIDTHS}
        n.out = take(n.out)
        n.out_bias = float(take(np.zeros(1))[0])
        self.past = {k: take(self.past[k]) for k in sorted(self.past)}


def untrained(buckets: np.ndarray, seed: int = 11) -> Trained:
    rng = np.random.default_rng(seed)
    net = new_network(buckets, rng)
    params = {f"w{w}": net.filters[w] for w in WIDTHS} | {f"b{w}": net.bias[w] for w in WIDTHS} | {"o": net.out}
    return Trained(net, rng, np.full((len(net.buckets), DIM), 1e-2, np.float32), {k: np.full(x.shape, 1e-2, np.float32) for k, x in params.items()})


@dataclass
class Shard:
    """Labelled rows of one shard in coded form."""
    codes: np.ndarray     # of words, from 1 on, with padding (`padded`)
    at: np.ndarray        # bounds of the texts
    features: np.ndarray  # buckets of each word
    y: np.ndarray
    tune: np.ndarray      # whether the row calibrates
    langs: list[str]      # predicted languages of those rows

    @staticmethod
    def of(r: dict) -> Shard:
        return Shard(np.frombuffer(r["codes"], np.int32), np.frombuffer(r["at"], np.int64),
                     np.frombuffer(r["features"], np.int32).reshape(-1, 1 + len(PREFIXES)),
                     np.frombuffer(r["y"], np.int8), np.frombuffer(r["tune"], np.bool_), r["langs"])

    def picked(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and bounds of some rows."""
        size = np.diff(self.at)[rows]
        return self.codes[ragged(self.at[:-1][rows], size)], np.concatenate([[0], np.cumsum(size)])


SHARD = "shard long, codes binary, at binary, features binary, y binary, tune binary, langs array<string>"


def learned_buckets(shard: Shard, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words of some rows, and in how many (row, word) pairs they are."""
    codes, at = shard.picked(rows)
    doc = np.repeat(np.arange(len(rows)), np.diff(at))
    words = len(shard.features)
    seen = np.unique(doc[codes > 0] * np.int64(max(1, words)) + codes[codes > 0] - 1)
    return np.unique(shard.features[seen % max(1, words)].reshape(-1), return_counts=True)


def first_largest(response: np.ndarray, ends: np.ndarray, w: int) -> np.ndarray:
    """First place of each filter's largest response in each text, whose last w - 1 places are no windows."""
    inside = np.diff(ends) - w + 1
    pairs = np.stack([ends[:-1], ends[1:] - w + 1], axis=1).reshape(-1)
    top = np.maximum.reduceat(response, pairs[:-1], axis=0)[::2]
    top = np.stack([top, np.full_like(top, np.inf)], axis=1).reshape(-1, top.shape[1])
    size = np.stack([inside, np.full(len(inside), w - 1)], axis=1).reshape(-1)
    size[-1] = 0
    column, place = np.nonzero((response == np.repeat(top, size, axis=0)).T)
    text = np.searchsorted(ends, place, side="right") - 1
    _, first = np.unique(column * np.int64(len(inside)) + text, return_index=True)
    return place[first].reshape(top.shape[1], len(inside)).T


def epoch(state: Trained, shard: Shard, learn: np.ndarray, balance: tuple[float, float], number: int) -> np.ndarray:
    """Take `state` through the rows `learn` of a shard, classes weighted by `balance`; the places of changed vectors."""
    net = state.network
    codes, at, labels = shard.codes, shard.at, shard.y
    buckets = net.buckets
    place = np.full(BUCKETS, len(buckets), np.int32)
    place[buckets[buckets >= 0]] = np.flatnonzero(buckets >= 0)
    rows = np.concatenate([np.full((1, shard.features.shape[1]), len(buckets), np.int32), place[shard.features]])  # padding first
    changed = np.zeros(len(buckets), bool)
    present, nth = np.zeros(len(rows), bool), np.zeros(len(rows), np.intp)  # of each word in a batch

    def step(name, param, grad):
        state.past[name] += grad * grad
        param -= RATE * grad / np.sqrt(state.past[name])

    order = [learn[state.rng.permutation(len(learn))] for _ in range(number + 1)][-1]
    for lo in range(0, len(order), BATCH):
        pick = np.sort(order[lo:lo + BATCH])
        parts = [codes[at[i]:at[i + 1]] for i in pick]
        ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        flat = np.concatenate(parts)
        present[0] = True
        present[flat] = True
        own = np.flatnonzero(present)
        present[own] = False
        nth[own] = np.arange(len(own))
        local = nth.take(flat)
        vec = net.embedding.take(rows.take(own, axis=0), axis=0).sum(axis=1)
        pooled, argmax = [], []
        for w in WIDTHS:
            n = len(local) - w + 1
            response = sum((vec @ net.filters[w][j]).take(local[j:j + n], axis=0) for j in range(w))
            best = first_largest(response, ends, w)
            argmax.append(best)
            pooled.append(np.take_along_axis(response, best, axis=0) + net.bias[w])
        hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
        z = hidden @ net.out + net.out_bias
        weight = np.where(labels[pick] == 1, balance[1], balance[0])
        error = ((1 / (1 + np.exp(-z)) - labels[pick]) * weight / len(pick)).astype(np.float32)
        back = error[:, None] * net.out * (hidden > 0)
        grad_e = np.zeros((len(own), DIM), np.float32)
        for k, w in enumerate(WIDTHS):
            g = back[:, k * FILTERS:(k + 1) * FILTERS]
            grad_w = np.empty_like(net.filters[w])
            for j in range(w):
                c = local[argmax[k] + j]
                grad_w[j] = np.einsum("bfd,bf->df", vec[c], g)
                np.add.at(grad_e, c.reshape(-1), (g[:, :, None] * net.filters[w][j].T[None]).reshape(-1, DIM))
            step(f"w{w}", net.filters[w], grad_w + DECAY * net.filters[w])
            step(f"b{w}", net.bias[w], g.sum(axis=0))
        hot = np.flatnonzero(grad_e.any(axis=1))
        touched, to = np.unique(rows[own[hot]], return_inverse=True)
        grad_rows = np.zeros((len(touched), DIM), np.float32)
        np.add.at(grad_rows, to.reshape(-1), np.repeat(grad_e[hot], rows.shape[1], axis=0))
        real = touched < len(buckets)
        touched, grad_rows = touched[real], grad_rows[real] + DECAY * net.embedding[touched[real]]
        state.past_rows[touched] += grad_rows * grad_rows
        net.embedding[touched] -= RATE * grad_rows / np.sqrt(state.past_rows[touched])
        changed[touched] = True
        step("o", net.out, hidden.T @ error + DECAY * net.out)
        net.out_bias -= RATE * float(error.sum())
    return np.flatnonzero(changed)


VECTOR = np.dtype([("at", np.int32), ("past", np.float32, DIM), ("vector", np.float32, DIM)])


def _epoch_of_shards(state: Broadcast, balance: tuple[float, float], tuned: bool, number: int):
    """Blocks of changed word vectors, and block -1 with all other parameters, of each shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                shard, own = Shard.of(r), copy.deepcopy(state.value)
                learn = np.flatnonzero(~shard.tune) if tuned else np.arange(len(shard.y))
                if not len(learn):
                    continue
                places = epoch(own, shard, learn, balance, number)
                out = np.zeros(len(places), VECTOR)
                out["at"], out["past"], out["vector"] = places, own.past_rows[places], own.network.embedding[places]
                cuts = np.flatnonzero(np.diff(places // BLOCK)) + 1
                pieces = [x for x in np.split(out, cuts) if len(x)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([-1, *(int(x["at"][0]) // BLOCK for x in pieces)], pa.int64()),
                     pa.array([r["shard"]] * (1 + len(pieces)), pa.int64()),
                     pa.array([own.dense().tobytes(), *(x.tobytes() for x in pieces)], pa.binary())], ["block", "shard", "data"])
    return run


def _averaged(block: pa.Table) -> pa.Table:
    """The mean of one block over the shards that returned it."""
    block = block.sort_by("shard")  # one order of summing
    number, data = block["block"][0].as_py(), block["data"].to_pylist()
    if number < 0:
        mean = np.mean([np.frombuffer(d, np.float64) for d in data], axis=0)
    else:
        rows = np.concatenate([np.frombuffer(d, VECTOR) for d in data])
        places, to = np.unique(rows["at"], return_inverse=True)
        n = np.bincount(to)
        mean = np.zeros(len(places), VECTOR)
        mean["at"] = places
        for column in ("past", "vector"):
            for j in range(DIM):
                mean[column][:, j] = np.bincount(to, rows[column][:, j]) / n
    return pa.table({"block": pa.array([number], pa.int64()), "data": pa.array([mean.tobytes()], pa.binary())})


def train(shards: DataFrame, buckets: np.ndarray, balance: tuple[float, float], tuned: bool) -> Network:
    """Fit the network by Adagrad on log loss over all shards, EPOCHS times."""
    spark, state = shards.sparkSession, untrained(buckets)
    path, blocks = work_path(spark, "network"), -(-len(state.network.buckets) // BLOCK)
    for number in range(EPOCHS):
        sent = spark.sparkContext.broadcast(state)
        with small_batches(spark, 1), shuffles_dropped(spark):
            shards.mapInArrow(_epoch_of_shards(sent, balance, tuned, number), "block long, shard long, data binary") \
                .groupBy("block").applyInArrow(_averaged, "block long, data binary").write.mode("overwrite").parquet(path)
        sent.destroy(blocking=True)
        means = spark.read.schema("block long, data binary").parquet(path)
        for lo in range(-1, blocks, BLOCKS_A_READ):  # the driver holds a few blocks besides the network
            for r in means.filter(F.col("block").between(lo, lo + BLOCKS_A_READ - 1)).collect():
                if r.block < 0:
                    state.load_dense(np.frombuffer(r.data, np.float64))
                else:
                    mean = np.frombuffer(r.data, VECTOR)
                    state.past_rows[mean["at"]] = mean["past"]
                    state.network.embedding[mean["at"]] = mean["vector"]
    return state.network


def threshold(low: np.ndarray, high: np.ndarray, negative: np.ndarray, positive: np.ndarray) -> float:
    """Logit between neighbours that has the best F1, from the weights of both labels in steps from `low` to `high`."""
    order = np.argsort(-low, kind="stable")
    low, high = low[order], high[order]
    hit, wrong = np.cumsum(positive[order]), np.cumsum(negative[order])
    i = int((2 * hit / (hit + wrong + positive.sum())).argmax())
    return float((low[i] + high[i + 1]) / 2) if i + 1 < len(low) else float(low[i] - 1)


@dataclass
class ToxicityModel:
    network: Network | None
    constant: float
    thresholds: dict[str, float]
    default: float
    languages: langid.LanguageModel

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.constant)
        lang, _ = langid.parser(self.languages).predict(pc.fill_null(texts, "").to_pylist())
        shift = np.array([self.thresholds.get(x, self.default) for x in lang])
        return 1 / (1 + np.exp(-np.clip(self.network.logits(texts) - shift, -500, 500)))


def _code_shard(languages: langid.LanguageModel):
    """One row for a shard: its distinct (doc_id, text) rows, in the order of their hashes, coded."""
    def run(rows: pa.Table) -> pa.Table:
        number = rows["shard"][0].as_py()
        found = sorted({(r["h"], r["doc_id"], r["text"] or "", r["y"]) for r in rows.to_pylist()})
        texts, y = [r[2] for r in found], np.array([r[3] for r in found], np.int8)
        # one row in five only calibrates, by its rank within its class
        tune = np.zeros(len(y), np.bool_)
        for c in (0, 1):
            tune[y == c] = (np.arange((y == c).sum()) + number) % 5 == 4
        words = text_words(pa.array(texts, pa.string()))
        codes, at = padded(words)
        cross, langs, asked = langid.parser(languages), [""] * len(y), np.flatnonzero(tune)
        for b in slices([pa.RecordBatch.from_arrays([pa.array(asked), pa.array([texts[i] for i in asked], pa.string())], ["row", "text"])]):
            for i, lang in zip(b["row"].to_pylist(), cross.predict(b["text"].to_pylist())[0]):
                langs[i] = lang
        return pa.table({
            "shard": pa.array([number], pa.int64()), "codes": pa.array([codes.tobytes()], pa.binary()),
            "at": pa.array([at.astype(np.int64).tobytes()], pa.binary()),
            "features": pa.array([word_features(words.vocab).astype(np.int32).tobytes()], pa.binary()),
            "y": pa.array([y.tobytes()], pa.binary()), "tune": pa.array([tune.tobytes()], pa.binary()),
            "langs": pa.array([langs], pa.list_(pa.string()))})
    return run


def _shard_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each label that teach and calibrate."""
    for b in batches:
        for r in b.to_pylist():
            s = Shard.of(r)
            yield pa.RecordBatch.from_arrays([pa.array([int(((s.y == y) & (s.tune == t)).sum())]) for t in (False, True) for y in (0, 1)],
                                             ["learn_0", "learn_1", "tune_0", "tune_1"])


def _bucket_counts(tuned: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                s = Shard.of(r)
                buckets, n = learned_buckets(s, np.flatnonzero(~s.tune) if tuned else np.arange(len(s.y)))
                yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(n, pa.int64())], ["bucket", "n"])
    return run


def _calibrating(network: Network, tuned: bool):
    """Language, step of the logit, logit and label of the rows that calibrate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                s = Shard.of(r)
                rows = np.flatnonzero(s.tune) if tuned else np.arange(len(s.y))
                if len(rows):
                    z = (network.pooled(network.vectors(s.features), *s.picked(rows)) @ network.out + network.out_bias).astype(np.float64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s.langs[i] for i in rows], pa.string()), pa.array(np.floor(z * STEPS).astype(np.int64)),
                         pa.array(z), pa.array(s.y[rows].astype(np.int32))], ["lang", "step", "z", "y"])
    return run


def _shards(docs: DataFrame, teach: DataFrame, languages: langid.LanguageModel) -> DataFrame:
    """All texts with a label, dealt into shards by a hash of the id, coded and written down."""
    teach = bounded_broadcast(teach)
    chars = docs.select("doc_id", F.length("text").cast("long").alias("n")).join(teach, "doc_id").agg(F.sum("n")).first()[0] or 0
    rows = docs.select("doc_id", "text").join(teach, "doc_id").withColumn("h", F.xxhash64("doc_id"))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(-(-chars // SHARD_CHARS) or 1)))
    with shuffles_dropped(docs.sparkSession):
        return staged(rows.groupBy("shard").applyInArrow(_code_shard(languages), SHARD), "shards", rows_a_file=1)


def fit(docs: DataFrame, labels: DataFrame, held_out: Column) -> ToxicityModel:
    """Learn from all labelled rows that aren't held out."""
    spark = docs.sparkSession
    importable(spark)
    teach = labels.filter(F.col("doc_id").isNotNull() & ~held_out & F.col("toxic").isin(0, 1)) \
        .groupBy("doc_id").agg(F.max("toxic").alias("y"))
    languages = langid.fit(docs, ~held_out)
    shards = _shards(docs, teach, languages)
    with small_batches(spark, 1):
        n = shards.mapInArrow(_shard_counts, "learn_0 long, learn_1 long, tune_0 long, tune_1 long") \
            .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("learn_0", "learn_1", "tune_0", "tune_1")]).first()
        total = (n.learn_0 + n.tune_0, n.learn_1 + n.tune_1)
        if min(total) == 0:
            return ToxicityModel(None, float(total[1] > 0), {}, 0.0, languages)
        # rows that only calibrate, if there are enough
        tuned = min(total) >= 10 and min(n) > 0
        learned = staged(shards.mapInArrow(_bucket_counts(tuned), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
                         .filter(F.col("n") >= MIN_DOCS).select("bucket"), "buckets")
    buckets = learned.toArrow()["bucket"].to_numpy()  # in batches of the usual size
    taught = (n.learn_0, n.learn_1) if tuned else total
    network = train(shards, np.sort(buckets).astype(np.int32), tuple(0.5 / x * sum(taught) for x in taught), tuned)
    tune = (n.tune_0, n.tune_1) if tuned else total
    with small_batches(spark, 1):
        steps = shards.mapInArrow(_calibrating(network, tuned), "lang string, step long, z double, y int") \
            .groupBy("lang", "step").agg(F.min("z").alias("low"), F.max("z").alias("high"),
                                         F.sum(1 - F.col("y")).alias("negative"), F.sum("y").alias("positive")).toArrow()
    lang = np.array(steps["lang"].to_pylist(), object)
    columns = [steps[c].to_numpy() for c in ("step", "low", "high", "negative", "positive")]

    def best(rows: np.ndarray) -> float:
        """Threshold over some rows of `steps`, label counts in the proportion of all rows."""
        step, low, high, negative, positive = (c[rows] for c in columns)
        order = np.argsort(step, kind="stable")
        starts = np.flatnonzero(np.diff(step[order], prepend=step[order[0]] - 1))
        return threshold(np.minimum.reduceat(low[order], starts), np.maximum.reduceat(high[order], starts),
                         np.add.reduceat(negative[order], starts) * total[0] / tune[0],
                         np.add.reduceat(positive[order], starts) * total[1] / tune[1])
    by_language = {}
    for one in sorted(set(lang)) if tuned else []:
        rows = lang == one
        if min(columns[3][rows].sum(), columns[4][rows].sum()) >= 10:
            by_language[one] = best(rows)
    return ToxicityModel(network, 0.0, by_language, best(np.ones(len(lang), bool)), languages)


def _score(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, cap=4 << 20):
            score = model.scores(b["text"])
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["held_out"], pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])
    return run


def score_documents(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = fit(docs, labels, held_out)
    return docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text") \
        .mapInArrow(_score(model), "doc_id long, held_out boolean, score double, predicted int")
