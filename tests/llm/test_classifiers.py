"""Language ID, toxicity, decontamination, nearest neighbours: brute force and held-out accuracy."""

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import contains, phrases, plain_words, weighted_similarity
from pyspark.sql import functions as F

from dockstat.llm import ann, decontam, langid, toxicity
from dockstat.llm.queries import QUERIES

SF, SF10 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# ---- language ID --------------------------------------------------------------

def test_parse_equals_plain_search():
    rnd = random.Random(3)
    letters = "abcdé"
    refs = ["".join(rnd.choice("abc  ") for _ in range(300)), "".join(rnd.choice("cdé ") for _ in range(200))]
    syms = [langid.symbols([r], letters)[0].tobytes() for r in refs]
    model = langid.LanguageModel(letters, ("x", "y"), tuple(syms))
    texts = ["", "a", "abc cba", "zzz", "  a  1 b", "É d", "日本", "".join(rnd.choice("abcdé z") for _ in range(5000))]
    bits, has = langid.parser(model).bits(texts)
    for i, t in enumerate(texts):
        sym = langid.symbols([t], letters)[0].tobytes()
        assert has[i] == any(c.isalpha() for c in t)
        for k, r in enumerate(syms):
            n = sum(phrases(sym[s:s + langid.BLOCK], r) for s in range(0, len(sym), langid.BLOCK))
            assert bits[i, k] == pytest.approx(n * np.log2(len(r)) / max(1, len(sym)))


def test_language_query_held_out(spark):
    got = QUERIES["op6_cross_parsing_language"](spark, SF10)
    docs = spark.read.parquet(f"{SF10}/documents.parquet")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark):
    rows = [(i, ("the cat sat on the mat " if i % 2 else "der hund und die katze ") * 5, "en" if i % 2 else "de", 1.0) for i in range(40)]
    rows += [(100, None, "en", 1.0), (101, "", None, 1.0), (102, "123 !?", "de", 1.0), (103, "日本語", None, 1.0),
             (None, "the cat", "en", 1.0), (104, "und die katze " * 30_000, None, 1.0), (104, "the mat", "fr", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    fold = langid.split_rest("doc_id", 4) == 2
    got = langid.identify(docs, fold).collect()
    by = {(r.doc_id, r.lang_pred) for r in got}
    assert len(got) == len(rows) and {(100, "und"), (101, "und"), (102, "und"), (104, "de")} <= by
    assert all(r.lang_pred != "und" for r in got if r.doc_id in (103, None))
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    kept = langid.keep_identified(docs, fold)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {*range(40), 103, 104, None}
    assert langid.identify(docs.limit(0), fold).count() == 0
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string")), fold).collect()} == {"und"}


def test_language_stage_rejects_what_no_language_explains(spark):
    rnd = random.Random(14)
    base = {"en": "the cat sat on the mat and the dog ran over the hill to see what the old man had found there ",
            "de": "der hund und die katze liefen über den berg um zu sehen was der alte mann dort gefunden hatte "}
    rows = []
    for i in range(700):
        lang = ("en", "de")[i % 2]
        words = base[lang].split()
        rows.append((i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(3, 200))), lang))
    letters = "abcdefghijklmnopqrstuvwxyzäöüß"
    junk = [(1000 + i, "".join(rnd.choice(letters) for _ in range(400)), None) for i in range(30)]
    docs = spark.createDataFrame(rows + junk + [(2000, "x", None), (2001, "1 2", None)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in langid.keep_identified(docs, langid.split_rest("doc_id", 4) == 2).collect()}
    assert kept == {*range(700), 2000}


def test_language_level_is_calibrated_on_every_labelled_row(spark):
    """One long labelled text of letters that no other has moves the level, wherever its id hashes to."""
    rnd = random.Random(15)
    words = "the cat sat on the mat and the dog ran over the hill to see what the old man had found there".split()
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(3, 60))), "en") for i in range(700)]
    odd = [(i, "".join(rnd.choice("bcdfghjklmnpqrstvwxyz") for _ in range(25_000)), "en") for i in (900, 901, 902)]
    fold = langid.split_rest("doc_id", 4) == 2
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("held", fold)
    labelled = docs.filter("not held")
    taught = {r.doc_id for r in langid.hash_sample(labelled.select("doc_id", "lang"), "lang", {"en": langid.REFERENCE_ROWS}).collect()}
    texts = [r.text for r in labelled.collect() if r.doc_id not in taught]
    assert any(len(t) == 25_000 for t in texts)
    model = langid.fit(docs, ~fold)
    cross = langid.parser(model)
    bits, has, size = cross.measure(texts)
    assert langid.level(docs, ~fold, model) == pytest.approx(
        langid.MARGIN * (bits.min(axis=1) - langid.SLACK * cross.weight.max() / np.maximum(size, 1))[has].max())


# ---- toxicity -------------------------------------------------------------------

def toxic_rows(n):
    rnd = random.Random(8)
    fine = [a + b for a in "bcdfglmnprst" for b in ("ana", "ero", "ilu", "om", "ust")]
    bad = ["grumsty", "vilefang", "snorbag", "grumly"]
    rows = []
    for i in range(n):
        words = [rnd.choice(fine) for _ in range(rnd.randrange(5, 80))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        rows.append((i, " ".join(words), "en", int(toxic)))
    return rows


def test_toxicity_held_out(spark):
    rows = toxic_rows(600)
    docs = spark.createDataFrame([r[:3] for r in rows] + [(900, None, "en"), (901, "", None), (None, "grumsty snorbag vilefang", "en"),
                                                          (902, "bana " * 60_000 + "grumsty vilefang snorbag grumly", "en")],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], 1, r[3]) for r in rows] + [(900, 1, None), (901, 0, 7), (None, 0, 1), (0, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    fold = langid.split_rest("doc_id", 5) == 0
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels, fold).collect()}
    assert len(got) == 604 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [r for r in rows if got[r[0]].held_out]
    assert sum(got[r[0]].predicted == r[3] for r in held) >= 0.95 * len(held)
    assert got[900].predicted == got[901].predicted == 0 and got[902].predicted == 1 and not got[None].held_out
    assert toxicity.score_documents(docs.limit(0), labels, fold).count() == 0
    assert {r.score for r in toxicity.score_documents(docs, labels.limit(0), fold).collect()} == {0.0}


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """1,200 bad words of ten rows each: too many for a sample of a few thousand rows; learned over several shards."""
    monkeypatch.setattr(toxicity, "SHARD_CHARS", 140_000)
    rnd = random.Random(30)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    fine, bad = [word() for _ in range(300)], [word() for _ in range(1200)]
    rows = [(i, " ".join([rnd.choice(fine) for _ in range(5)] + ([bad[i % 1200]] if i < 12_000 else [rnd.choice(fine)])),
             "en", int(i < 12_000)) for i in range(16_000)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    fold = langid.split_rest("doc_id", 5) == 0
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels, fold).collect()}
    held = [r for r in rows if got[r[0]].held_out]
    assert sum(got[r[0]].predicted == r[3] for r in held) >= 0.9 * len(held)


def test_toxicity_query(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op3_cnn_toxicity"](spark, sf)
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in rows if r.held_out and r.toxic is not None]   # ranked by rows that weren't taught
    assert sum(r.predicted == r.toxic for r in held) >= 0.95 * len(held)
    toxic, clean = [[r.score for r in held if r.toxic == y] for y in (1, 0)]
    assert sum((a > b) + (a == b) / 2 for a in toxic for b in clean) >= 0.9 * len(toxic) * len(clean)


# ---- decontamination -------------------------------------------------------------

def test_multi_index_finds_everything_within_the_radius():
    rnd = np.random.default_rng(2)
    items = [(i, " ".join(f"w{x}" for x in rnd.integers(0, 400, 20))) for i in range(50)]
    index = decontam.BenchmarkIndex(items)
    prints, near = index.near[20]
    windows = prints[rnd.integers(0, 50, 300)].copy()
    for w in windows:
        for bit in rnd.choice(64, rnd.integers(0, 30), replace=False):
            w[bit // 8] ^= 1 << (bit % 8)
    met = np.zeros((300, 50), bool)
    for b in range(decontam.BLOCKS):
        met |= near[b][windows[:, b]]
    apart = decontam.BYTE_BITS[windows[:, None] ^ prints[None]].sum(axis=2)
    assert met[apart <= decontam.RADIUS].all() and (apart <= decontam.RADIUS).sum() > 100


def test_a_long_text_of_many_items_is_searched_in_slices(monkeypatch):
    """Every item of a text made of them is found, in bounded memory, as with slices of another size."""
    import tracemalloc
    rnd = random.Random(8)
    words = [f"{a}{b}{c}" for a in "bcdfgh" for b in ("al", "en", "ist") for c in ("or", "ump", "ey")]
    items = [(i, " ".join(rnd.choice(words) for _ in range(30 + i % 3))) for i in range(1500)]
    index = decontam.BenchmarkIndex(items)
    text = pa.array([" and ".join(t for _, t in items[:1000])])
    tracemalloc.start()
    got = dict(decontam._documents(index, 0.8, text))[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {h[0] for h in got if h[4] == 1} == set(range(1000)) and {h[0] for h in got} == set(range(1000))
    assert peak < 300 << 20
    monkeypatch.setattr(decontam, "SPAN", 100)
    monkeypatch.setattr(decontam, "CELLS", 500)
    short = pa.array([" and ".join(t for _, t in items[:60])])
    few = dict(decontam._documents(index, 0.8, short))[0]
    assert sorted(few) == sorted(h for h in got if h[0] < 60)


def test_decontamination_equals_brute_force(spark):
    rnd = random.Random(6)
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("al", "en", "ist", "or", "ump")]
    items = [(i, " ".join(rnd.choice(words) for _ in range(n))) for i, n in enumerate([1, 3, 4, 8, 20, 40, 60, 60])]
    items += [(50, None), (51, ""), (52, "?!"), (None, items[5][1]), (5, items[5][1])]
    docs = [(i, " ".join(rnd.choice(words) + "q" for _ in range(rnd.randrange(0, 90)))) for i in range(40)]
    for i, (k, cut) in enumerate([(4, 0), (5, 0), (5, 2), (5, 9), (6, 3), (6, 30), (7, 0), (3, 0), (1, 0), (2, 0)]):
        part = items[k][1].split()[cut:]
        if i % 3 == 2 and len(part) > 30:
            part[15] = "changed"
        docs.append((100 + i, docs[i][1] + " " + " ".join(part).upper() + ", " + docs[i + 1][1]))
    docs += [(200, None), (201, ""), (202, items[6][1]), (None, items[6][1]), (203, "x " * 20_000 + items[7][1]), (202, items[6][1])]
    d = spark.createDataFrame([(t, i, 0) for i, t in docs], "text string, doc_id long, item_id int").repartition(3)
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    want = sorted(((x, i) for x, t in docs for i, it in items if contains(t, it)), key=str)
    for chars in (decontam.BLOCK_CHARS, 100):
        decontam.benchmark_blocks.__defaults__ = (chars,)
        got = decontam.contaminated(d, b).collect()
        assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == want
        clean = decontam.decontaminate(d, b)
        assert clean.columns == d.columns and sorted(r.doc_id for r in clean.collect()) == \
            sorted(x for x, _ in docs if x not in {w for w, _ in want})
    decontam.benchmark_blocks.__defaults__ = (decontam.BLOCK_CHARS,)
    for r in got:
        text = next(t for x, t in docs if x == r.doc_id)
        if r.item_id is not None:
            w = plain_words(text)[r.start_word:r.start_word + r.n_words]
            assert r.similarity == pytest.approx(weighted_similarity(w, plain_words(dict(items)[r.item_id])))
    assert decontam.contaminated(d.limit(0), b).count() == 0 and decontam.contaminated(d, b.limit(0)).count() == 0


def test_decontamination_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    known = {i.item_id: " ".join(plain_words(i.text)) for i in items}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op5_simhash_decontamination"](spark, SF).collect()}
    for d in docs:
        whole = " ".join(plain_words(d.text))
        for i, t in known.items():
            if f" {t} " in f" {whole} ":
                assert (d.doc_id, i) in got
    by = {d.doc_id: d.text for d in docs}
    texts = {i.item_id: i.text for i in items}
    assert all(contains(by[d], texts[i]) for d, i in got)


# ---- nearest neighbours ---------------------------------------------------------

def brute_nearest(rows, k):
    rows = sorted({(i, tuple(map(float, v))) for i, v in rows if i is not None and v is not None and len(v)
                   and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    out = []
    for q, v in rows:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), i) for i, w in rows
                          if i != q and len(w) == len(v))[:k]
            out += [(q, n + 1, i, pytest.approx(s)) for n, (s, i) in enumerate(near)]
    return out


def test_probe_order_is_by_estimated_success():
    h = ann.Hashing(16, 5, 3.0)
    place = np.random.default_rng(1).normal(size=5) * 4
    cells = h.probes(place, 60)
    low = place - np.floor(place)
    cost = [sum((low[i] if d < 0 else 1 - low[i]) ** 2 if d else 0 for i, d in enumerate(c - np.floor(place))) for c in cells]
    assert cost == sorted(cost) and len({tuple(c) for c in cells}) == 60


def test_nearest_edge_cases(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(0, 130)]
    rows += [(200 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(150)] + [(100, [1.0, 2.0, 3.0, 5.0])] * 2
    rows = [r for r in rows if r[0] != 100 or r[1] == [1.0, 2.0, 3.0, 5.0]]
    rows += [(500, None), (600, []), (700, [0.0] * 4), (800, [1.0, None, 0.0, 0.0]), (900, [float("nan"), 1.0, 1.0, 1.0]),
             (1000, [float("inf"), 1.0, 1.0, 1.0]), (1100, [1.0, 2.0]), (1101, [1.0, 2.5]), (None, [1.0, 1.0, 1.0, 1.0])]
    e = spark.createDataFrame([(v, i, 1) for i, v in rows], "embedding array<double>, vec_id long, rank int").repartition(4)
    asked = F.col("vec_id") % 100 == 0
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest_neighbours(e, asked, 5).collect())
    want = sorted(brute_nearest(rows, 5))
    assert sum(g[2] == w[2] for g, w in zip(got, want)) >= 0.9 * len(want) and [g[:2] for g in got] == [w[:2] for w in want]
    assert [g for g in got if g[0] in (200, 300, 1100)] == [w for w in want if w[0] in (200, 300, 1100)]
    few = e.filter("vec_id in (0, 1, 2)")
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest_neighbours(few, asked, 10).collect()) == \
        sorted(brute_nearest([r for r in rows if r[0] in (0, 1, 2)], 10))
    assert ann.nearest_neighbours(e.limit(0), asked).count() == 0


def test_nearest_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF10}/embeddings.parquet").collect()]
    want = {(q, i) for q, _, i, _ in brute_nearest(rows, 10)}
    got = QUERIES["op4_multiprobe_ann"](spark, SF10).collect()
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want) and len(got) == len(want)


def test_text_words():
    words = toxicity.text_words(pa.array(["A-b ç_d 1", None, "--"]))
    assert [words.vocab[c] for c in words.codes] == ["a", "b", "ç", "d", "1"] and words.bounds.tolist() == [0, 5, 5, 5]
