"""MinHash near-dedup, line templates and chunk dedup against brute force."""

import random

import numpy as np
from brute import line_templates, near_duplicates
from oracle_compare import compare
from pyspark.sql import functions as F

from dockstat.llm import chunkdedup, graph, linededup, minhash
from dockstat.llm.common import hash_words
from dockstat.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def text_of(rnd, n):
    return " ".join(rnd.choice(VOCAB) for _ in range(n))


VOCAB = [a + b for a in "bcdfghklmnprst" for b in ("a", "e", "ion", "ou", "er", "ant", "ish")]


def edited(rnd, text, n):
    w = text.split()
    for _ in range(n):
        w[rnd.randrange(len(w))] = rnd.choice(VOCAB) + "x"
    return " ".join(w)


def test_query_equals_sql(spark):
    assert compare(spark, SF, ["op1_minhash_near_dedup"])["op1_minhash_near_dedup"].startswith("ok")


def test_sketch_fills_every_bin_and_estimates_similarity():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 1 << 62, 400).astype(np.uint64)
    sets = [base[:1], base[:5], base[:300], base[100:400], np.empty(0, np.uint64)]
    s = minhash.similarity_sketches(sets, 336)
    assert (s[:4] != minhash.EMPTY).all() and (s[4] == minhash.EMPTY).all()
    assert abs((s[2] == s[3]).mean() - 0.5) < 0.1
    assert (minhash.similarity_sketches([sets[2][::-1]], 336)[0] == s[2]).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (200, 201), (201, 200), (5, 5), (300, 301), (301, 302)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(1, 41)) and got[100] == 0 and got[201] == 200 and got[302] == 300


def test_hot_groups_chains_and_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(minhash, "MEMBER_BLOCK", 4000)
    monkeypatch.setattr(minhash, "OUTSIDE_BLOCK", 1500)
    rnd = random.Random(5)
    base = text_of(rnd, 90)
    rows = [(i, edited(rnd, base, rnd.randrange(0, 6))) for i in range(0, 160, 2)]    # near copies, many unlinked
    rows += [(1001 + i, base) for i in range(60)]                                     # exact copies
    chain = text_of(rnd, 120)
    for i in range(12):                                                               # each linked to the next
        rows.append((2000 - i, chain))
        chain = " ".join([*chain.split()[6:], *text_of(rnd, 6).split()])
    rows += [(3000, None), (3001, ""), (3002, " \n\t "), (3003, "one two"), (3004, "ONE  two"), (3005, "one"),
             (3006, text_of(rnd, 20_000)), (None, base), (None, "alone here now"), (3003, "one two")]
    rows += [(3001, text_of(rnd, 9))]
    want = near_duplicates(rows)
    docs = spark.createDataFrame([(t, d, 1, "k") for d, t in rows], "text string, doc_id long, n_shingles int, key string")
    got = minhash.near_duplicates(docs).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str)
    assert [r for r in got if r[0] is not None] == [r for r in want if r[0] is not None]
    assert (None, 0, None, False) not in got and len(got) == len(rows)
    kept = minhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == sorted({r[0] for r in want if r[3] and r[0] is not None})
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def line_rows():
    rnd = random.Random(9)
    rows = [(i, text_of(rnd, 12) + f"\nUser {i} has logged in again from the host {rnd.choice(VOCAB)} at about {i}:0{i}\n" + text_of(rnd, 8)
             + ("\nAll rights reserved." if i % 2 else "")) for i in range(60)]
    rows += [(100 + i, "Same leading words " + text_of(rnd, 9)) for i in range(30)]       # one leaf, no template
    rows += [(200 + i, "short x\nshort x") for i in range(15)]
    rows += [(300, None), (301, ""), (302, "\n\n"), (303, text_of(rnd, 20_000))]
    return rows


def test_line_templates_equal_brute_force(spark):
    rows = line_rows()
    docs = spark.createDataFrame([(t, d, 3, 4) for d, t in rows], "text string, doc_id long, leaf int, n_docs int").repartition(4)
    got = linededup.recurring_lines(docs).collect()
    want = line_templates(rows)
    assert {(r.doc_id, r.line_no): (r.n_docs, r.dropped) for r in got} == want and want
    out = {r.doc_id: r.text for r in linededup.drop_recurring_lines(docs).collect()}
    for d, t in rows:
        left = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if not want.get((d, i), (0, False))[1])
        assert out[d] == left
    assert "User" not in out[30] and "User" in out[0]
    assert linededup.recurring_lines(docs.limit(0)).count() == 0
    assert linededup.drop_recurring_lines(docs.limit(0)).count() == 0


def test_line_documents_that_lose_all_go_and_others_stay(spark):
    rows = [(i, "the very same line\nand one more line here") for i in range(12)] + [(None, "the very same line")] * 2 + [(0, "the very same line")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(linededup.drop_recurring_lines(docs).collect(), key=str) == sorted(
        [r for r in docs.collect() if r.doc_id in (0, None)], key=str)


def test_line_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op2_template_line_dedup"](spark, SF).collect()
    assert {(r.doc_id, r.line_no): (r.n_docs, r.dropped) for r in got} == line_templates(rows)


def test_chunks_resist_shifts():
    words = hash_words(text_of(random.Random(2), 400).split())
    ends = chunkdedup.cuts(words)
    own = set(chunkdedup.chunk_digests(words, ends).tolist())
    moved = np.concatenate([words[:7], hash_words(["new"]), words[7:]])
    shifted = chunkdedup.chunk_digests(moved, chunkdedup.cuts(moved)).tolist()
    assert sum(d not in own for d in shifted) <= 3
    assert len(chunkdedup.cuts(hash_words(["a"] * 500))) <= 2                        # no cut within the stretch


def test_repeated_passages(spark):
    rnd = random.Random(4)
    passage = text_of(rnd, 70)
    rows = [(i, text_of(rnd, 50 + i) + " " + passage + " " + text_of(rnd, 60)) for i in range(40)]
    rows += [(100 + i, text_of(rnd, 150)) for i in range(40)]
    rows += [(200, None), (201, ""), (202, "a b"), (203, rows[50][1]), (None, passage), (203, rows[50][1]), (204, "x " * 300), (205, "x " * 300), (206, "x " * 280)]
    docs = spark.createDataFrame([(t, d, 1) for d, t in rows], "text string, doc_id long, digest int").repartition(3)
    got = chunkdedup.repeated_passages(docs).collect()
    texts = {}
    for d, t in rows:
        texts.setdefault(d, (t or "").split())
    assert {r.doc_id for r in got} == {*range(40), None, 203, rows[50][0], 204, 205}
    for r in got:  # what is reported stands elsewhere, word for word
        part = " ".join(texts[r.doc_id][r.start_word:r.start_word + r.n_words])
        assert sum((" " + " ".join((t or "").split()) + " ").count(" " + part + " ") for _, t in rows) > 1
        assert r.n_words >= chunkdedup.MIN_WORDS
    assert {r.doc_id for r in got if r.original and r.doc_id is not None and r.doc_id < 40} == {0}
    assert sum(r.n_words for r in got if r.doc_id == 5) >= 50
    assert chunkdedup.repeated_passages(docs.limit(0)).count() == 0


def test_chunk_query_finds_long_repeats_and_nothing_else(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.lower("text").alias("text")).collect()
    grams = {}
    for r in docs:
        w = r.text.split()
        for i in range(len(w) - 24):
            grams.setdefault(" ".join(w[i:i + 25]), set()).add((r.doc_id, i))
    short = {d for v in grams.values() if len(v) > 1 for d, _ in v}
    flagged = {r.doc_id for r in QUERIES["op8_chunk_substring_dedup"](spark, SF).collect()}
    assert flagged <= short
    runs = {}
    for g, v in grams.items():
        if len({d for d, _ in v}) > 1:  # across documents
            for d, i in v:
                runs.setdefault(d, set()).add(i)
    long = {d for d, at in runs.items() if any(all(i + j in at for j in range(31)) for i in at)}  # 55 words on end
    assert len(long - flagged) <= 0.02 * len(long)


def test_pieces_of_different_documents_are_not_joined(spark):
    rnd = random.Random(31)
    parts = [text_of(rnd, 60) for _ in range(6)]
    rows = [(i, text_of(rnd, 20) + " " + p + " " + text_of(rnd, 20)) for i, p in enumerate(parts)]
    rows.append((50, " ".join(parts)))                                      # every piece stands elsewhere, no two together
    small = [text_of(rnd, 17) for _ in range(6)]
    rows += [(60 + i, text_of(rnd, 30) + " " + p + " " + text_of(rnd, 30)) for i, p in enumerate(small)]
    rows.append((70, " ".join(small)))                                      # pieces that are too short each
    got = chunkdedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = {d: t.split() for d, t in rows}
    for r in got:
        part = " " + " ".join(texts[r.doc_id][r.start_word:r.start_word + r.n_words]) + " "
        assert sum((" " + t + " ").count(part) for _, t in rows) > 1
    assert sum(r.doc_id == 50 for r in got) == 6 and {r.doc_id for r in got} == {*range(6), 50}


def plain_passages(rows, least):
    """Repeated passages by definition: along the least or the greatest other place of each window of chunks."""
    spots = {}
    whole = []
    for n, (d, t) in enumerate(rows):
        w = [x.decode() for x in (t or "").encode().lower().split()]
        if not w:
            continue
        ends = [0, *chunkdedup.cuts(hash_words(w)).tolist()]
        k = min(chunkdedup.WINDOW, len(ends) - 1)
        windows = [tuple(w[ends[i]:ends[i + k]]) for i in range(len(ends) - k)]
        whole.append((n, d, ends, k, windows))
        for i, x in enumerate(windows):
            spots.setdefault(x, []).append((n, d, i))
    out = set()
    for n, d, ends, k, windows in whole:
        for lo in range(len(windows)):
            for hi in range(lo + 1, len(windows) + 1):
                if ends[hi - 1 + k] - ends[lo] < least:
                    continue
                # another place that holds all of the windows, one after another
                if any((m, i) != (n, lo) and all((m, e, i + j) in spots[windows[lo + j]] for j in range(hi - lo))
                       for m, e, i in spots[windows[lo]]):
                    out.add((d, ends[lo], ends[hi - 1 + k] - ends[lo]))
    return out


def test_chunk_rows_equal_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {(r.doc_id, r.start_word, r.n_words) for r in QUERIES["op8_chunk_substring_dedup"](spark, SF).collect()}
    want = plain_passages(rows, chunkdedup.MIN_WORDS)
    assert got <= want                                                       # each stands elsewhere as a whole
    longest = {p for p in want if not any(q != p and q[0] == p[0] and q[1] <= p[1] and q[1] + q[2] >= p[1] + p[2] for q in want)}
    covered = {(d, w) for d, s, n in got for w in range(s, s + n)}
    missed = sum((d, w) not in covered for d, s, n in longest for w in range(s, s + n))
    assert missed <= 0.02 * sum(n for _, _, n in longest)
