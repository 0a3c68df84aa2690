"""Token files, packing: against the tokenizer library, an exact round trip and brute force."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from dockstat.llm import packing, tokenstore
from dockstat.llm.queries import QUERIES
from dockstat.llm.tokens import Encoder, default_tokenizer

SF = "/root/testdata/sf0.001"
ODD = ["", None, "   ", "x.", "ab,\ncd. ef.. g.,h! é.\n'll. don't. <|endoftext|>. a.<|startoftext|>b. 1. 2,\n3 ª. µ, ñ; ².",
       "don't STOP's  x　y ÅÉ É é a<|endoftext|>b ΑΣ ΟΔΟΣ İstanbul ß ẞ ﬁ a\tb \x1c\x85 ź", "日本 语 emoji 🎉🎉"]


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_tokenizer())


def truth(tok, texts, end):
    return [tok.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_library_on_odd_texts(tok):
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice("ab É,é.'s \n!?<|>1ß̈ \t日a b. , ") for _ in range(60)) for _ in range(1500)]
    for cache in (1_000_000, 50):
        ids, at = Encoder(default_tokenizer(), cache).encode(pa.array(texts))
        got = [ids[s:e].tolist() for s, e in zip(at[:-1], at[1:])]
        assert got == [x[:-1] for x in truth(tok, texts, 0)]


def test_block_random_access():
    rnd = np.random.default_rng(3)
    for top in (200, 60_000, 1 << 23):
        ids = rnd.integers(0, top, 5000).astype(np.uint32)
        ids[::7] = 3
        b = tokenstore.Block(tokenstore.pack_block([5, None], np.array([0, 10, 5000]), ids))
        assert (b.all() == ids).all() and b.doc_ids == [5, None]
        for i in [0, 511, 512, 513, 4999, *rnd.integers(0, 5000, 200).tolist()]:
            assert b.token(i) == ids[i]
        with pytest.raises(IndexError):
            b.token(5000)


def test_token_files_query(spark, tok):
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    start, want = 0, []
    for r, ids in zip(docs, truth(tok, [r.text for r in docs], 2)):
        want.append((r.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    got = QUERIES["op9_token_files"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


def test_token_files_edge_cases(spark, tok):
    rows = [(i, t, 1) for i, t in enumerate(ODD)] + [(None, "no id", 1), (3, "twice", 1), (3, "twice", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int").repartition(3)
    got = tokenstore.token_store(docs, rows_per_shard=3, block_tokens=4).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted([r[0] for r in rows], key=lambda d: (d is not None, d or 0))
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert {(r.doc_id, r.ids_crc32) for r in got} == \
        {(d, crc(ids)) for (d, _, _), ids in zip(rows, truth(tok, [r[1] for r in rows], 2))}
    assert tokenstore.token_store(docs.limit(0)).count() == 0


def check_packing(rows, texts, tok, capacity):
    want = {}
    for d, ids in zip(texts, truth(tok, list(texts.values()), 1)):
        for p in range(0, len(ids), capacity):
            want[d, p // capacity] = (p, len(ids[p:p + capacity]), crc(ids[p:p + capacity]))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= capacity and sum(3 * n > capacity for _, n in b) <= 2
    total = sum(n for _, n, _ in want.values())
    return len(bins), -(-total // capacity)


def test_packing_query(spark, tok):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op7_best_fit_packing"](spark, SF).collect()
    bins, least = check_packing(rows, texts, tok, 4096)
    assert bins <= least + 1


def test_packing_small_capacity_and_edges(spark, tok):
    texts = dict(enumerate(ODD)) | {100 + i: "the of and " * (i % 9) for i in range(200)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    check_packing(packing.pack_documents(docs, capacity=16).collect(), texts, tok, 16)
    assert packing.pack_documents(docs.limit(0)).count() == 0
    twice = packing.pack_documents(docs.filter("doc_id = 3").union(docs.filter("doc_id = 3"))).collect()
    assert len(twice) == 2 and twice[0].sequence_id == twice[1].sequence_id


def plain_best_fit(lengths, capacity):
    """One item at a time: large ones matched with the longest that fits, small ones best-fit."""
    large, room = sorted((n for n in lengths if 3 * n > capacity), reverse=True), []
    while large:
        n = large.pop(0)
        mate = next((i for i, m in enumerate(large) if n + m <= capacity), None)
        room.append(capacity - n - (large.pop(mate) if mate is not None else 0))
    for n in sorted((n for n in lengths if 3 * n <= capacity), reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(capacity - n)
    return len(room)


def test_plan_equals_item_by_item_packing():
    rnd = random.Random(7)
    for _ in range(30):
        capacity = rnd.choice([12, 50, 101])
        lengths = [rnd.randint(1, rnd.choice([capacity, capacity // 3, capacity // 2])) for _ in range(300)]
        hist = {n: lengths.count(n) for n in set(lengths)}
        plan = packing.packing_plan(hist, capacity)
        used = {}
        for n, c in hist.items():
            runs = plan[plan[:, 0] == n]
            for k in range(c):
                r = runs[np.searchsorted(runs[:, 1], k, side="right") - 1]
                i = k - r[1]
                used.setdefault(r[2] + i // r[3], []).append((r[4] + i % r[3] * n, n))
        for items in used.values():
            at = 0
            for offset, n in sorted(items):
                assert offset == at
                at += n
            assert at <= capacity
        assert len(used) == plain_best_fit(lengths, capacity)


def test_every_letter_before_a_mark(tok):
    import sys
    import unicodedata
    letters = [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c)[0] == "L"]
    enc = Encoder(default_tokenizer())
    for mark in ".,;:!?":
        some = letters if mark == "." else [c for c in letters if ord(c) < 0x3400 or 0xF900 <= ord(c) <= 0x1FFFF]
        texts = [f"{c}{mark} a" for c in some]
        ids, at = enc.encode(pa.array(texts))
        want = [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
        assert ids.tolist() == [i for w in want for i in w] and np.diff(at).tolist() == [len(w) for w in want]
    odd = ["İ.", "क़?! b", "שּׁ,", "ড়; x", "a İ..\n"]
    ids, _ = enc.encode(pa.array(odd))
    assert ids.tolist() == [i for t in odd for i in tok.encode(t, add_special_tokens=False).ids]
