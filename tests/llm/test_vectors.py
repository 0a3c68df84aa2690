"""Whitening and part codes against brute force, and their defined cases."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockstat.llm import partcodes, whitening
from dockstat.llm.queries import QUERIES

SF, SF10 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, n long, code string, v double"


def fixture(n=150, dim=32, seed=4):
    """Clusters, a hot vector that is a third of all rows, equal ids, and rows that must go."""
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, dim)) * 0.2 + rng.integers(-1, 2, (n, 1))).astype(np.float32)
    x[:n // 3] = x[0]
    x[:, 5] = x[:, 4]                                        # no variance of its own
    rows = [(int(i) // 2 * 2 if i < 20 else int(i), x[i].tolist(), [None, 1, 2][i % 3], 7, "z", 1.0) for i in range(n)]
    bad = [(500, None, 1), (501, [], 1), (502, [float("nan")] * dim, 2), (503, [None] + [0.0] * (dim - 1), 2),
           (504, [float("-inf")] + [0.0] * (dim - 1), None)]
    return rows + [(i, v, y, 7, "z", 1.0) for i, v, y in bad], [(r[0], np.array(r[1], np.float64), r[2]) for r in rows]


def plain_codes(rows, parts=16, entries=64, rounds=2):
    rows = sorted(((i, np.floor(256 * v).astype(int).reshape(parts, -1), y) for i, v, y in rows), key=lambda r: (r[0], r[1].tolist()))
    books = [[r[1][p].tolist() for r in rows[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        at = [[nearest(p, r[1][p].tolist())[1] for p in range(parts)] for r in rows]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [r[1][p].tolist() for r, a in zip(rows, at) if a[p] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    out, by_label = [], {}
    for i, x, y in rows:
        best = [nearest(p, x[p].tolist()) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), y))
        by_label[y] = by_label.get(y, 0) + out[-1][2]
    digest = hashlib.sha256(",".join(str(v) for b in books for c in b for v in c).encode()).hexdigest()
    return sorted((i, c, e, by_label[y], digest) for i, c, e, y in out)


def test_codes_equal_brute_force(spark):
    rows, good = fixture()
    got = partcodes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted(tuple(r) for r in got.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()) == plain_codes(good)


def test_codes_defined_cases(spark):
    rows, good = fixture(9)
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(tuple(r) for r in partcodes.compress(df).collect()) == plain_codes(good)  # fewer rows than entries
    empty = partcodes.compress(df.limit(0))
    assert empty.count() == 0 and empty.columns == partcodes.compress(df).columns
    anonymous = partcodes.compress(df.limit(4).withColumn("vec_id", F.lit(None).cast("long")))
    assert [r.vec_id for r in anonymous.collect()] == [None] * 4
    for bad in ([0.0] * 16, [0.0] * 33, [1e30] * 32):
        with pytest.raises(Exception, match="length|equal parts|too large"):
            only = bad if len(bad) == 33 else None
            part = spark.createDataFrame([(1, bad, 1, 1, "", 1.0)], SCHEMA)
            partcodes.compress(part if only or bad[0] else df.unionByName(part)).collect()


def test_grid_cells_leave_no_nearest_entry_out():
    rng = np.random.default_rng(1)
    for width, spread in ((1, 5), (2, 300), (4, 3), (7, 40)):
        book = partcodes.GridCodebook(rng.integers(-spread, spread, (40, width)))
        x = rng.integers(-2 * spread, 2 * spread, (3000, width))
        d = ((x[:, None] - book.entries[None]) ** 2).sum(axis=2)
        code, error = book.nearest(x)
        assert (code == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all()
        again, _ = book.nearest(x[::-1])                      # out of the memo
        assert (again[::-1] == code).all() and book.size[:book.held].mean() < 40


def test_memo_starts_anew_when_full(monkeypatch):
    monkeypatch.setattr(partcodes, "MEMO_CELLS", 50)
    rng = np.random.default_rng(2)
    book = partcodes.GridCodebook(rng.integers(-100, 100, (20, 3)))
    for _ in range(5):
        x = rng.integers(-100, 100, (40, 3))
        assert (book.nearest(x)[0] == ((x[:, None] - book.entries[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert book.held <= 50


# ---- whitening ---------------------------------------------------------------------

def check_whitened(rows, good, components):
    x = np.array([np.floor(64 * v).astype(np.int64) + 1_000_000 for _, v, _ in good])
    n, total = len(x), x.sum(axis=0)
    centred = (n * x - total) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(components, x.shape[1])
    assert len(rows) == n * k
    deviation = sorted((i, int(((n * a.astype(object) - total.astype(object)) ** 2).sum())) for (i, _, _), a in zip(good, x))
    assert sorted((r.vec_id, int(r.deviation)) for r in rows if r.component == 1) == deviation
    got = {}
    for r in rows:
        assert r.n == n
        got.setdefault(r.component, []).append((r.vec_id, r.whitened))
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum() if e[0] > 0 else 0.0, rel=1e-9, abs=1e-12)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    for c in range(1, k + 1):
        varied = e[c - 1] > 1e-9 * max(e[0], 1e-300)
        want = centred @ v[:, c - 1] / np.sqrt(e[c - 1]) if varied else np.zeros(n)
        ids = np.array([i for i, _, _ in good])
        a = np.array([w for _, w in sorted(got[c])])
        both = [np.array([w for _, w in sorted(zip(ids.tolist(), (s * want).tolist()))]) for s in (1, -1)]
        assert min(np.abs(a - b).max() for b in both) < 1e-6, c


def test_whitening_equals_plain_eigenvectors(spark):
    rows, good = fixture()
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(20), components_wanted=32).collect()
    check_whitened(got, good, 32)


def test_whitening_query(spark):
    got = QUERIES["op12_embedding_whitening"](spark, SF10).collect()
    rows = spark.read.parquet(f"{SF10}/embeddings.parquet").collect()
    check_whitened(got, [(r.vec_id, np.array(r.embedding, np.float64), r.label) for r in rows], 32)


def test_whitening_defined_cases(spark):
    rows, good = fixture(9, 6)
    check_whitened(whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect(), good, 32)   # fewer rows than dimensions + more
    for n in (1, 3):                                         # one vector; equal vectors
        same = whitening.whiten(spark.createDataFrame([rows[0]] * n, SCHEMA)).collect()
        assert len(same) == 6 * n and {(r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in same} == {(0.0, 0.0, 0.0, 0)}
    empty = whitening.whiten(spark.createDataFrame(rows, SCHEMA).limit(0))
    assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    big = spark.createDataFrame([(i, [1e9 * (i % 2), 0.5], 1, 1, "", 1.0) for i in range(400)], SCHEMA)
    assert int(whitening.whiten(big).first().deviation) == (400 * 64 * 10 ** 9 // 2) ** 2   # beyond 64 bits


def test_rank_one_updates_keep_the_spectrum():
    rng = np.random.default_rng(3)
    values, vectors, whole = np.zeros(12), np.eye(12), np.zeros((12, 12))
    for i in range(60):
        u = rng.normal(size=12) * 10.0 ** rng.integers(-9, 5)
        if i % 4 == 0:
            u[rng.integers(0, 12, 9)] = 0                    # deflated entries
        if i % 7 == 0:
            u = vectors[:, 3] * 2.0                          # along an eigenvector
        values, vectors = whitening.update(values, vectors, u)
        whole += np.outer(u, u)
        scale = np.abs(whole).max()
        assert np.abs(vectors @ np.diag(values) @ vectors.T - whole).max() < 1e-12 * scale
        assert np.abs(vectors.T @ vectors - np.eye(12)).max() < 1e-12
