"""The corpus pipeline, stage by stage and whole, against brute force on a small fixture."""

import random

from brute import contains, line_templates, near_duplicates

import corpus_pipeline
from dockstat.llm.tokens import default_tokenizer

WORDS = [a + b for a in "bcdfgklmnprst" for b in ("al", "en", "ist", "or", "ump", "a", "ey")]


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def fixture():
    rnd = random.Random(12)
    items = [(i, prose(rnd, 20 + i)) for i in range(6)] + [(6, None)]
    texts = [prose(rnd, rnd.randrange(20, 120)) + "\n" + prose(rnd, 30) for _ in range(40)]
    texts += [prose(rnd, 30) + "\nThis notice stands under every page here\n" + prose(rnd, 25) for _ in range(14)]
    texts += ["This notice stands under every page here"] * 2                     # all of it goes
    texts += [texts[3], texts[3], texts[4].replace(texts[4].split()[5], "zzz", 1)]  # copies, a near copy
    texts += [prose(rnd, 20) + " " + items[i][1] + " " + prose(rnd, 9) for i in range(4)]
    texts += [None, "", "123 ?!", "\n\n", prose(rnd, 9000)]
    return list(enumerate(texts)), items


def test_run_equals_brute_force(spark, tmp):
    docs, items = fixture()
    rows = [(i, t, "en", f"s{i % 3}", len(t) if t is not None else None) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(3).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")

    left = [(d, t) for d, t in docs if any(c.isalpha() for c in t or "")]
    gone = line_templates(left, units={r[0]: r[2] for r in near_duplicates(left)})
    lined = []
    for d, t in left:
        lines = [x for i, x in enumerate(t.split("\n")) if not gone.get((d, i), (0, False))[1]]
        if any(x.strip() for x in lines):
            lined.append((d, "\n".join(lines)))
    once = {r[0] for r in near_duplicates(lined) if r[3]}
    losers = {r[0] for r in near_duplicates(left) if not r[3]}
    assert losers and not losers & once                      # line dedup leaves no stubs of copies behind
    single = [(d, t) for d, t in lined if d in once]
    clean = [(d, t) for d, t in single if not any(t2 and contains(t, t2) for _, t2 in items)]
    assert len(left) > len(lined) > len(single) > len(clean)

    out = spark.read.parquet(f"{tmp}/documents.parquet")
    columns = out.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES, [left, lined, single, clean]):
        out = stage(spark, out, tmp)
        assert out.columns == columns
        out.write.parquet(f"{tmp}/{name}")
        out = spark.read.parquet(f"{tmp}/{name}")
        assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect()) == [(d, t, len(t)) for d, t in want], name

    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(default_tokenizer())
    size = {d: len(tok.encode(t, add_special_tokens=False).ids) + 1 for d, t in clean}
    pieces = corpus_pipeline.run(spark, tmp).collect()
    total, places = {}, {}
    for p in pieces:
        total[p.doc_id] = total.get(p.doc_id, 0) + p.length
        places.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert total == size
    for parts in places.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096


def test_empty_tables(spark, tmp):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    assert corpus_pipeline.run(spark, tmp).count() == 0
