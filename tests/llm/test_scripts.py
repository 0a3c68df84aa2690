"""Language ID over many scripts: more letters than a dense table has columns."""

import random

import numpy as np
from brute import phrases

from dockstat.llm import langid

SCRIPTS = {"am": 0x1200, "el": 0x3B1, "en": ord("a"), "ja": 0x3042, "ko": 0xAC00, "ru": 0x430, "yi": 0x4E00, "zh": 0x4E00}


def text(rnd, lang, n):
    if lang in ("yi", "zh"):  # the same script and word lengths, other characters
        letters = [chr(0x4E00 + 2 * i + (lang == "zh")) for i in range(400)]
    elif lang in ("ko", "am", "ja"):
        letters = [chr(SCRIPTS[lang] + i) for i in range(70 if lang != "ko" else 300)]
    else:
        letters = [chr(SCRIPTS[lang] + i) for i in range(24)]
    letters = [c for c in letters if c.isalpha() and c == c.lower()]
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randrange(2, 6))) for _ in range(n))


def test_each_script_is_told_apart(spark):
    rnd = random.Random(2)
    rows = [(i * len(SCRIPTS) + j, text(rnd, lang, 120), lang) for i in range(24) for j, lang in enumerate(sorted(SCRIPTS))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    fold = langid.split_rest("doc_id", 4) == 2
    want = {d: lang for d, _, lang in rows}
    got = langid.identify(docs, fold).filter("held_out").collect()
    assert len(got) > 20 and all(r.lang_pred == want[r.doc_id] for r in got)
    model = langid.fit(docs, ~fold)
    assert {c for r in docs.filter(~fold).collect() for c in r.text if c.isalpha()} == set(model.letters)
    for r in model.references:
        assert langid.OTHER not in np.frombuffer(r, langid.symbol_type(model.letters))


def test_listed_and_dense_steps_equal_plain_search():
    rnd = random.Random(6)
    refs = [text(rnd, "en", 80), text(rnd, "ko", 200), text(rnd, "zh", 200)]
    letters = "".join(sorted({c for r in refs for c in r if c.isalpha()}))
    model = langid.LanguageModel(letters, ("en", "ko", "zh"), tuple(langid.symbols([r], letters)[0].tobytes() for r in refs))
    cross = langid.parser(model)
    assert [type(x).__name__ for x in cross.tables] == ["DenseSteps", "ListedSteps", "ListedSteps"]
    texts = [refs[0][5:90] + " " + refs[1][7:300] + text(rnd, "zh", 400), refs[2], text(rnd, "ru", 20) + refs[0][:30], "", "12"]
    bits, has = cross.bits(texts)
    def spelled(t):
        return "".join(map(chr, langid.symbols([t], letters)[0].tolist()))
    for t, row in zip(texts, bits):
        sym = spelled(t)
        for r, weight, b in zip(refs, cross.weight, row):
            n = sum(phrases(sym[s:s + langid.BLOCK], spelled(r)) for s in range(0, len(sym), langid.BLOCK))
            assert np.isclose(b, n * weight / max(1, len(sym)))
    assert has.tolist() == [True, True, True, False, False]


def test_lettered_texts_stay_where_no_row_has_a_language(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12 !", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r.doc_id for r in langid.keep_identified(docs, langid.split_rest("doc_id", 4) == 2).collect()] == [1]
