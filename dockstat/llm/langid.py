"""Language identification by cross-parsing.

Each language has a reference text, cut from a bounded sample of labelled rows.
Its suffix automaton spells every substring, so walking it from the root until no
transition is left gives the longest match at a position.  A text is parsed into
such longest matches; log2(reference length) bits per phrase over the text's
length estimates its cross-entropy, and the language needing the fewest
normalised phrases wins.  Whole texts are parsed, in blocks of BLOCK symbols that
run side by side as numpy lanes.

Symbols are lower-case letters; everything else is one blank, runs of it collapsed.
Every letter of the sampled texts has its own symbol; all others share one that
matches nowhere.  A language with few letters has a dense table of its automaton's
transitions, one with many a sorted list of them.

Defined cases: a null text, or one without a letter, is `und` with score 0; ties go
to the alphabetically first language; rows without lang teach nothing; with nothing
learned every text is `und`; repeated rows are predicted each; a null doc_id never
teaches and counts as not held out; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockstat.llm.common import hash_sample, importable, ragged, slices

UND = "und"
REFERENCE_SYMBOLS = 30_000  # of each language
REFERENCE_ROWS = 60         # labelled rows they are cut from
SLACK, MARGIN = 3, 1.15     # phrases that a short text may need by chance; above the highest text calibrated on
DENSE_LETTERS = 62          # a language with more has its transitions listed
BLOCK = 1024
BLANK, OTHER, FIRST = 0, 1, 2


def split_rest(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`: the fold a row belongs to."""
    return F.crc32(F.col(doc_id).cast("string")) % parts


@dataclass(frozen=True)
class LanguageModel:
    """Letters with a symbol of their own, and each language's reference text in symbols."""
    letters: str
    languages: tuple[str, ...]
    references: tuple[bytes, ...]  # of symbol_type(letters)


def symbol_type(letters: str) -> type:
    return next(t for t in (np.uint8, np.uint16, np.uint32) if FIRST + len(letters) <= np.iinfo(t).max)


@lru_cache(maxsize=4)
def _symbol_table(letters: str) -> np.ndarray:
    table = np.zeros(0x110000, symbol_type(letters))
    table[[i for i in range(0x110000) if chr(i).isalpha()]] = OTHER
    for i, c in enumerate(letters):
        table[ord(c)] = FIRST + i
    return table


def symbols(texts: list[str], letters: str) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, bounds) of the texts, blanks collapsed within each."""
    lower = [t.lower() for t in texts]
    size = np.fromiter(map(len, lower), np.int64, len(lower))
    sym = _symbol_table(letters)[np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), "<u4")]
    at = np.concatenate([[0], np.cumsum(size)])
    keep = sym != BLANK
    keep[1:] |= sym[:-1] != BLANK
    keep[at[:-1][size > 0]] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    return sym[keep], before[at]


def suffix_automaton(text: Sequence[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of `text`; state 0 is the root."""
    goto: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(goto)
        goto.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in goto[p]:
            goto[p][c] = cur
            p = link[p]
        if p >= 0:
            q = goto[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                copy = len(goto)
                goto.append(dict(goto[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and goto[p].get(c) == q:
                    goto[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return goto


class DenseSteps:
    """Flat table over (state, symbol): phrases ended by the step in the top two bits, next row below.

    Without a transition the phrase ends before the symbol, which then starts the next
    one from the root; a symbol that the root lacks is a phrase by itself.
    """

    def __init__(self, text: Sequence[int], width: int):
        goto = suffix_automaton(text)
        root = np.zeros(width, np.uint32)
        known = np.zeros(width, bool)
        for c, to in goto[0].items():
            root[c], known[c] = to * width, True
        fail = np.where(known, root | np.uint32(1 << 30), np.uint32(2 << 30)).astype(np.uint32)
        table = np.tile(fail, (len(goto), 1))
        table[0] = np.where(known, root, np.uint32(1 << 30))
        at = np.repeat(np.arange(len(goto)), [len(g) for g in goto])
        on = np.fromiter((c for g in goto for c in g), np.int64, len(at))
        table[at, on] = np.fromiter((t for g in goto for t in g.values()), np.int64, len(at)) * width
        self.table = table.reshape(-1)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next states, phrases ended)."""
        got = self.table[state + symbol]
        return got & np.uint32(0x3FFFFFFF), got >> np.uint32(30)


class ListedSteps:
    """The same steps over a sorted list of (state, symbol) transitions."""

    def __init__(self, text: Sequence[int], width: int):
        goto = suffix_automaton(text)
        self.width = width
        self.root = np.zeros(width, np.uint32)
        for c, to in goto[0].items():
            self.root[c] = to
        size = [len(g) for g in goto]
        key = np.repeat(np.arange(len(goto)), size) * width + np.fromiter((c for g in goto for c in g), np.int64, sum(size))
        to = np.fromiter((t for g in goto for t in g.values()), np.uint32, sum(size))
        order = np.argsort(key)
        self.key, self.to = key[order], to[order]

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        into = self.root[symbol]
        ended = (into == 0).astype(np.uint32)  # a symbol the root lacks
        inside = np.flatnonzero(state)
        ended[inside] += np.uint32(1)
        inside = inside[into[inside] > 0]  # what the root lacks no state has
        key = state[inside] * np.int64(self.width) + symbol[inside]
        at = np.searchsorted(self.key, key).clip(max=len(self.key) - 1)
        hit = self.key[at] == key
        into[inside[hit]] = self.to[at[hit]]
        ended[inside[hit]] = 0
        return into, ended


@lru_cache(maxsize=2)
def parser(model: LanguageModel) -> CrossParser:
    """One parser for each model and Python worker."""
    return CrossParser(model)


class CrossParser:
    def __init__(self, model: LanguageModel):
        self.model = model
        width, kind = FIRST + len(model.letters), symbol_type(model.letters)
        references = [np.frombuffer(r, kind) for r in model.references]
        self.weight = np.array([np.log2(max(2, len(r))) for r in references])
        self.tables: list[DenseSteps | ListedSteps] = []
        self.own: list[np.ndarray | None] = []  # each language's numbers of the symbols, if not the joint ones
        for r in references:
            letters = np.setdiff1d(r, [BLANK, OTHER])
            if width > FIRST + DENSE_LETTERS:
                own = np.full(width, OTHER, symbol_type(model.letters))
                own[BLANK] = BLANK
                own[letters] = FIRST + np.arange(len(letters))
                self.own.append(own)
                steps = DenseSteps if len(letters) <= DENSE_LETTERS else ListedSteps
                self.tables.append(steps(own[r].tolist(), FIRST + len(letters)))
            else:
                self.own.append(None)
                self.tables.append(DenseSteps(r.tolist(), width))

    def bits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(bits per symbol by text and language, whether the text has a letter)."""
        return self.measure(texts)[:2]

    def measure(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`bits`, and the number of symbols of each text."""
        sym, at = symbols(texts, self.model.letters)
        size = np.diff(at)
        letters = np.concatenate([[0], np.cumsum(sym != BLANK)])
        has = letters[at[1:]] > letters[at[:-1]]
        blocks = -(-size // BLOCK)
        of = np.repeat(np.arange(len(size)), blocks)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        length = np.minimum(size[of] - nth * BLOCK, BLOCK)
        order = np.argsort(-length, kind="stable")
        of, start, length = of[order], (at[:-1][of] + nth * BLOCK)[order], length[order]
        lanes = np.zeros(len(of) * BLOCK, sym.dtype)
        lanes[ragged((np.arange(len(of)) * BLOCK).astype(np.int32), length)] = \
            sym[ragged(start.astype(np.int32), length)]
        lanes = np.ascontiguousarray(lanes.reshape(len(of), BLOCK).T)
        live = np.searchsorted(-length, -np.arange(BLOCK), side="left")  # lanes longer than t
        phrases = np.empty((len(texts), len(self.tables)))
        for k, (steps, own) in enumerate(zip(self.tables, self.own)):
            state = np.zeros(len(of), np.uint32)
            ended = np.zeros(len(of), np.uint32)
            for t in range(BLOCK):
                n = live[t]
                if n == 0:
                    break
                state[:n], more = steps.step(state[:n], lanes[t, :n] if own is None else own[lanes[t, :n]])
                ended[:n] += more
            phrases[:, k] = np.bincount(of, ended + (state > 0), len(texts))
        return phrases * self.weight / np.maximum(size, 1)[:, None], has, size

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text; the score compares the best with the next language."""
        bits, has = self.bits(texts)
        if not self.tables:
            return [UND] * len(texts), np.zeros(len(texts))
        best = bits.argmin(axis=1)
        ranked = np.sort(bits, axis=1)
        first, second = ranked[:, 0], ranked[:, min(1, ranked.shape[1] - 1)]
        score = np.where(has, second / np.maximum(first + second, 1e-12), 0.0) \
            if len(self.tables) > 1 else has.astype(float)
        return [self.model.languages[i] if h else UND for i, h in zip(best, has)], score


def window_of_text(chars: int) -> Column:
    """`chars` characters of the text from a place that the id's hash chooses; whole shorter texts."""
    start = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.length("text") - chars + 1, F.lit(1)).cast("long"))
    return F.substring(F.col("text"), (start + 1).cast("int"), F.lit(chars))


def fit(docs: DataFrame, teach: Column, rows: int = REFERENCE_ROWS,
        reference_symbols: int = REFERENCE_SYMBOLS) -> LanguageModel:
    """Reference texts from `rows` labelled rows a language, chosen by a hash of the id.

    Each gives an equal share, from a place in its text that a hash chooses; at most
    rows x languages windows of texts reach the driver.
    """
    importable(docs.sparkSession)
    share = -(-reference_symbols // rows)
    labelled = docs.filter(teach & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    names = [r.lang for r in labelled.select("lang").distinct().collect()]  # the languages
    chosen = hash_sample(labelled.select("doc_id", "lang").distinct(), "lang", dict.fromkeys(names, rows))
    # at most rows x languages ids
    texts = labelled.join(F.broadcast(chosen), ["doc_id", "lang"]) \
        .select("lang", F.xxhash64("doc_id").alias("h"), "doc_id", window_of_text(4 * share).alias("text")).dropna().collect()
    texts.sort(key=lambda r: (r.lang, r.h, r.doc_id, r.text))
    letters = "".join(sorted({c for r in texts for c in r.text.lower() if c.isalpha()}))
    refs: dict[str, bytes] = {}
    for r in texts:
        sym, _ = symbols([r.text], letters)
        at = r.h % max(1, len(sym) - share + 1)
        refs[r.lang] = refs.get(r.lang, b"") + sym[at:at + share].tobytes() + np.array([BLANK], sym.dtype).tobytes()
    refs = {k: v for k, v in refs.items() if any(v)}
    return LanguageModel(letters, tuple(sorted(refs)), tuple(refs[k] for k in sorted(refs)))


def _predict(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cross = parser(model)
        for b in slices(batches):
            lang, score = cross.predict([t or "" for t in b["text"].to_pylist()])
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(lang), pa.array(score)],
                                             ["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, held_out: Column, model: LanguageModel | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from rows that aren't held out unless given a model."""
    importable(docs.sparkSession)
    model = model or fit(docs, ~held_out)
    return docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text") \
        .mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")


def level(docs: DataFrame, teach: Column, model: LanguageModel) -> float:
    """Bits per symbol that a text of a learned language may need, from labelled rows the model hasn't learned from.

    The highest of all those rows, whole texts, each let off SLACK phrases, and MARGIN above
    that; infinite where no such rows are left.
    """
    if not model.languages:
        return float("inf")
    labelled = docs.filter(teach & F.col("lang").isin(list(model.languages)) & F.col("doc_id").isNotNull())
    taught = hash_sample(labelled.select("doc_id", "lang").distinct(), "lang", dict.fromkeys(model.languages, REFERENCE_ROWS))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cross = parser(model)
        for b in slices(batches):
            bits, has, size = cross.measure([t or "" for t in b["text"].to_pylist()])
            needs = bits.min(axis=1) - SLACK * cross.weight.max() / np.maximum(size, 1)
            yield pa.RecordBatch.from_arrays([pa.array(needs[has].max(keepdims=True) if has.any() else [], pa.float64())], ["bits"])
    # the rows learned from: at most REFERENCE_ROWS x languages ids
    rows = labelled.select("doc_id", "text").join(F.broadcast(taught.select("doc_id")), "doc_id", "left_anti")
    most = rows.mapInArrow(least, "bits double").agg(F.max("bits")).first()[0]
    return float("inf") if most is None else float(MARGIN * most)


def keep_identified(docs: DataFrame, held_out: Column) -> DataFrame:
    """Rows of `docs` whose text is of a learned language, whichever it is.

    Null and letterless texts go.  So do texts that need more bits per symbol than the calibrated
    `level`, by more than SLACK phrases, in every language: dumps of tokens or codes and unlearned
    languages.  Where nothing was learned or can be calibrated, every text with a letter stays.
    """
    importable(docs.sparkSession)
    model, schema = fit(docs, ~held_out), docs.schema
    most = level(docs, ~held_out, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cross = parser(model)
        for b in slices(batches):
            bits, has, size = cross.measure([t or "" for t in b["text"].to_pylist()])
            if np.isfinite(most):
                has &= (bits.min(axis=1) - most) * size <= SLACK * cross.weight.max()
            yield b.filter(pa.array(has, pa.bool_()))
    return docs.mapInArrow(run, schema)
