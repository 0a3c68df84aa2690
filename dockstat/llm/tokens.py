"""Token ids by a public tokenizer file, encoded batch-wise inside tasks."""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
import zlib
from array import array
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from dockstat.llm.common import coded, ragged

#: Latin-1 letters keep their form under NFC and have one lower-case letter each.  A word of
#: these, digits and ASCII marks (no apostrophe) falls into runs of letters, single digits and
#: runs of marks, which the tokenizer encodes one by one.
LETTER, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
LETTERS = re.compile(f"[{LETTER}]+").fullmatch
PLAIN = re.compile(f"[{LETTER}0-9{MARKS}]+").fullmatch
PIECES = re.compile(f"[{LETTER}]+|[0-9]|[{MARKS}]+").findall


@lru_cache(maxsize=1)
def tail() -> str:
    """Marks after a letter and before white space are a piece of their own.

    Not so after letters that don't end in a letter once normalised and lower-cased (a
    capital I with a dot, Indic letters with a nukta, pointed Hebrew ones): the combining mark
    they end in joins the marks after it.
    """
    def ends_open(c: str) -> bool:
        return unicodedata.category(unicodedata.normalize("NFC", c).lower()[-1])[0] != "L"

    odd = [f"\\x{{{i:x}}}" for i in range(sys.maxunicode + 1) if unicodedata.category(c := chr(i))[0] == "L" and ends_open(c)]
    return rf"([^\PL{''.join(odd)}])([.,;:!?]+)([ \n]|$)"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, others follow from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts, equal to `Tokenizer.encode(text, add_special_tokens=False)`.

    Where the tokenizer drops white space, no token spans two words, so each
    distinct word of a batch is encoded once and kept in a cache of bounded size.
    Other tokenizers encode each text as a whole.
    """

    def __init__(self, path: str, cache_words: int = 350_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        forms = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers") or []]
        split = parts[0] if parts and parts[0]["type"] == "Split" else {}
        self.by_word = bool(split) and split["behavior"] == "Removed" and split["invert"] \
            and "[^\\s" in split["pattern"].get("Regex", "")
        self.lettered = self.by_word and forms == ["NFC", "Replace", "Lowercase"] \
            and [p["type"] for p in parts] == ["Split", "ByteLevel"] and not parts[1]["add_prefix_space"]
        self.table = byte_letters()
        self.model, self.single = self.tok.model, {}
        self.cache_words = cache_words
        self._start()

    def _forget(self) -> None:
        """Keep only words met in more than one slice; the many met once hardly come again."""
        at = np.array(self.ends)
        kept = [(w, i) for w, i in self.cache.items() if self.hits[i] > 1] \
            if len(self.cache) <= self.cache_words else []
        old = np.array([i for _, i in kept], np.int64)
        length = at[old + 1] - at[old]
        ids = np.array(self.pool, np.uint32)[ragged(at[old], length)]
        self._start()
        self.cache = {w: i for i, (w, _) in enumerate(kept)}
        self.pool.frombytes(ids.tobytes())
        self.ends.frombytes(np.cumsum(length, dtype=np.int32).tobytes())

    def _start(self) -> None:
        self.cache: dict[str, int] = {}   # word -> its number
        self.pool = array("I")            # ids of all cached words
        self.ends = array("i", [0])       # where each word's ids end
        self.hits = np.zeros(self.cache_words, np.int32)  # slices that had the word

    def _add(self, word: str, ids: list[int]) -> None:
        self.cache[word] = len(self.ends) - 1
        self.pool.extend(ids)
        self.ends.append(len(self.pool))

    def _piece(self, piece: str) -> list[int]:
        letters = piece.lower().encode().decode("latin-1").translate(self.table)
        return [t.id for t in self.model.tokenize(letters)]

    def _learn(self, words: list[str]) -> None:
        hard, pool, ends, cache, table, tokenize = [], self.pool, self.ends, self.cache, self.table, self.model.tokenize
        for w in words:
            if not self.lettered:
                hard.append(w)
            elif LETTERS(w):
                pool.extend([t.id for t in tokenize(w.lower().encode().decode("latin-1").translate(table))])
                cache[w] = len(ends) - 1
                ends.append(len(pool))
            elif PLAIN(w) and "<|" not in w:
                ids = []
                for piece in PIECES(w):
                    if len(piece) > 1:
                        ids += self._piece(piece)
                    else:
                        if piece not in self.single:
                            self.single[piece] = self._piece(piece)
                        ids += self.single[piece]
                self._add(w, ids)
            else:
                hard.append(w)
        for w, e in zip(hard, self.tok.encode_batch_fast(hard, add_special_tokens=False)):
            self._add(w, e.ids)

    def _numbers(self, vocab: list[str]) -> np.ndarray:
        if len(self.cache) + len(vocab) > self.cache_words:
            self._forget()
        got = np.fromiter(map(self.cache.get, vocab, repeat(-1)), np.int64, len(vocab))
        missing = np.flatnonzero(got < 0)
        if len(missing):
            words = [vocab[i] for i in missing]
            self._learn(words)
            got[missing] = np.fromiter(map(self.cache.__getitem__, words), np.int64, len(words))
        if len(self.cache) > len(self.hits):  # a slice larger than the cache
            self.hits = np.concatenate([self.hits, np.zeros(len(self.cache) - len(self.hits), np.int32)])
        self.hits[got] += 1
        return got

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids uint32, bounds): text d has ids[bounds[d]:bounds[d+1]]; a null text has none."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            got = [e.ids for e in self.tok.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            bounds = np.concatenate([[0], np.cumsum([len(g) for g in got], dtype=np.int64)])
            return np.array([i for g in got for i in g], np.uint32), bounds
        if self.lettered:
            texts = pc.replace_substring_regex(texts, tail(), r"\1 \2\3")
            if not pc.any(pc.match_substring(texts, "<|")).as_py():
                texts = pc.ascii_lower(texts)  # never makes a special token's string here
        words = coded(pc.split_pattern(pc.replace_substring(texts, "\n", " "), " "))
        number = self._numbers(words.vocab)
        ends = np.array(self.ends)
        start = ends[number][words.codes]
        length = ends[number + 1][words.codes] - start
        at = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
        return np.frombuffer(self.pool, np.uint32)[ragged(start, length)], at[words.bounds]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append end_id to each text's ids."""
    return (np.insert(ids, bounds[1:], np.uint32(end_id)).astype("<u4"),
            bounds + np.arange(len(bounds)))


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())
