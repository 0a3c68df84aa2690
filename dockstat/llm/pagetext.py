"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks (`blocks.read_blocks`).  A block's vector is the mean of
hashed embeddings of the elements open above it (names and words of class, id and role), the mean of
hashed embeddings of its words, and some figures (length, share of links, punctuation, place in the
page).  A bidirectional LSTM in numpy reads the whole sequence, so each block is judged with all of the
page around it, and a logistic layer labels it main text or not.  The text is the main blocks in page
order, joined by one newline.

There are no labels to learn from, so they come from two sources: pages that mark their article
themselves (`article`, `main`), chosen by a hash and bounded by SAMPLE_PAGES of at most SAMPLE_CHARS
characters each, and LAID_OUT pages that put the sampled blocks, or invented words where there are too
few, into random layouts whose parts are known.  Training needs nothing else; the learned model is about
1 MB.  Every page is then read whole, in tasks, without a shuffle.

Defined cases: null and empty pages, and pages without main blocks, have empty text; repeated rows are
extracted each; null ids and urls are kept; unclosed comments, scripts and tags run to the end of the
page; pages of any length and nesting are read in one pass; an empty table gives an empty result; columns
other than the three named ones are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockstat.llm.blocks import PATH_BUCKETS, Block, read_blocks
from dockstat.llm.common import hash_words, importable, slices, split_words

SAMPLE_PAGES, SAMPLE_CHARS, LAID_OUT = 256, 100_000, 320
WORD_BUCKETS = 1 << 14
PATH_DIM, WORD_DIM, FIGURES, HIDDEN = 16, 8, 9, 16
EPOCHS, BATCH, RATE = 12, 32, 0.015  # the rate falls to zero
PAGE_BATCH = 128          # pages that one pass of the labeller holds
STEP_CELLS = 1 << 17      # blocks (with padding) that one pass of the labeller holds at most

#: Words of class, id, role and element names that mark parts which are not the article.
BOILERPLATE = frozenset("""
<nav> <header> <footer> <aside> <form> <button> <select> <menu> <dialog> <fieldset>
ad ads adsense advert advertisement alert banner breadcrumb breadcrumbs comment commentlist comments consent
cookie cookies copyright disclaimer discussion footer form gdpr header login masthead menu nav navbar
navigation newsletter notice notification pagination popup promo promoted related replies reply respond search share
sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget
""".split())
ARTICLE = frozenset(["<article>", "<main>"])


# ---- features ---------------------------------------------------------------------

@dataclass
class Features:
    """Of the blocks of some pages, one after another: ragged path and word buckets, figures."""
    path: np.ndarray
    path_at: np.ndarray
    word: np.ndarray
    word_at: np.ndarray
    figures: np.ndarray


def features(pages: list[list[Block]]) -> Features:
    blocks = [b for p in pages for b in p]
    words = split_words(pa.array([b.text for b in blocks], pa.large_string()).cast(pa.string()))
    buckets = (hash_words(words.vocab) % np.uint64(WORD_BUCKETS)).astype(np.int64) if words.vocab else np.zeros(0, np.int64)
    size = np.array([len(b.path) for b in blocks], np.int64)
    place = [(i / max(1, len(p) - 1), np.log1p(len(p)) / 5) for p in pages for i in range(len(p))]
    n_words = np.diff(words.bounds)
    figures = np.zeros((len(blocks), FIGURES), np.float32)
    for i, b in enumerate(blocks):
        n = len(b.text)
        figures[i, 0] = np.log1p(n) / 5
        figures[i, 2] = b.linked / n
        figures[i, 3] = b.text[-1] in ".!?…\"'»”"
        figures[i, 4] = b.text.count(",") / n * 20
        figures[i, 5] = b.text[0].isupper()
    figures[:, 1] = np.log1p(n_words) / 5
    figures[:, 6:8] = np.array(place, np.float32).reshape(-1, 2)
    figures[:, 8] = 1
    return Features(np.array([x for b in blocks for x in b.path], np.int64), np.concatenate([[0], np.cumsum(size)]),
                    buckets[words.codes], words.bounds, figures)


def ragged_mean(table: np.ndarray, index: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Mean of table rows index[at[i]:at[i+1]] for each i; zeros where there are none."""
    n = len(at) - 1
    out = np.zeros((n, table.shape[1]), table.dtype)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        out[some] = np.add.reduceat(table[index], at[some], axis=0) / np.diff(at)[some, None]
    return out


# ---- the network --------------------------------------------------------------------

def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def lstm(x: np.ndarray, live: np.ndarray, w: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (T, B, H) over x (T, B, D); steps where `live` is 0 leave the state as it is."""
    t, b, d = x.shape
    hidden = w.shape[1] // 4
    into = x.reshape(t * b, d) @ w[:d] + w[-1]
    into = into.reshape(t, b, -1)
    h, c = np.zeros((b, hidden), x.dtype), np.zeros((b, hidden), x.dtype)
    out = np.zeros((t, b, hidden), x.dtype)
    for i in range(t):
        a = into[i] + h @ w[d:-1]
        gate, cell = sigmoid(a[:, :3 * hidden]), np.tanh(a[:, 3 * hidden:])
        new = gate[:, hidden:2 * hidden] * c + gate[:, :hidden] * cell
        bent = np.tanh(new)
        m = live[i][:, None]
        if keep is not None:
            keep.append((h, c, gate, cell, bent, m))
        c = m * new + (1 - m) * c
        h = m * gate[:, 2 * hidden:] * bent + (1 - m) * h
        out[i] = h
    return out


def lstm_back(x: np.ndarray, w: np.ndarray, kept: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of x and w, given those of the hidden states."""
    t, b, d = x.shape
    hidden = w.shape[1] // 4
    dw, da_all = np.zeros_like(w), np.zeros((t, b, 4 * hidden), x.dtype)
    dh, dc = np.zeros((b, hidden), x.dtype), np.zeros((b, hidden), x.dtype)
    for i in range(t - 1, -1, -1):
        h, c, gate, cell, bent, m = kept[i]
        dh = dh + dout[i]
        give, forget, show = gate[:, :hidden], gate[:, hidden:2 * hidden], gate[:, 2 * hidden:]
        dnew = dh * m * show * (1 - bent * bent) + dc * m
        da = np.concatenate([dnew * cell * give * (1 - give), dnew * c * forget * (1 - forget),
                             dh * m * bent * show * (1 - show), dnew * give * (1 - cell * cell)], axis=1)
        da_all[i] = da
        dw[d:-1] += h.T @ da
        dc = dnew * forget + dc * (1 - m)
        dh = da @ w[d:-1].T + dh * (1 - m)
    flat = da_all.reshape(t * b, -1)
    dw[:d] = x.reshape(t * b, d).T @ flat
    dw[-1] = flat.sum(axis=0)
    return (flat @ w[:d].T).reshape(t, b, d), dw


class BlockLabeller:
    """Embeddings, one LSTM in each direction, and a logistic layer over both and the block itself."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        d = PATH_DIM + WORD_DIM + FIGURES

        def some(*shape, scale):
            return (rng.normal(size=shape) * scale).astype(np.float32)

        self.weights = {"path": some(PATH_BUCKETS, PATH_DIM, scale=0.5), "word": some(WORD_BUCKETS, WORD_DIM, scale=0.05),
                        "on": some(d + HIDDEN + 1, 4 * HIDDEN, scale=0.2), "back": some(d + HIDDEN + 1, 4 * HIDDEN, scale=0.2),
                        "out": some(2 * HIDDEN + d, 1, scale=0.2)}

    def vectors(self, f: Features) -> np.ndarray:
        return np.hstack([ragged_mean(self.weights["path"], f.path, f.path_at),
                          ragged_mean(self.weights["word"], f.word, f.word_at), f.figures])

    @staticmethod
    def padded(x: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(T, B, D) sequences and their mask from rows one page after another."""
        live = (np.arange(max(sizes))[:, None] < np.array(sizes)[None]).astype(np.float32)
        out = np.zeros((*live.shape, x.shape[1]), np.float32)
        out.transpose(1, 0, 2)[live.T > 0] = x
        return out, live

    def logits(self, x: np.ndarray, live: np.ndarray, keep: tuple[list, list] | None = None) -> np.ndarray:
        on = lstm(x, live, self.weights["on"], keep and keep[0])
        back = lstm(x[::-1], live[::-1], self.weights["back"], keep and keep[1])[::-1]
        seen = np.concatenate([on, back, x], axis=2)
        if keep is not None:
            keep[0].append(seen)
        return (seen @ self.weights["out"])[:, :, 0]

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Probability of main text of every block of every page."""
        out: list = [np.zeros(0)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        lo = 0
        while lo < len(order):
            hi = lo + 1
            while hi < len(order) and hi - lo < PAGE_BATCH and (hi - lo + 1) * len(pages[order[hi]]) <= STEP_CELLS:
                hi += 1
            some = [pages[i] for i in order[lo:hi]]
            x, live = self.padded(self.vectors(features(some)), [len(p) for p in some])
            p = sigmoid(self.logits(x, live))
            for k, i in enumerate(order[lo:hi]):
                out[i] = p[:len(pages[i]), k]
            lo = hi
        return out

    def train(self, pages: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS, seed: int = 5) -> None:
        rng = random.Random(seed)
        pages = sorted(pages, key=lambda p: len(p[0]))
        groups = [pages[i:i + BATCH] for i in range(0, len(pages), BATCH)]
        data = [(features([p for p, _ in g]), [len(p) for p, _ in g], np.concatenate([y for _, y in g]).astype(np.float32))
                for g in groups]
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step, steps = 0, epochs * len(data)
        for _ in range(epochs):
            rng.shuffle(data)
            for f, sizes, y in data:
                step += 1
                rate = RATE * (1 - (step - 1) / steps)
                for k, g in self.gradients(f, sizes, y).items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    self.weights[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)

    def gradients(self, f: Features, sizes: list[int], y: np.ndarray) -> dict[str, np.ndarray]:
        rows = self.vectors(f)
        x, live = self.padded(rows, sizes)
        keep: tuple[list, list] = ([], [])
        p = sigmoid(self.logits(x, live, keep))
        seen = keep[0].pop()
        target = np.zeros_like(live)
        target.T[live.T > 0] = y
        dlogit = ((p - target) * live / len(y)).astype(np.float32)
        dseen = dlogit[:, :, None] * self.weights["out"][:, 0]
        dx_on, don = lstm_back(x, self.weights["on"], keep[0], dseen[:, :, :HIDDEN])
        dx_back, dback = lstm_back(x[::-1], self.weights["back"], keep[1], dseen[::-1, :, HIDDEN:2 * HIDDEN])
        dx = (dx_on + dx_back[::-1] + dseen[:, :, 2 * HIDDEN:]).transpose(1, 0, 2)[live.T > 0]
        out = {"on": don, "back": dback, "out": np.einsum("tbd,tb->d", seen, dlogit)[:, None]}
        for name, index, at, part in (("path", f.path, f.path_at, dx[:, :PATH_DIM]),
                                      ("word", f.word, f.word_at, dx[:, PATH_DIM:PATH_DIM + WORD_DIM])):
            size = np.diff(at)
            g = np.zeros_like(self.weights[name])
            np.add.at(g, index, np.repeat(part / np.maximum(size, 1)[:, None], size, axis=0))
            out[name] = g
        return out


# ---- what it learns from ----------------------------------------------------------------

def own_labels(blocks: list[Block]) -> list[int] | None:
    """Labels of a page that marks its article itself; None if it doesn't."""
    y = [int(bool(b.words & ARTICLE) and not b.words & BOILERPLATE) for b in blocks]
    return y if any(y) else None


class Layouts:
    """Random pages of known parts; main blocks start with MAIN, all others with OTHER."""

    MAIN, OTHER = "\x01", "\x02"
    WRAPS = ["<article>", "<main>", '<div class="content">', '<div id="content">', '<div class="post-body">',
             '<div class="entry-content">', '<div class="article-text">', '<section class="story">', '<div role="main">',
             '<div id="main-column">', '<td class="text">', '<div class="c12">', "<div>"]
    PARTS = {
        "menu": ["<nav>", '<ul class="menu">', '<div class="navbar">', '<div id="nav">', '<div class="navigation">',
                 '<div class="breadcrumbs">', '<ul role="navigation">'],
        "head": ["<header>", '<div class="header">', '<div id="masthead">', '<div class="site-header">', '<div class="topbar">'],
        "foot": ["<footer>", '<div class="footer">', '<div id="footer">', '<div class="copyright">', '<div class="disclaimer">'],
        "side": ["<aside>", '<div class="sidebar">', '<div class="widget">', '<div class="related">', '<div id="sidebar-left">'],
        "advert": ['<div class="ad">', '<div class="ads">', '<div class="advertisement">', '<div class="sponsored">',
                   '<div class="promo">', '<div id="banner">'],
        "notice": ['<div class="cookie-notice">', '<div class="alert">', '<div class="consent">', '<div class="gdpr">',
                   '<div class="newsletter">', '<div role="alert">', "<dialog>", '<div class="popup">'],
        "form": ["<form>", '<form class="search">', '<div class="login">', '<div class="subscribe">'],
        "share": ['<div class="share">', '<div class="social">', '<ul class="sharing">'],
        "comments": ['<div class="comments">', '<section id="comments">', '<ol class="commentlist">', '<div id="respond">',
                     '<div class="discussion">', '<div class="replies">'],
    }

    def __init__(self, texts: list[str], seed: int):
        self.rnd = random.Random(seed)
        self.texts = texts
        self.syllables = ["ba", "den", "ti", "or", "sul", "me", "gra", "fi", "lon", "ek", "vas", "pu", "rin", "ho"]

    def pick(self, *options: str) -> str:
        return self.rnd.choice(options)

    def words(self, n: int) -> str:
        text = " ".join("".join(self.rnd.choices(self.syllables, k=self.rnd.randint(1, 4))) for _ in range(n))
        return text.capitalize()

    def prose(self) -> str:
        if self.texts and self.rnd.random() < 0.7:
            return self.rnd.choice(self.texts)
        return self.words(self.rnd.choice([1, 2, 5, 12, 30, 60, 90])) + self.pick(".", ".", "!", "")

    def label(self) -> str:
        return self.words(self.rnd.randint(1, 3)) if self.rnd.random() < 0.7 or not self.texts else " ".join(self.rnd.choice(self.texts).split()[:4])

    @staticmethod
    def close(tag: str) -> str:
        return f"</{tag[1:].split()[0].rstrip('>')}>"

    def wrap(self, tag: str, inner: str) -> str:
        for _ in range(self.rnd.choice([0, 0, 1, 2])):
            inner = self.pick("<div>", '<div class="inner">', '<div class="row">') + inner + "</div>"
        return tag + inner + self.close(tag)

    def part(self, kind: str) -> str:
        o, rnd = self.OTHER, self.rnd
        tag = rnd.choice(self.PARTS[kind])
        if kind in ("menu", "share"):
            items = [f'<a href="/x">{o}{self.label()}</a>' for _ in range(rnd.randint(1, 12))]
            inner = "".join(f"<li>{x}</li>" for x in items) if rnd.random() < 0.7 else "".join(f"<div>{x}</div>" for x in items)
        elif kind == "form":
            inner = f"<p>{o}{self.label()}</p><label>{o}{self.label()}</label><input><button>{o}{self.label()}</button>"
        elif kind == "comments":
            inner = "".join(f'<div class="{self.pick("comment", "reply", "c3")}"><p>{o}{self.prose()}</p></div>' for _ in range(rnd.randint(1, 6)))
        else:
            inner = "".join(self.pick("<p>{}</p>", "{}<hr>", '<div>{}</div>', '<p><a href="/y">{}</a></p>', "<h3>{}</h3>").format(
                o + (self.prose() if rnd.random() < 0.5 else self.label())) for _ in range(rnd.randint(1, 4)))
        return self.wrap(tag, inner)

    def article(self) -> str:
        m, rnd = self.MAIN, self.rnd
        out = [f"<h1>{m}{self.words(rnd.randint(2, 9))}</h1>"] if rnd.random() < 0.8 else []
        for _ in range(rnd.randint(1, 14)):
            kind = rnd.random()
            if kind < 0.7:
                out.append(self.pick("<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", '<p>{} <a href="/z">link</a></p>').format(m + self.prose()))
            elif kind < 0.78:
                out.append(f"<h2>{m}{self.words(rnd.randint(1, 6))}</h2>")
            elif kind < 0.86:
                out.append("<ul>" + "".join(f"<li>{m}{self.prose()}</li>" for _ in range(rnd.randint(1, 6))) + "</ul>")
            elif kind < 0.9:
                out.append(f"<blockquote>{m}{self.prose()}</blockquote>")
            elif kind < 0.93:
                out.append("<table><tr>" + "".join(f"<td>{m}{self.words(2)}</td>" for _ in range(rnd.randint(1, 6))) + "</tr></table>")
            else:
                out.append(self.part(self.pick("advert", "share", "side", "form", "notice")))
        return "".join(out)

    def page(self) -> str:
        rnd = self.rnd
        before = [self.part(k) for k in ("notice", "head", "menu", "advert", "side") if rnd.random() < 0.5]
        after = [self.part(k) for k in ("share", "side", "advert", "form", "notice", "menu", "foot") if rnd.random() < 0.4]
        comments = self.part("comments") if rnd.random() < 0.35 else ""
        if rnd.random() < 0.1:
            body = self.article() + comments
        else:
            tag, inside = rnd.choice(self.WRAPS), rnd.random() < 0.3
            body = self.wrap(tag, self.article() + (comments if inside else "")) + ("" if inside else comments)
        page = "<html><body>" + "".join(before) + body + "".join(after)
        return page + "</body></html>" if rnd.random() < 0.9 else page

    def labelled(self) -> tuple[list[Block], list[int]]:
        blocks, y = [], []
        for b in read_blocks(self.page()):
            marked = b.text.replace(self.MAIN, "").replace(self.OTHER, "")
            if marked:
                y.append(int(self.MAIN in b.text))
                blocks.append(b._replace(text=marked))
        return blocks, y


def train_labeller(pages: list[str], laid_out: int = LAID_OUT, seed: int = 3) -> BlockLabeller:
    """A labeller from pages that mark their article, and from random layouts of their blocks."""
    read = [read_blocks(p) for p in pages]
    layouts = Layouts([b.text for p in read for b in p if len(b.text) > 20 and not b.linked], seed)
    known = [(b, y) for b in read if (y := own_labels(b))]
    made = [layouts.labelled() for _ in range(laid_out)]
    model = BlockLabeller()
    model.train([p for p in known + made if p[0]])
    return model


# ---- on Spark -------------------------------------------------------------------------------

def main_text(model: BlockLabeller, pages: list[str | None]) -> list[str]:
    read = [read_blocks(p) if p else [] for p in pages]
    return ["\n".join(b.text for b, p in zip(blocks, likely) if p >= 0.5) for blocks, likely in zip(read, model.label(read))]


def _extract(model: BlockLabeller):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html"):
            texts = main_text(model, b["html"].to_pylist())
            yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return run


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    importable(df.sparkSession)
    pages = df.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                      F.col(f"`{html_col}`").cast("string").alias("html"))
    # every task sends the driver as many rows as the sample has, so first all but a few times that many go
    share = 4 * SAMPLE_PAGES / max(1, pages.count())
    low = F.pmod(F.xxhash64("html"), F.lit(1 << 32)) / float(1 << 32)
    sample = pages.filter((F.length("html") <= SAMPLE_CHARS) & (low < share)).select("html") \
        .orderBy(F.xxhash64("html"), "html").limit(SAMPLE_PAGES).collect()
    return pages.mapInArrow(_extract(train_labeller([r.html for r in sample])), "page_id long, url string, text string, n_chars long")
