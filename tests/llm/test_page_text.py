"""Page text against an independent reading of the pages' own articles, hand-made pages and held-out layouts."""

import time
from html.parser import HTMLParser

import numpy as np
import pytest

from dockstat.llm import pagetext
from dockstat.llm.blocks import read_blocks
from dockstat.llm.queries import QUERIES

SF10 = "/root/testdata/sf0.01"
SOLID = {"b", "i", "em", "strong", "a", "span", "br"}


class Article(HTMLParser):
    """Text of `article`, a line for each run between tags that aren't inline."""

    def __init__(self):
        super().__init__()
        self.inside, self.lines, self.run = False, [], ""

    def edge(self):
        if self.run.split():
            self.lines.append(" ".join(self.run.split()))
        self.run = ""

    def handle_starttag(self, tag, attrs):
        if tag not in SOLID:
            self.edge()
        self.run += " " if tag == "br" else ""
        self.inside |= tag == "article"

    def handle_endtag(self, tag):
        if tag not in SOLID:
            self.edge()
        self.inside &= tag != "article"

    def handle_data(self, data):
        self.run += data if self.inside else ""


def own_article(page):
    reader = Article()
    reader.feed(page or "")
    reader.close()
    reader.edge()
    return "\n".join(reader.lines)


def test_query_equals_the_articles(spark):
    got = {r.page_id: r for r in QUERIES["op11_page_text"](spark, SF10).collect()}
    pages = spark.read.parquet(f"{SF10}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        r = got[p.page_id]
        assert r.url == p.url and r.n_chars == len(r.text) and r.text == own_article(p.html)


@pytest.fixture(scope="module")
def model(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF10}/pages.parquet").orderBy("page_id").limit(120).collect()]
    return pagetext.train_labeller(pages)


def test_held_out_layouts(model):
    pages = [pagetext.Layouts([], 77 + i).labelled() for i in range(150)]
    pages = [p for p in pages if p[0]]
    right = [(q >= 0.5) == y for (_, ys), p in zip(pages, model.label([b for b, _ in pages])) for q, y in zip(p, ys)]
    assert np.mean(right) >= 0.95


def test_hand_made_pages(model):
    long = "Rivers carry the rain of the hills down to the sea, and the towns along them live from it."
    pages = [
        f'<body><div class="navbar"><a href=1>Home</a></div><div id="content"><h1>Rivers &amp; rain</h1><p>{long}</p><p>A&nbsp;&#8211;&nbsp;B\n  c'
        f'<script>if (a<b) {{"</p>"}}</script> d</p><div class="ad">Buy now</div><p>{long}</div><div class="footer">All rights reserved</div>',
        f'<main><p>{long}</p></main><section id="comments"><div class="comment"><p>{long}</p></div></section><footer>x</footer>',
    ]
    assert pagetext.main_text(model, pages) == [f"Rivers & rain\n{long}\nA – B c d\n{long}", long]


def test_reading_blocks():
    def texts(page):
        return [b.text for b in read_blocks(page)]

    assert texts("") == texts("<p> \n </p>") == texts("<!-- <p>a</p>") == texts("<script>x") == []
    assert texts("a < b &lt; c<p>d<p>e<br>f</div>g") == ["a < b < c", "d", "e f", "g"]
    assert texts('<p title="a>b">c</p><p title=it\'s>d</p><style>p{}</style>e<textarea><p>f</textarea>') == ["c", "d", "e"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts("x<p") == ["x"] and texts("<P CLASS=Big>&eacute;&#x41;&bogus;</P>") == ["éA&bogus;"]
    path = [b.words for b in read_blocks('<div class="siteNav main-menu" id=n1><p>a</div><p>b')]
    assert path[0] == {"<div>", "site", "nav", "main", "menu", "n", "<p>"} and path[1] == {"<p>"}
    assert [b.linked for b in read_blocks("<p>ab <a href=x>cd</a><p>ef")] == [2, 0]


def test_long_and_deep_pages(model):
    began = time.time()
    deep = "".join(f'<div class="k{i % 50}">a{i} ' for i in range(20_000)) + "</div>" * 20_000
    long = "<article>" + "<p>word word.</p>" * 20_000 + "x" * 2_000_000 + "</article>"
    odd = ["<a " * 50_000, "<p =\"" * 20_000, "</p>" * 50_000, "<!-" * 50_000, "<![" * 50_000]
    out = pagetext.main_text(model, [deep, long, *odd, None])
    assert out[1].count("\n") == 20_000 and out[-1] == "" and time.time() - began < 60


def test_defined_cases(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    rows = [(1, None, None, "x", 1), (2, "u", "", "x", 1), (None, "u", "<article><p>Some words stand here.</article>", "x", 1)]
    got = pagetext.extract(spark.createDataFrame(rows + rows[2:], schema))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in got.collect() if r.url) == [
        (0, "u", "Some words stand here.", 22)] * 2 + [(2, "u", "", 0)]
    assert pagetext.extract(spark.createDataFrame([], schema)).count() == 0
