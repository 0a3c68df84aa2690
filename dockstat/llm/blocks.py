"""Leaf blocks of an HTML page: text between block boundaries, with the open elements above it.

A tolerant reader, not a DOM: comments, declarations and the contents of scripts, styles and
similar elements are passed over; inline elements don't end a block; `p`, list items and table
cells close implicitly, and an end tag closes whatever stands open inside its element.  Reading is
one pass; a comment or script that is never closed runs to the end of the page, and so does a tag.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple
from zlib import crc32

PATH_BUCKETS = 4096

#: Elements of HTML by how they are read.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
                   "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
UNREAD = frozenset("iframe math noembed noframes noscript object script style svg template textarea title xmp".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
FENCES = frozenset("ul ol dl table select body article section div main aside nav header footer form blockquote".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)
                    |<(/?)([a-z][^\s/>]*)((?:[^>=]+|=\s*(?:"[^"]*"|'[^']*')|=)*+)>
                    |<(/?)([a-z][^\s/>]*)([^>]*)(?:>|\Z)
                    |<[!?/][^>]*(?:>|\Z)""", re.X | re.S | re.I)
ATTRIBUTE = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block(NamedTuple):
    text: str
    path: tuple[int, ...]   # buckets of the open elements' names, class, id and role words
    words: frozenset[str]   # the same, spelled out, for labelling
    linked: int             # characters inside links


def element_tokens(name: str, attributes: str, known: dict[tuple[str, str], tuple[str, ...]] = {}) -> tuple[str, ...]:
    """The element's name in brackets and the words of its class, id and role."""
    key = (name, attributes)
    if key not in known:
        if len(known) > 50_000:
            known.clear()
        found = [v for m in ATTRIBUTE.finditer(attributes) for v in m.groups() if v]
        known[key] = tuple(dict.fromkeys([f"<{name}>", *(p.lower() for v in found for p in PIECE.findall(v))]))
    return known[key]


class _Open:
    """The open block elements, and which token buckets they cover."""

    def __init__(self):
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.names, self.tokens = Counter(), Counter()
        self.now = None

    def push(self, name: str, tokens: tuple[str, ...]) -> None:
        self.stack.append((name, tokens))
        self.names[name] += 1
        self.tokens.update(tokens)
        self.now = None

    def pop(self) -> str:
        name, tokens = self.stack.pop()
        self.names[name] -= 1
        for t in tokens:
            if self.tokens[t] == 1:
                del self.tokens[t]
            else:
                self.tokens[t] -= 1
        self.now = None
        return name

    def close(self, name: str) -> None:
        if self.names[name] > 0:
            while self.pop() != name:
                pass

    def close_before(self, name: str) -> None:
        """What a start tag closes by itself."""
        if self.names["p"] > 0:
            at = len(self.stack) - 1
            while at >= 0 and self.stack[at][0] not in FENCES:
                if self.stack[at][0] == "p":
                    while len(self.stack) > at:
                        self.pop()
                    break
                at -= 1
        for other in CLOSES.get(name, ()):
            at = len(self.stack) - 1
            while at >= 0 and self.stack[at][0] not in FENCES:
                if self.stack[at][0] == other:
                    while len(self.stack) > at:
                        self.pop()
                    break
                at -= 1

    def path(self) -> tuple[tuple[int, ...], frozenset[str]]:
        if self.now is None:
            own = f"^{self.stack[-1][0]}" if self.stack else "^"
            self.now = (tuple(sorted({crc32(t.encode("utf-8", "replace")) % PATH_BUCKETS for t in (*self.tokens, own)})),
                        frozenset(self.tokens))
        return self.now


def read_blocks(page: str) -> list[Block]:
    """Blocks of a page in order, white space collapsed, empty ones left out."""
    out: list[Block] = []
    opened = _Open()
    pieces: list[str] = []
    linked, link = 0, False

    def end_block() -> None:
        nonlocal linked, link
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                path, words = opened.path()
                out.append(Block(text, path, words, min(linked, len(text))))
            pieces.clear()
        linked, link = 0, False

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            pieces.append(text)
            linked += len(text) if link else 0

    at = 0
    while at < len(page):
        m = TOKEN.search(page, at)
        add(page[at:m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        ending, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in INLINE:
            if name == "a":
                link = not ending
            elif name == "br":
                pieces.append(" ")
            continue
        if name in UNREAD:
            if not ending and not attributes.endswith("/"):
                close = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
                at = close.start() if close else len(page)
            pieces.append(" ")
            continue
        end_block()
        if ending:
            opened.close(name)
        elif name not in VOID:
            opened.close_before(name)
            opened.push(name, element_tokens(name, attributes))
    end_block()
    return out
