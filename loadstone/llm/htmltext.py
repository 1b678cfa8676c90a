"""Main text of web pages as a maximum-scoring subsequence.

A page is a sequence of words and tags.  Words score positive, tags negative;
the contiguous region of the highest sum is the main content, found in one
linear scan.  The weights are learned from labelled pages: for each tag, and
for the container that words stand in (its name and the words of its class and
id), the rate at which it lies inside labelled content.  A tag costs
``TAG + BORDER * (1 - rate) ** 2``, a word earns ``max(FLOOR, rate)`` of the lowest
rate among its open containers.

Labelled pages are those of :data:`LABELLED` here, and a bounded sample of the
pages given whose markup itself labels the content, by exactly one ``article``
element.

Inside the region, containers whose rate is under one half (scripts, comments,
adverts) are left out.  Character references are decoded, white space inside a
block becomes one space, and blocks are joined by one space.

Defined results: a null or empty page, and one without words, has the empty
text; of regions with equal sums the first wins; markup that never closes is
read as far as it goes, and an element of :data:`RAW` that closes itself or never
closes is left out alone, not what follows it; nothing is cut; repeated rows are
each extracted; columns other than page_id, url and html are not read.  Time grows
with the length of a page, whatever its markup.  When rates are learned, the first
:data:`MOST` words of a labelled text count.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 400  # pages with one article element that train, at most
MOST = 50  # words of one text that count for a rate: long texts are no better examples than short ones
TAG, BORDER, LINK, FLOOR = 0.02, 12.0, 2.0, 0.002  # LINK stands for BORDER on inline tags

#: Elements whose content is not markup, inline elements, containers without an end tag.
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "textarea")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset("article aside body button details dialog div fieldset figure footer form head header html main menu nav ol section select table title ul".split())

# a tag ends at its > or, if it has none, before the next <; so no part of a page is scanned for more than one tag
_ATTRIBUTES = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)({_ATTRIBUTES})(?:>|(?=<))|<[!?][^<>]*+(?:>|(?=<))", re.S)
_RAW_NAME = re.compile(rf"(?:{'|'.join(RAW)})\b", re.I)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_LETTERS = re.compile(r"[a-z]+")


def _page(*, head="", before="", content="", after=""):
    return f"<html><head><title>a page title</title>{head}</head><body>{before}", content, f"{after}</body></html>"


#: Labelled pages: (before, content, after) of the content region.
LABELLED = [
    _page(before='<header class="header"><h1>site name</h1></header><nav class="menu"><ul><li><a href="#">home</a></li><li><a href="#">news</a></li></ul></nav><div class="banner advert ad ads">buy this now</div>', content='<article><h1>title words</h1><p>some <b>bold</b> and <a href="#">linked</a> words here.</p><p>more of it.</p></article>', after='<aside class="sidebar"><ul><li><a href="#">other</a></li></ul></aside><footer class="footer">all rights</footer>'),
    _page(before='<div id="header" class="masthead top">name</div><div class="nav navigation navbar menu breadcrumb"><a href="#">one</a> <a href="#">two</a></div><div class="cookie notice consent banner">we use cookies <button>accept</button></div>', content='<div class="content main post entry body text story"><h2>heading</h2><p>first words of the story.</p><blockquote>quoted words</blockquote><p>last words.</p></div>', after='<div class="comments comment" id="comments"><div class="comment reply">a reader writes</div><form><label>name</label><input><button>send</button></form></div><div class="footer" id="footer">contact terms</div>'),
    _page(before='<div class="sponsored promo advertisement">offer of the day</div><form class="search"><input><button>search</button></form>', content='<main><section><h1>words</h1><p>a text of words<br>on two lines.</p><ul><li>point one</li><li>point two</li></ul><table><tr><td>cell</td></tr></table></section></main>', after='<section class="related recommended share social"><h3>related</h3><ul><li><a href="#">more</a></li></ul></section><div class="newsletter subscribe popup modal">sign up <form><input></form></div>'),
    _page(before='<nav><a href="#">a</a></nav><aside><p>side words</p></aside>', content='<div><p>plain words in a plain page.</p><p>and then some.</p><pre>code words</pre></div>', after='<div class="widget copyright disclaimer legal">words of law</div><footer><p>end</p></footer>'),
    # bare containers: a menu of links, text, a list of links
    _page(before='<div><div><a href="#">one</a> <a href="#">two</a> <a href="#">three</a></div></div>', content='<div><h1>a heading of words</h1><div>first words of a text that goes on for a while.</div><div>more words, with <i>some</i> <em>stress</em> in them.</div></div>', after='<div><ul><li><a href="#">one thing</a></li><li><a href="#">another thing</a></li></ul></div><div>all rights</div>'),
    # nested sections with a figure, a quotation and a definition list
    _page(before='<header role="banner"><a href="#">home</a></header><nav role="navigation"><ol><li><a href="#">up</a></li></ol></nav>', content='<section><section><h2>part one</h2><p>words of part one.</p><figure><img><figcaption>what it shows</figcaption></figure></section><section><h2>part two</h2><blockquote><p>quoted words.</p></blockquote><dl><dt>term</dt><dd>what it means</dd></dl><hr><p>last words.</p></section></section>', after='<aside role="complementary"><h3>see also</h3><ul><li><a href="#">x</a></li></ul></aside><footer role="contentinfo">imprint</footer>'),
    # a page laid out as a table
    _page(before='<table><tr><td><a href="#">home</a><br><a href="#">about</a><br><a href="#">links</a></td><td>', content='<h3>words</h3><p>text in a cell of a table, as it was done once.</p><p>a second paragraph of it.</p><table><tr><th>year</th><th>how many</th></tr><tr><td>one</td><td>two</td></tr></table>', after='</td></tr></table><center><font>best viewed so</font></center>'),
    # a board: the first post is the text, replies are the readers'
    _page(before='<div class="topbar login"><form><input><button>log in</button></form></div><div class="forum breadcrumbs"><a href="#">board</a> <a href="#">topic</a></div>', content='<div class="thread post"><h1>a question</h1><p>what somebody asks, in some words.</p><ol><li>first this</li><li>then that</li></ol></div>', after='<ul class="replies comments"><li class="reply comment">a short answer <a href="#">like</a></li><li class="reply comment">another <a href="#">like</a></li></ul><div class="pagination pager"><a href="#">next</a></div>'),
    # a shop and a manual
    _page(before='<div class="cart basket toolbar"><a href="#">basket</a></div><div class="notice alert warning">we are closed today</div>', content='<div class="description product"><h1>a thing</h1><p>what the thing is good for.</p><ul><li>it is small</li><li>it is blue</li></ul></div>', after='<div class="reviews ratings"><p>a buyer writes</p></div><div class="upsell recommendations"><a href="#">another thing</a></div>'),
    _page(before='<div class="toc sidebar"><ul><li><a href="#">one</a></li><li><a href="#">two</a></li></ul></div>', content='<div class="section documentation"><h1>how to</h1><p>do <code>this</code> first.</p><pre>and this</pre><p>then <kbd>that</kbd>.</p><h2>notes</h2><p>a note.</p></div>', after='<div class="feedback survey"><form><label>was it good</label><button>yes</button></form></div><div class="tags meta byline"><a href="#">tag</a></div>'),
]


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, kind, name, attributes) of what is no text: kind is open, close, raw or empty (comments and declarations).

    What an element of RAW holds is skipped if it ends; one that closes itself, or
    never, is a tag like others.  Ends of such elements are found by one scan for each name.
    """
    at, ends = 0, {}
    while m := _TOKEN.search(page, at):
        start, at = m.span()
        if not m[2]:
            yield start, at, "empty", "", ""
            continue
        raw = None if m[1] else _RAW_NAME.match(m[2])
        if raw and not page.endswith("/>", start, at):
            name = raw[0].lower()
            if name not in ends:
                ends[name] = [e.span() for e in re.finditer(rf"</{name}\s*+>", page, re.I)]
            k = bisect_left(ends[name], (at, 0))
            if k < len(ends[name]):
                at = ends[name][k][1]
                yield start, at, "raw", name, ""
                continue
        yield start, at, "close" if m[1] else "open", m[2].lower(), m[3]


def tokens(page: str) -> Iterator[tuple[str, str, tuple[str, ...] | None]]:
    """("text", words, None), ("open", name, keys), ("close", name, None), ("raw", name, None)."""
    at = 0
    for start, end, kind, name, attributes in tags(page):
        if start > at:
            yield "text", page[at:start], None
        at = end
        if kind == "open":
            keys = (name,)
            if attributes and name in CONTAINERS:
                for found in _NAMES.findall(attributes):
                    keys += tuple(f".{w}" for w in _LETTERS.findall("".join(found).lower()))
            yield "open", name, keys
        elif kind != "empty":
            yield kind, name, None
    if at < len(page):
        yield "text", page[at:], None


class Open:
    """Open containers: which names there are is known without looking through them."""

    def __init__(self):
        self.stack, self.names = [], Counter()

    def push(self, name: str, value) -> None:
        self.stack.append((name, value))
        self.names[name] += 1

    def close(self, name: str) -> Iterator:
        """The values of what the end of ``name`` closes, innermost first; nothing if it is not open."""
        while self.names[name]:
            top, value = self.stack.pop()
            self.names[top] -= 1
            yield value
            if top == name:
                break


class Rates:
    """How often each tag, and the words in each container, lie in content."""

    def __init__(self):
        self.inside = defaultdict(float)
        self.total = defaultdict(float)

    def add(self, page: tuple[str, str, str]) -> None:
        held, active = Open(), Counter()
        for part, text in enumerate(page):
            for kind, name, keys in tokens(text):
                if kind == "text":
                    n = min(len(name.split()), MOST)
                    for key in [k for k, times in active.items() if times] if n else ():
                        self._count(f"words {key}", n, part == 1)
                    continue
                self._count(f"{kind} {name}", 1, part == 1)
                if kind == "open" and name in CONTAINERS:
                    held.push(name, keys)
                    active.update(keys)
                elif kind == "close":
                    for gone in held.close(name):
                        active.subtract(gone)

    def _count(self, key: str, n: float, inside: bool) -> None:
        if n:
            self.total[key] += n
            self.inside[key] += n * inside

    def table(self) -> dict[str, float]:
        out = {k: (self.inside[k] + 0.05) / (self.total[k] + 0.1) for k in self.total}
        for key in ("html", "body", "div", "section"):  # they hold all kinds of things, and say nothing by name
            out[f"words {key}"] = 1.0
        for kind in ("open", "close"):  # where content may begin or end
            for name in ("article", "main"):
                out[f"{kind} {name}"] = 0.0
        return out


def labelled_by_article(page: str) -> tuple[str, str, str] | None:
    """The page cut at its article element, if it has exactly one."""
    spans = [(start, end, kind) for start, end, kind, name, _ in tags(page) if name == "article"]
    if len(spans) != 2 or [kind for *_, kind in spans] != ["open", "close"]:
        return None
    return page[: spans[0][1]], page[spans[0][1] : spans[1][0]], page[spans[1][0] :]


def fit(pages: DataFrame, limit: int = SAMPLE) -> dict[str, float]:
    """Rates from LABELLED and at most ``limit`` pages of the table, chosen by
    hash of the id; only they come to the driver."""
    rates = Rates()
    for _ in range(8):  # as much as a few pages of the table each
        for page in LABELLED:
            rates.add(page)
    marked = pages.where(F.col("html").rlike("(?i)<article[\\s>]"))
    for row in marked.select("page_id", "html").orderBy(F.xxhash64("page_id"), "page_id", "html").limit(limit).toLocalIterator():
        if cut := labelled_by_article(row["html"]):
            rates.add(cut)
    return rates.table()


def main_text(page: str | None, rates: dict[str, float]) -> str:
    """The text of the region of the highest score."""
    if not page:
        return ""
    pieces: list[tuple[str, bool]] = []  # (text or space, counted)
    best, best_from, best_to = 0.0, 0, 0
    total, start = 0.0, 0
    held = Open()
    rate = 1.0
    for kind, name, keys in tokens(page):
        if kind == "text":
            n = len(name.split())
            if n:
                total += n * max(FLOOR, rate)
            pieces.append((name, rate >= 0.5))
            if n and total > best:
                best, best_from, best_to = total, start, len(pieces)
            continue
        own = rates.get(f"{kind} {name}", 0.5 if name not in INLINE else 0.9)
        total -= TAG + (LINK if name in INLINE else BORDER) * (1 - own) ** 2
        if name not in INLINE:
            pieces.append((" ", True))
        if total <= 0:
            total, start = 0.0, len(pieces)
        if kind == "open" and name in CONTAINERS:
            held.push(name, rate)
            rate = min([rate, *(rates.get(f"words {k}", 1.0) for k in keys)])
        elif kind == "close":
            for rate in held.close(name):
                pass
    # the text outside counted containers, each text decoded by itself
    return " ".join("".join(html.unescape(t) if "&" in t else t for t, counted in pieces[best_from:best_to] if counted).split())


def extract(pages: DataFrame, rates: dict[str, float]) -> DataFrame:
    """page_id, url, text, n_chars per row of pages (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                texts = [main_text(x.as_py(), rates) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], dtype=np.int64))], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", "html")
    return rows.mapInArrow(run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
