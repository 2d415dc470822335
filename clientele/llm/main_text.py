"""Main-text extraction from web pages (operator 11).

Pages become sequences of leaf blocks; a recurrent labeller keeps those of the
article.  It learns from a bounded sample of pages whose markup names their
article, and from the sample's texts laid out anew in many other ways.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.block_labeller import Labeller, Page
from clientele.llm.common import map_batches, small_batches
from clientele.llm.html_leaves import Leaf, leaves

#: Words in a path that name something other than the article, wherever it stands.
OTHER = frozenset(
    "nav menu header footer aside sidebar form comments comment ad ads advert promo sponsor banner cookie notice"
    " breadcrumb related share widget".split()
)
ARTICLE = frozenset({"article", "main"})


def markup_labels(found: list[Leaf]) -> np.ndarray | None:
    """1 for leaves inside ``<article>`` or ``<main>`` but not in a part that names something else.

    None if no leaf is inside: such a page tells nothing.
    """
    inside = [not ARTICLE.isdisjoint(leaf.path) for leaf in found]
    if not any(inside):
        return None
    named = [any(t.lstrip(".") in OTHER for t in leaf.path) for leaf in found]
    return np.array([i and not o for i, o in zip(inside, named, strict=True)], np.float32)


# -- layouts to learn from -----------------------------------------------------

#: Stands before the texts of the article in a layout made for training.
MARK = "\ue000"
_WRAPS = [
    "article", "main", 'div id="content"', 'div class="post-content"', 'div class="entry"', 'section class="story"',
    'div class="article-body"', 'div itemprop="articleBody"', 'div role="main"', "td", "div", "section",
]
_MENUS = ["nav", 'div class="menu"', 'div id="navigation"', 'ul class="nav-links"', 'div role="navigation"', 'div class="breadcrumb"']
_HEADERS = ["header", 'div class="header"', 'div id="masthead"', 'div class="top-bar"', 'div role="banner"']
_NOTICES = [
    'div class="notice"', 'div class="cookie-banner"', 'div id="cookies"', 'div class="alert"', 'div role="alert"',
    'p class="notice"', 'div class="newsletter"', "dialog", "noscript",
]
_ADVERTS = [
    'div class="ad"', 'div class="advert"', 'div class="ads"', 'div class="promo"', 'aside class="sponsor"',
    'div class="sponsored"', 'div id="ad-top"', 'div class="advertisement"', 'p class="ad"',
]
_SIDES = ["aside", 'div class="sidebar"', 'div id="sidebar"', 'div class="widget"', 'div class="related"', 'section class="related-posts"']
_COMMENTS = ['div class="comments"', 'section id="comments"', 'ol class="comment-list"', 'div class="comment"', 'div id="disqus_thread"', 'section class="comments"']
_FOOTERS = ["footer", 'div class="footer"', 'div id="footer"', 'div class="copyright"', 'div class="site-info"', 'div role="contentinfo"']


class _Layout:
    """One page laid out from lines of text; ``words`` gives menus their entries."""

    def __init__(self, r: random.Random, lines: list[str]):
        self.r, self.lines = r, lines

    def line(self) -> str:
        return escape(self.r.choice(self.lines))

    def short(self) -> str:
        words = self.r.choice(self.lines).split()
        at = self.r.randrange(len(words))
        return escape(" ".join(words[at : at + self.r.randint(1, 3)]))

    def wrap(self, tag: str, inner: str) -> str:
        return f"<{tag}>{inner}</{tag.split()[0]}>"

    def links(self) -> str:
        entries = [f'<a href="/x">{self.short()}</a>' for _ in range(self.r.randint(1, 8))]
        style = self.r.randrange(3)
        if style == 0:
            return "<ul>" + "".join(f"<li>{e}</li>" for e in entries) + "</ul>"
        return " ".join(entries) if style == 1 else "".join(f"<div>{e}</div>" for e in entries)

    def prose(self, most: int = 3) -> str:
        tag = self.r.choice(["p", "p", "div", "li", ""])
        some = [self.line() if self.r.random() < 0.7 else self.short() for _ in range(self.r.randint(1, most))]
        return "".join(self.wrap(tag, s) for s in some) if tag else some[0]

    def form(self) -> str:
        fields = "".join(f"<label>{self.short()}</label><input><p>{self.short()}</p>" for _ in range(self.r.randint(1, 3)))
        return f"<form>{fields}<button>{self.short()}</button><textarea>{self.short()}</textarea></form>"

    def comments(self) -> str:
        one = lambda: f"<h4>{self.short()}</h4><p>{self.line()}</p>" if self.r.random() < 0.5 else f"<p>{self.line()}</p>"
        inner = "".join(self.wrap(self.r.choice(["div", "li", 'li class="comment"', "article"]), one()) for _ in range(self.r.randint(1, 4)))
        title = f"<h3>{self.short()}</h3>" if self.r.random() < 0.5 else ""
        return self.wrap(self.r.choice(_COMMENTS), title + inner)

    def other(self, kinds: str) -> str:
        kind = self.r.choice(kinds)
        if kind == "m":
            return self.wrap(self.r.choice(_MENUS), self.links())
        if kind == "h":
            return self.wrap(self.r.choice(_HEADERS), self.r.choice([f"<h1>{self.short()}</h1>", f"<p>{self.line()}</p>", self.links()]))
        if kind == "s":
            return self.wrap(self.r.choice(_SIDES), f"<h3>{self.short()}</h3>" + self.r.choice([self.links(), self.prose()]))
        if kind == "f":
            return self.form()
        if kind == "c":
            return self.comments()
        return self.wrap(self.r.choice(_NOTICES if kind == "n" else _ADVERTS), self.prose(2))

    def piece(self) -> str:
        """One block of the article or more."""
        kind = self.r.random()
        if kind < 0.65:
            lead = self.r.choice(["", "", "", "<b>", "<i>", '<a href="/y">'])
            end = {"<b>": "<br>", "<i>": "</i>", '<a href="/y">': "</a>"}.get(lead, "")
            return f"<p>{lead}{MARK}{self.line()}{end}" + self.r.choice(["</p>", "</p>", ""])
        if kind < 0.75:
            return self.wrap(self.r.choice(["h2", "h3"]), MARK + self.short())
        if kind < 0.83:
            return self.wrap(self.r.choice(["ul", "ol"]), "".join(f"<li>{MARK}{self.line()}</li>" for _ in range(self.r.randint(1, 4))))
        if kind < 0.9:
            return f"<blockquote><p>{MARK}{self.line()}</p></blockquote>"
        if kind < 0.95:
            return f"<table><tr><td>{MARK}{self.short()}</td><td>{MARK}{self.line()}</td></tr></table>"
        return f"<figure><figcaption>{MARK}{self.line()}</figcaption></figure>" if kind < 0.98 else f"<pre>{MARK}{self.line()}</pre>"

    def page(self) -> str:
        r = self.r
        before = [self.other("mmhhnnaasf") for _ in range(r.randint(0, 5))]
        after = [self.other("ssnaafcccm") for _ in range(r.randint(0, 4))]
        if r.random() < 0.8:
            after.append(self.wrap(r.choice(_FOOTERS), r.choice([f"&copy; {self.short()} &middot; {self.line()}", f"<p>{self.line()}</p>", self.links()])))
        pieces = [f"<h1>{MARK}{self.short() if r.random() < 0.3 else self.line()}</h1>"] if r.random() < 0.8 else []
        for _ in range(r.randint(1, 12)):
            pieces.append(self.piece())
            if r.random() < 0.08:
                pieces.append(self.other("nafsc"))
        article = self.wrap(r.choice(_WRAPS), "".join(pieces))
        if r.random() < 0.3:
            article = self.wrap(r.choice(["div", 'div id="wrapper"', 'div class="container"', "section"]), article)
        return "<html><body>" + "".join(before) + article + "".join(after) + r.choice(["</body></html>", ""])


def layouts(lines: list[str], n: int, seed: int) -> Iterator[tuple[list[Leaf], np.ndarray]]:
    """``n`` pages made of ``lines``: their leaves and which belong to the article."""
    made = _Layout(random.Random(seed), lines)
    for _ in range(n):
        found = list(leaves(made.page()))
        marked = np.array([MARK in leaf.text for leaf in found], np.float32)
        yield [Leaf(x.path, x.text.replace(MARK, ""), x.linked) for x in found], marked


#: Lines to lay out where the sample has no text.
PLAIN = ["Some words stand here, and a few more follow them.", "Short line", "One more sentence that ends with a stop."]


def learn(sample: list[str], n_layouts: int = 1200, hidden: int = 24, epochs: int = 10, seed: int = 7) -> Labeller:
    """A labeller from pages of the sample that name their article, and from layouts of the sample's lines."""
    parsed = [list(leaves(page)) for page in sample]
    lines = sorted({x for found in parsed for leaf in found if (x := leaf.text[:1000].replace(MARK, "").strip())}) or PLAIN
    pairs = [(f, y) for f in parsed if f and (y := markup_labels(f)) is not None and len(f) <= 400]
    pairs += layouts(lines, n_layouts, seed)
    labeller = Labeller.fresh(hidden, seed)
    labeller.fit([Page(f) for f, _ in pairs], [y for _, y in pairs], epochs, seed)
    return labeller


def sample_pages(pages: DataFrame, max_pages: int, max_chars: int) -> DataFrame:
    """Up to ``max_pages`` different pages of at most ``max_chars`` characters: the least hash of each hash class.

    Only ``max_pages`` hashes reach the driver.
    """
    hashed = pages.where(F.char_length("html") <= max_chars).select("html", F.xxhash64("html").alias("h"))
    least = hashed.groupBy(F.pmod("h", F.lit(max_pages)).alias("k")).agg(F.min("h").alias("h"))
    wanted = [r.h for r in least.collect()]
    return hashed.where(F.col("h").isin(wanted)).dropDuplicates(["h"]).orderBy("h").limit(max_pages)


def train(pages: DataFrame, max_pages: int = 200, max_chars: int = 50_000) -> Labeller:
    """The labeller learned in one task from a bounded sample (``max_pages`` pages of ``max_chars`` characters at most).

    The weights, about 200 kB, come to the driver.
    """
    small_batches(pages.sparkSession)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = learn([h for b in batches for h in b.column(0).to_pylist()]).weights
        rows = [(k, list(v.shape), v.tobytes()) for k, v in weights.items()]
        yield pa.RecordBatch.from_pydict({c: [r[i] for r in rows] for i, c in enumerate(("name", "shape", "value"))})

    found = sample_pages(pages, max_pages, max_chars).select("html").coalesce(1)
    rows = found.mapInArrow(fit, "name string, shape array<long>, value binary").collect()
    return Labeller({r.name: np.frombuffer(bytes(r.value), np.float32).reshape(r["shape"]) for r in rows})


def extract(pages: DataFrame, labeller: Labeller) -> DataFrame:
    """One row a page: page_id, url, text, n_chars (code points).

    ``text`` joins the blocks that the labeller takes for the article by line
    ends, in page order, whole; it is empty for null, empty and textless pages
    and where no block is taken.  Repeated pages and null identifiers are pages
    like any other; columns but page_id, url and html are ignored.
    """

    def run(columns: list[list]) -> list[list]:
        found = [list(leaves(page)) for page in columns[2]]
        chosen = labeller.probabilities([Page(f) for f in found])
        texts = ["\n".join(x.text for x, p in zip(f, ps, strict=True) if p >= 0.5) for f, ps in zip(found, chosen, strict=True)]
        return [columns[0], columns[1], texts, [len(t) for t in texts]]

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return map_batches(source, run, "page_id long, url string, text string, n_chars long")


def main_text(pages: DataFrame, **bounds: int) -> DataFrame:
    """Learn from a bounded sample of ``pages``, label the blocks of all."""
    return extract(pages, train(pages, **bounds))
