"""Leaf blocks of a web page: runs of text between block elements, with their tag path."""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

# Element names of HTML, by what they do to the text around them.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol"
    " optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
NOT_P = BLOCK - {"p"}
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
#: Their content is no text of the page.
RAW = frozenset("iframe noembed noframes script style svg math template textarea title xmp".split())
#: Elements that end an open one of the same kind: (those ended, those that keep it open).
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "body": (("head",), ()), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}

_VALUE = r"""=\s*(?:"[^"]*"|'[^']*')"""
_MARKUP = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:{_VALUE}|[^>])*?)>", re.DOTALL)
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
#: Path elements that a leaf reports: as many of the outermost and of the innermost.
REPORTED = 8


@dataclass(frozen=True, slots=True)
class Leaf:
    path: tuple[str, ...]  # tags and, with a dot, the words of class, id, role and itemprop
    text: str  # references decoded, white space one space, trimmed; never empty
    linked: int  # characters inside links, before trimming


def _tokens(tag: str, attributes: str) -> tuple[str, ...]:
    found = []
    if "=" in attributes:
        for groups in _NAMES.findall(attributes):
            spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(groups))
            found += ["." + w for w in _WORD.findall(spaced.lower())]
    return (tag, *found)


class _Open:
    """The open elements."""

    def __init__(self):
        self.tags: list[str] = []
        self.tokens: list[tuple[str, ...]] = []
        self.count: Counter[str] = Counter()

    def push(self, tag: str, tokens: tuple[str, ...]) -> None:
        self.tags.append(tag)
        self.tokens.append(tokens)
        self.count[tag] += 1

    def pop_to(self, at: int) -> None:
        for tag in self.tags[at:]:
            self.count[tag] -= 1
        del self.tags[at:], self.tokens[at:]

    def close(self, tags: tuple[str, ...], stop: tuple[str, ...] | frozenset[str]) -> None:
        """Close the innermost of ``tags``, unless one of ``stop`` lies inside it."""
        if not any(self.count[t] > 0 for t in tags):
            return
        for at in range(len(self.tags) - 1, -1, -1):
            if self.tags[at] in tags:
                self.pop_to(at)
                return
            if self.tags[at] in stop:
                return

    def path(self) -> tuple[str, ...]:
        near = self.tokens if len(self.tokens) <= 2 * REPORTED else self.tokens[:REPORTED] + self.tokens[-REPORTED:]
        return tuple(t for tokens in near for t in tokens)


def leaves(page: str | None) -> Iterator[Leaf]:
    """The leaf blocks of a page in order; null and empty pages have none.

    Markup that isn't closed goes on to the end of the page; end tags without a
    start are ignored; ``<br>`` is white space.  Text outside any element, or in
    unknown ones, is text.
    """
    page = page or ""
    marked = page.rfind(">") + 1  # behind it no tag can end
    open_, parts, linked, at = _Open(), [], 0, 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            linked += len(text) if open_.count["a"] > 0 else 0

    def flush() -> Iterator[Leaf]:
        nonlocal linked
        if parts:
            text = "".join(parts)
            text = " ".join((references.unescape(text) if "&" in text else text).split())
            if text:
                yield Leaf(open_.path(), text, linked)
            parts.clear()
        linked = 0

    while at < len(page):
        start = page.find("<", at)
        found = _MARKUP.match(page, start, len(page) if page.startswith("<!--", start) else marked) if start >= 0 else None
        if found is None:
            end = len(page) if start < 0 or start >= marked else start + 1
            add(page[at:end])
            at = end
            continue
        add(page[at:start])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if tag in RAW:
            if not found[1]:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCK:
            yield from flush()
            if found[1]:
                open_.close((tag,), ())
            else:
                open_.close(("p",), NOT_P)
                if tag in ENDS:
                    open_.close(*ENDS[tag])
                if tag not in VOID:
                    open_.push(tag, _tokens(tag, found[3]))
        elif found[1]:
            open_.close((tag,), BLOCK)
        elif tag not in VOID and not found[3].endswith("/"):
            open_.push(tag, _tokens(tag, found[3]))
    yield from flush()
