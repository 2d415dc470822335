"""Licence scans by template automata (operator 1).

A template is compiled to a token automaton: mandatory words are single steps,
optional regions are steps that may be jumped over, replaceable regions accept
any words within their bounds.  The automaton runs from every place where its
first word can stand and reports the longest accepted run of words.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import ALNUM_ONLY, map_batches
from clientele.llm.license_templates import BASE, TEMPLATES

_MARK = re.compile(r"\[\[|\]\]|\{\{(\d+)\.\.(\d+)\}\}")


class Template:
    """Token automaton of one template; states are sets of steps, as bits of an integer."""

    def __init__(self, markup: str, label: str):
        self.label, self.words = label, []  # a step's word; None accepts any
        jumps: dict[int, list[int]] = {}
        open_at: list[int] = []
        for token in re.sub(r"(\[\[|\]\]|\{\{\d+\.\.\d+\}\})", r" \1 ", markup).split():
            mark = _MARK.fullmatch(token)
            if token == "[[":
                open_at.append(len(self.words))
            elif token == "]]":
                if not open_at:
                    raise ValueError(f"']]' without '[[' in template {label}")
                jumps.setdefault(open_at.pop(), []).append(len(self.words))
            elif mark:
                least, most = int(mark[1]), int(mark[2])
                if most < max(least, 1):
                    raise ValueError(f"bounds {token} in template {label}")
                self.words += [None] * least
                end = len(self.words) + most - least
                for _ in range(most - least):
                    jumps.setdefault(len(self.words), []).append(end)
                    self.words.append(None)
            else:
                self.words += token.encode().translate(ALNUM_ONLY).split()
        if open_at:
            raise ValueError(f"'[[' without ']]' in template {label}")
        end = len(self.words)
        reach = [1 << i for i in range(end + 1)]  # steps open at i, jumps included
        for i in range(end, -1, -1):
            for j in jumps.get(i, ()):
                reach[i] |= reach[j]
        self.accepting, self.start = 1 << end, reach[0]
        if self.start & self.accepting:
            raise ValueError(f"template {label} has no mandatory words")
        #: state -> {word: next state}; filled as states are met
        self.next: dict[int, tuple[dict[bytes, int], int]] = {}
        self.reach = reach
        self.first_words = {self.words[i] for i in range(end) if self.start >> i & 1}
        if None in self.first_words:
            raise ValueError(f"template {label} must begin with a word")

    def _moves(self, state: int) -> tuple[dict[bytes, int], int]:
        moves = self.next.get(state)
        if moves is None:
            by_word: dict[bytes, int] = {}
            any_word = 0
            for i, word in enumerate(self.words):
                if state >> i & 1:
                    if word is None:
                        any_word |= self.reach[i + 1]
                    else:
                        by_word[word] = by_word.get(word, 0) | self.reach[i + 1]
            moves = self.next[state] = ({w: s | any_word for w, s in by_word.items()}, any_word)
        return moves

    def longest(self, tokens: list[bytes], at: int) -> int:
        """Words in the longest accepted run that begins at ``at``; 0 if none."""
        state, best = self.start, 0
        for i in range(at, len(tokens)):
            by_word, any_word = self._moves(state)
            state = by_word.get(tokens[i], any_word)
            if not state:
                break
            if state & self.accepting:
                best = i + 1 - at
        return best


class Scanner:
    """All templates, by the words they can begin with."""

    def __init__(self, templates: Iterable[tuple[str, str]]):
        self.starts: dict[bytes, list[Template]] = {}
        for markup, label in templates:
            t = Template(markup, label)
            for word in t.first_words:
                self.starts.setdefault(word, []).append(t)

    def spans(self, tokens: list[bytes]) -> list[tuple[int, int, str]]:
        """(first word, words, label) of every accepted run, the longest at each place."""
        starts = self.starts
        return [
            (i, n, t.label)
            for i, word in enumerate(tokens)
            if word in starts
            for t in starts[word]
            if (n := t.longest(tokens, i))
        ]


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<first:long,words:long,label:string>>"
)


def license_scan(
    docs: DataFrame, base: dict[str, str] | None = None, templates: dict[str, tuple[str, ...]] | None = None
) -> DataFrame:
    """One row a document: accepted licence wording, with spans in words.

    ``base`` phrases (template -> label) are counted apart from ``templates``
    (label -> markup).  ``score`` is the share of the document's words that
    stand in accepted runs, base phrases included.  A null or empty text has
    no words: counts 0, labels empty, first_word and last_word null, score 0.
    Rows with equal or null doc_id are judged each on its own; other columns
    are ignored.  Memory in a task follows the longest text.
    """
    base = BASE if base is None else base
    templates = TEMPLATES if templates is None else templates
    base_scan = Scanner(base.items())
    more_scan = Scanner((m, label) for label, markups in templates.items() for m in markups)

    def scan(columns: list[list]) -> list[list]:
        out: list[list] = [[] for _ in range(9)]
        for doc_id, text in zip(*columns, strict=True):
            tokens = (text or "").encode().translate(ALNUM_ONLY).split()
            found, more = base_scan.spans(tokens), more_scan.spans(tokens)
            covered: set[int] = set()
            for first, n, _ in found + more:
                covered.update(range(first, first + n))
            own = {label for _, _, label in found}
            row = (
                doc_id,
                len(tokens),
                len(found),
                min((s[0] for s in found), default=None),
                max((s[0] for s in found), default=None),
                ",".join(sorted(own)),
                ",".join(sorted(own | {label for _, _, label in more})),
                len(covered) / len(tokens) if tokens else 0.0,
                [{"first": f, "words": n, "label": label} for f, n, label in sorted(found + more)],
            )
            for column, value in zip(out, row, strict=True):
                column.append(value)
        return out

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), scan, SCHEMA)
