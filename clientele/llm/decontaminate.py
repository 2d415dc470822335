"""Benchmark decontamination by pigeonhole edit matching (operator 4).

An item of m characters may differ by an error budget of k edits.  Cut into
k + 1 pieces, at least one piece must appear unchanged.  All pieces are searched
at once; around every piece hit the item is verified with Myers' bit-parallel
edit distance.  Short items have no budget: they must appear unchanged, as whole
words.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from clientele.llm.common import small_batches


def normal(text: str | None) -> str:
    """Lower case, every run of white space one blank."""
    return " ".join((text or "").lower().split())


class Pattern:
    """One item, with the masks for Myers' algorithm."""

    def __init__(self, text: str):
        self.m = len(text)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i
        self.full, self.top = (1 << self.m) - 1, 1 << (self.m - 1)

    def search(self, text: str) -> tuple[int, int]:
        """(distance, end) of the best match that may begin and end anywhere in ``text``; the first of equals."""
        plus, minus, score = self.full, 0, self.m
        best, end = score, 0
        masks, full, top = self.masks, self.full, self.top
        for i, c in enumerate(text):
            eq = masks.get(c, 0)
            vertical = eq | minus
            diagonal = ((((eq & plus) + plus) ^ plus) | eq) & full
            up = (minus | ~(diagonal | plus)) & full
            down = plus & diagonal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            if score < best:
                best, end = score, i + 1
            up, down = (up << 1) & full, (down << 1) & full
            plus = (down | ~(vertical | up)) & full
            minus = up & vertical
        return best, end


class Matcher:
    """A block of items against any number of texts."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float, min_chars: int):
        self.items, self.pieces, self.min_chars = [], ahocorasick.Automaton(), min_chars
        at: dict[str, list[tuple[int, int]]] = {}
        for item_id, raw in items:
            text = normal(raw)
            if not text:
                continue
            k = int(len(text) * error_rate) if len(text) >= min_chars else 0
            n = len(self.items)
            self.items.append((item_id, k, Pattern(text), Pattern(text[::-1])))
            cuts = [len(text) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                at.setdefault(text[a:b], []).append((n, a))
        for piece, places in at.items():
            self.pieces.add_word(piece, (len(piece), places))
        if at:
            self.pieces.make_automaton()

    def matches(self, raw: str | None) -> list[dict]:
        """Best match of every item that ``raw`` holds within its budget, by item."""
        text = normal(raw)
        if not self.items or not text:
            return []
        starts: dict[int, set[int]] = {}
        for last, (n_chars, places) in self.pieces.iter(text):
            for n, offset in places:
                starts.setdefault(n, set()).add(last + 1 - n_chars - offset)
        out = []
        for n, found in starts.items():
            item_id, k, forward, backward = self.items[n]
            best = None
            if forward.m < self.min_chars:
                whole = [s for s in found if _stands_alone(text, s, s + forward.m)]
                if whole:
                    out.append({"item_id": item_id, "distance": 0, "start": min(whole), "end": min(whole) + forward.m})
                continue
            for low, high in _runs(sorted(found), 2 * k + 1):
                left = max(0, low - k)
                window = text[left : max(0, high + forward.m + k)]
                distance, end = forward.search(window)
                if distance <= k and (best is None or distance < best[0]):
                    _, length = backward.search(window[:end][::-1][: forward.m + k])
                    best = (distance, left + end - length, left + end)
            if best:
                out.append({"item_id": item_id, "distance": best[0], "start": best[1], "end": best[2]})
        return sorted(out, key=lambda x: (x["item_id"] is None, x["item_id"], x["start"]))


def _stands_alone(text: str, start: int, end: int) -> bool:
    """Neither end of the part cuts a word of letters and digits."""
    return not (
        (start > 0 and text[start - 1].isalnum() and text[start].isalnum())
        or (end < len(text) and text[end - 1].isalnum() and text[end].isalnum())
    )


def _runs(starts: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """First and last of each run of starts whose windows overlap by their slack."""
    low = high = starts[0]
    for s in starts[1:]:
        if s - high > gap:
            yield low, high
            low = s
        high = s
    yield low, high


MATCHES = "matches array<struct<item_id:long,distance:long,start:long,end:long>>"


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of ``block_chars`` characters (or one longer item)."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        if block and size + len(r.text) > block_chars:
            yield block
            block, size = [], 0
        block.append((r.item_id, r.text))
        size += len(r.text)
    if block:
        yield block


def match_items(
    docs: DataFrame, benchmark: DataFrame, carry: tuple[str, ...] = (),
    error_rate: float = 0.06, min_chars: int = 40, block_chars: int = 2_000_000,
) -> DataFrame:
    """One row a document: doc_id, ``matches``, and the ``carry`` columns in a struct ``carried``.

    A match is an item whose normalised text (lower case, white space as one
    blank) appears anywhere in the document's within floor(error_rate * length)
    edits; ``start`` and ``end`` count characters of the normalised document.
    Of several places of one item the nearest counts, then the first.  Items of
    fewer than ``min_chars`` characters match only unchanged and as whole words
    (with edits, or inside a word, they would match by chance); null and blank
    ones match nothing; a null or empty document has no matches.  The items are a query set: blocks of at most
    ``block_chars`` characters are held against all documents, one pass a block.
    """
    small_batches(docs.sparkSession)
    frame = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        *([F.struct(*carry).alias("carried")] if carry else []),
        F.array().cast("array<struct<item_id:long,distance:long,start:long,end:long>>").alias("matches"),
    )
    schema = StructType([StructField(f.name, f.dataType) for f in frame.schema.fields])
    names = to_arrow_schema(schema).names
    match_type = to_arrow_schema(schema).field("matches").type

    def scan(items: list[tuple[int, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items, error_rate, min_chars)
            for batch in batches:
                found = [
                    old + matcher.matches(text)
                    for text, old in zip(batch.column(1).to_pylist(), batch.column(len(names) - 1).to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, match_type)], names=names)

        return run

    for items in _blocks(benchmark, block_chars):
        frame = frame.mapInArrow(scan(items), schema)
    return frame.drop("text")


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """One row for every document and item that match: doc_id, item_id, distance, start, end."""
    found = match_items(docs, benchmark, **params)
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def decontaminated(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The documents, all columns as they were, that match no item."""
    found = match_items(docs, benchmark, carry=tuple(docs.columns), **params)
    return found.where(F.size("matches") == 0).select("carried.*")
