"""Spelling variant grouping (operator 13).

Words one edit apart are found by scanning sorted lists: the rows of a banded
edit matrix are kept for the prefix that a word shares with the one before it,
and a range of words whose shared prefix is already two edits away is skipped.
The lists are blocks of the vocabulary: of two words one edit apart, everything
before and behind a window that holds the edit is equal.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import LOWER_ASCII, cut, small_batches

#: Words whose counts a task holds before it sends them on.
HELD = 300_000
#: Links sent on in one Arrow batch.
ROWS_OUT = 20_000


def document_words(doc_id: int | None, text: str | None, min_chars: int, slip: int) -> Counter[str]:
    """The words of a document with their numbers; a null doc_id counts as empty text.

    Runs of letters, A-Z lower-cased.  Where ``slip`` divides the checksum of
    "doc_id:run", one code point is left out: the place is the checksum modulo
    the run's length.  Words of fewer than ``min_chars`` code points are dropped.
    """
    lowered = (text or "").encode().translate(LOWER_ASCII).decode()
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter[str] = Counter()
    for word, n in Counter(re.findall(f"[a-zÀ-ÿ]{{{min_chars},}}", lowered)).items():
        h = zlib.crc32(word.encode(), seed)
        if h % slip == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < min_chars:
                continue
        out[word] += n
    return out


def vocabulary(docs: DataFrame, min_chars: int = 5, min_count: int = 3, slip: int = 97) -> DataFrame:
    """(word, n) over all documents, counted in the tasks before the shuffle."""
    small_batches(docs.sparkSession)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts.update(document_words(doc_id, text, min_chars, slip))
                if len(counts) > HELD:
                    yield _counted(counts)
                    counts.clear()
        yield _counted(counts)

    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tally, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _counted(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
    )


# -- blocks ------------------------------------------------------------------

BLOCK = ("size", "lo", "hi", "shared")


def _with_core(rows: DataFrame) -> DataFrame:
    """Rows of (word, n, size, lo, hi) with what lies outside their window, and what lies inside."""
    behind = F.col("size") - F.col("hi")  # code points behind the window
    length = F.char_length("word")
    return rows.select(
        "size", "lo", "hi",
        F.concat(F.substring("word", F.lit(1), F.col("lo")), F.lit(" "), F.substring("word", length - behind + 1, behind))
        .alias("shared"),
        F.substring("word", F.col("lo") + 1, length - F.col("lo") - behind).alias("core"), "word", "n",
    )


def _windows(rows: DataFrame) -> DataFrame:
    """Each row's window [lo, hi) in two halves."""
    middle = F.expr("lo + (hi - lo) div 2")
    halves = F.array(
        F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi"))
    )
    return rows.select("word", "n", "size", F.explode(halves).alias("w")).select(
        "word", "n", "size", F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi")
    )


def blocks(words: DataFrame, min_chars: int, most: int) -> DataFrame:
    """The vocabulary dealt into blocks (size, lo, hi, shared) that hold every pair of near words.

    A pair's ``size`` is the length of its shorter word, so a word goes to the
    blocks of its own length and of one less.  A block's words agree before code
    point ``lo`` and from ``hi`` on (of the shorter word); a pair belongs to the
    block whose window holds the first place where the two differ.  Blocks of
    more than ``most`` words are dealt anew by the halves of their window, until
    a window is one code point: then the alphabet bounds a block.  Every row
    goes on; each round only touches the rows of too large blocks.
    """
    length = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("size"))
    rows = rows.where(F.col("size") >= min_chars).withColumns({"lo": F.lit(0), "hi": F.col("size")})
    done = []
    while True:
        dealt = cut(_with_core(_windows(rows)))
        large = dealt.groupBy(*BLOCK).count().where((F.col("count") > most) & (F.col("hi") - F.col("lo") > 1))
        large = cut(large.select(*BLOCK))
        if large.isEmpty():
            return _union([*done, dealt])
        done.append(dealt.join(large, [*BLOCK], "left_anti"))
        rows = dealt.join(large, [*BLOCK], "left_semi").select("word", "n", "size", "lo", "hi")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# -- the scan ----------------------------------------------------------------

#: (e(i, i - 1), e(i, i), e(i, i + 1)) of the edit matrix, row i: i letters of the list's word, capped at 2.
START = (2, 0, 1)


def next_row(row: tuple[int, int, int], i: int, letter: str, query: str) -> tuple[int, int, int] | None:
    """Row i + 1 from row i, for one more letter; None if all of it exceeds one edit."""
    under, same, over = row
    n = len(query)
    a = min(under + (letter != query[i - 1]) if 0 < i <= n else 2, same + 1) if i <= n else 2
    b = min(same + (letter != query[i]), over + 1, a + 1) if i < n else 2
    c = min(over + (letter != query[i + 1]), b + 1) if i + 1 < n else 2
    return (a, b, c) if min(a, b, c) < 2 else None


def common_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def near_in_list(words: list[str], queries: list[str]) -> Iterator[tuple[int, int]]:
    """(i, j): queries[i] and words[j] are exactly one edit apart.  ``words`` is sorted by code points.

    ``live[d]`` holds the matrix rows, of queries not yet beyond one edit, after
    d letters of the current word; the next word takes up those of the prefix
    it shares.  Where no query is left after d letters, all words that share
    these d letters are skipped.
    """
    live: list[list[tuple[int, tuple[int, int, int]]]] = [[(i, START) for i in range(len(queries))]]
    before, dead = "", None
    for j, word in enumerate(words):
        shared = common_prefix(before, word)
        before = word
        if dead is not None and shared >= dead:
            continue
        dead = None
        del live[shared + 1 :]
        for d in range(len(live) - 1, len(word)):
            letter = word[d]
            rows = [(i, r) for i, row in live[d] if (r := next_row(row, d, letter, queries[i])) is not None]
            live.append(rows)
            if not rows:
                dead = d + 1
                break
        else:
            for i, row in live[len(word)]:
                gap = len(queries[i]) - len(word)
                if -1 <= gap <= 1 and row[gap + 1] == 1:
                    yield i, j


def _in_window(a: str, b: str, lo: int, hi: int, size: int) -> bool:
    at = common_prefix(a, b)
    return lo <= at and (at < hi or hi == size)


def near_words(words: DataFrame, min_chars: int = 5, most: int = 500) -> DataFrame:
    """(word, n, near, near_n) for all words and the words exactly one edit away, each pair both ways, once."""
    small_batches(words.sparkSession)
    dealt = blocks(words, min_chars, most).repartition(*BLOCK).sortWithinPartitions(*BLOCK, "core")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        out = []
        for (size, lo, hi, _), members in groupby(rows, key=lambda r: r[:4]):
            block = list(members)  # bounded: see blocks()
            if len(block) < 2:
                continue
            shorter = [r for r in block if len(r[5]) == size]
            for i, j in near_in_list([r[4] for r in block], [r[4] for r in shorter]):
                (a, n), (b, m) = shorter[i][5:], block[j][5:]
                if _in_window(a, b, lo, hi, size):
                    out.append((a, n, b, m))
                    if len(b) > size:
                        out.append((b, m, a, n))
            if len(out) >= ROWS_OUT:
                yield _links(out)
                out = []
        yield _links(out)

    return dealt.mapInArrow(scan, "word string, n long, near string, near_n long")


def _links(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["word", "n", "near", "near_n"]
    )


# -- forms and roots ---------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: forms followed to the last, by pointer doubling.

    A form is at least twice as frequent as its word, so paths are no longer
    than the logarithm of the largest count, and rounds than its logarithm.
    Words that have arrived leave the rounds.
    """
    steps = cut(forms.select("word", F.col("form").alias("root")))
    active, arrived = steps, []
    while True:
        joined = cut(
            active.alias("at").join(steps.alias("on"), F.col("at.root") == F.col("on.word"), "left")
            .select(F.col("at.word").alias("word"), F.coalesce("on.root", "at.root").alias("root"),
                    F.col("on.word").isNull().alias("there"))
        )
        arrived.append(joined.where("there").select("word", "root"))
        active = joined.where("not there").select("word", "root")
        steps = _union([*arrived, active])
        if active.isEmpty():
            return steps


def spelling_variants(
    docs: DataFrame, min_chars: int = 5, min_count: int = 3, ratio: int = 2, slip: int = 97, most: int = 500
) -> DataFrame:
    """One row a word: its form, the root of its forms, counts and the number of near words.

    A word's form is its most frequent near word (ties: the smallest in
    code-point order) if that is at least ``ratio`` (2 or more) times as
    frequent.  Null and empty texts have no words; repeated rows count each; a
    null doc_id takes part as empty text; other columns are ignored.
    """
    words = cut(vocabulary(docs, min_chars, min_count, slip))
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))
    near = near_words(words, min_chars, most).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.minus") >= ratio * F.col("n")
    rows = cut(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n"),
        )
    )
    ends = roots(rows.where("form is not null"))
    return rows.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
