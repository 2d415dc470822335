"""Quality rules by distribution divergence (operator 10).

A document's character-class and common-word histograms are compared with
language references by Jensen-Shannon distance.  The references are counted
over all documents of each language and script that pass the base rules and are
mostly letters; a document passes when it is near enough to any of them.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from clientele.llm.common import ALNUM_ONLY, cut, small_batches

SYMBOLS = "#*$%&|<>"
#: Character classes: lower, upper, digit, blank, line end, sentence marks,
#: symbols, other ASCII marks, control characters, beyond ASCII.
N_CLASSES = 10


def _class_table() -> np.ndarray:
    table = np.full(256, 9, np.uint8)
    for b in range(128):
        c = chr(b)
        table[b] = (
            0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c in " \t" else 4 if c in "\n\r"
            else 5 if c in ".,;:!?'\"()-" else 6 if c in SYMBOLS else 8 if b < 32 or b == 127 else 7
        )
    table[128:192] = N_CLASSES  # continuation bytes belong to the character before
    return table


CLASS_OF = _class_table()


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """Words in windows of ``width`` words that occur twice or more in ``words``."""
    windows = list(zip(*(words[i:] for i in range(width)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = {w for w, n in Counter(windows).items() if n > 1}
    count, end = 0, 0
    for i, w in enumerate(windows):
        if w in often:
            count += i + width - max(i, end)
            end = i + width
    return count


def base_measures(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = repeat_words(words)
    return (
        len(words),
        len(text) - sum(map(text.count, " \t\n\v\f\r")),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(words) < 10 or 100 * repeated > 20 * len(words),
    )


def class_counts(text: str) -> np.ndarray:
    """Characters in each class."""
    found = CLASS_OF[np.frombuffer(text.encode(), np.uint8)]
    return np.bincount(found, minlength=N_CLASSES + 1)[:N_CLASSES]


def one_case(classes: np.ndarray) -> np.ndarray:
    """Upper counted with lower: a clean text may hold whole sentences of capitals."""
    out = classes.copy()
    out[0], out[1] = classes[0] + classes[1], 0
    return out


def plain_words(text: str) -> list[bytes]:
    return text.encode().translate(ALNUM_ONLY).split()


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (root of the divergence in bits) of histogram p, or its rows, to each row of q."""
    p, q = p / p.sum(axis=-1, keepdims=True), q / q.sum(axis=-1, keepdims=True)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0.0).sum(axis=-1)
        right = np.where(q > 0, q * np.log2(q / m), 0.0).sum(axis=-1)
    return np.sqrt(np.maximum(0.0, (left + right) / 2))


def script_of(text: str, classes: np.ndarray | None = None) -> str | None:
    """The script of most letters (first word of their Unicode names); None if letters aren't most of the text.

    Blanks don't count.  Of equally frequent scripts the first in alphabetical order.
    """
    classes = class_counts(text) if classes is None else classes
    letters, inked = int(classes[0] + classes[1]), int(classes.sum() - classes[3] - classes[4])
    if letters >= classes[9] and 2 * letters > inked:
        return "LATIN"  # no other script can have more
    scripts: Counter[str] = Counter()
    for c, n in Counter(text).items():
        if unicodedata.category(c)[0] == "L":
            scripts[unicodedata.name(c, "UNNAMED").split()[0]] += n
    if 2 * scripts.total() <= inked:
        return None
    return min(scripts, key=lambda x: (-scripts[x], x))


def _is_word(word: bytes, max_word: int) -> bool:
    return len(word) <= max_word or len(word.decode()) <= max_word


def language_references(docs: DataFrame, top_words: int, max_word: int, max_langs: int) -> dict:
    """Per (language, script): character-class totals and the most frequent words with counts.

    Counted over every document that passes the base rules and has a script;
    those without a language count for ("", script).  Words longer than
    ``max_word`` characters aren't common words.  Counts are combined in the
    tasks before the shuffle.  Of more than ``max_langs`` references the smaller
    ones are counted together with ("", script), so that at most ``max_langs``
    and one a script, each with ``top_words`` words, reach the driver and every
    document counted has its reference.
    """
    schema = "lang string, script string, word binary, n long"
    small_batches(docs.sparkSession)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[tuple[str, str], Counter] = {}
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if base_measures(text)[-1]:
                    continue
                classes = class_counts(text)
                script = script_of(text, classes)
                if script is None:
                    continue
                counts, words = by_lang.setdefault((lang or "", script), Counter()), plain_words(text)
                counts.update(words)
                counts[b"\x00"] += 1  # documents; classes are \x01 and their number: no words look so
                for i, n in enumerate(one_case(classes).tolist()):
                    counts[b"\x01%d" % i] += n
                counts[b"\x02"] += len(words)
            rows = [(*key, w, n) for key, c in by_lang.items() for w, n in c.items() if _is_word(w, max_word)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.int64())],
                names=["lang", "script", "word", "n"],
            )

    tallied = docs.select("lang", "text").mapInArrow(tally, schema)
    counts = cut(tallied.groupBy("lang", "script", "word").agg(F.sum("n").alias("n")))
    sizes = counts.where((F.col("word") == F.lit(b"\x00")) & (F.col("lang") != ""))
    largest = sizes.orderBy(F.desc("n"), "lang", "script").limit(max_langs + 1).collect()
    if len(largest) > max_langs:
        named = docs.sparkSession.createDataFrame(
            [(r.lang, r.script, r.lang) for r in largest[:max_langs]], "lang string, script string, own string"
        )
        folded = counts.join(F.broadcast(named), ["lang", "script"], "left")  # max_langs rows
        folded = folded.select(F.coalesce("own", F.lit("")).alias("lang"), "script", "word", "n")
        counts = folded.groupBy("lang", "script", "word").agg(F.sum("n").alias("n"))
    is_mark = F.col("word") < F.lit(b"\x03")
    often = Window.partitionBy("lang", "script").orderBy(F.desc("n"), "word")
    top = counts.where(~is_mark).withColumn("r", F.row_number().over(often)).where(F.col("r") <= top_words)
    out: dict[tuple[str, str], dict] = {}
    for r in counts.where(is_mark).union(top.drop("r")).collect():
        ref = out.setdefault((r.lang, r.script), {"classes": [0] * N_CLASSES, "words": {}, "n_words": 0})
        word = bytes(r.word)
        if word == b"\x02":
            ref["n_words"] = r.n
        elif word[:1] == b"\x01":
            ref["classes"][int(word[1:])] = r.n
        elif word != b"\x00":
            ref["words"][word] = r.n
    return {key: ref for key, ref in sorted(out.items()) if ref["words"]}


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, class_distance double, word_distance double"
)


def quality_rules(
    docs: DataFrame,
    max_class_distance: float = 0.3,
    max_word_distance: float = 0.5,
    min_chars: int = 200,
    min_words: int = 50,
    top_words: int = 50,
    max_word: int = 64,
    max_langs: int = 10_000,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row a document: base measures, distances to the nearest language, verdict.

    ``kept`` is false if the base rules fail, or if the character-class distance
    to every reference exceeds ``max_class_distance`` (texts of ``min_chars``
    and more), or the common-word distance exceeds ``max_word_distance`` (texts
    of ``min_words`` and more).  Shorter texts are too short for a histogram and
    pass; their distances are null.

    References are counted for every pair of language and script, however few
    documents it has (see ``language_references``); any document is held against
    all of them.  The reference of a script's documents without a language (and
    of languages beyond the ``max_langs`` largest) mixes languages, so only these
    documents are held against it.  A document that is not mostly letters counts
    for no reference, and is judged by those of the others.  Where there is no
    reference at all, distances are null.  A null or empty text has no words, so
    it fails the base rules; an empty ``lang`` is as good as a null one.  Rows
    with a null doc_id or repeated ones are judged like any other; columns but
    doc_id, text, lang are ignored.  The columns named in ``carry`` come along
    unchanged in a struct ``carried``.
    """
    small_batches(docs.sparkSession)
    refs = language_references(docs, top_words, max_word, max_langs)
    place = {key: i for i, key in enumerate(refs)}
    shared = np.array([i for (lang, _), i in place.items() if lang], np.int64)
    classes = np.array([r["classes"] for r in refs.values()], float).reshape(len(refs), N_CLASSES)
    vocabulary = {w: i for i, w in enumerate(sorted({w for r in refs.values() for w in r["words"]}))}
    width = len(vocabulary) + 1
    # a reference's histogram: its own common words (empty places behind the last), all else in the last bin
    own = np.full((len(refs), top_words), width, np.int64)
    usual = np.zeros((len(refs), top_words + 1))
    for i, r in enumerate(refs.values()):
        own[i, : len(r["words"])] = [vocabulary[w] for w in r["words"]]
        usual[i, : len(r["words"])] = list(r["words"].values())
        usual[i, -1] = r["n_words"] - sum(r["words"].values())
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", *([F.struct(*carry).alias("carried")] if carry else [])
    )
    spark_schema = StructType([*StructType.fromDDL(SCHEMA).fields, *source.schema.fields[3:]])
    arrow_schema = to_arrow_schema(spark_schema)

    def judge(text: str | None, lang: str | None) -> tuple:
        base = base_measures(text)
        near_class = near_word = None
        text = text or ""
        words = plain_words(text)
        if len(text) >= min_chars or len(words) >= min_words:
            measured = class_counts(text)
            script = script_of(text, measured)
            mixed = place.get(("", script)) if (lang or "", script) not in place or not lang else None
            against = shared if mixed is None else np.append(shared, mixed)
            if len(against) and len(text) >= min_chars:
                near_class = float(js_distance(one_case(measured).astype(float), classes[against]).min())
            if len(against) and len(words) >= min_words:
                seen = np.bincount([vocabulary.get(w, width - 1) for w in words], minlength=width + 1).astype(float)
                p = seen[own[against]]
                p = np.column_stack([p, len(words) - p.sum(axis=1)])
                near_word = float(js_distance(p, usual[against]).min())
        kept = not base[-1] and (near_class or 0) <= max_class_distance and (near_word or 0) <= max_word_distance
        return (*base, kept, near_class, near_word)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(*x) for x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            measured = [
                pa.array([r[i] for r in rows], arrow_schema.field(i + 1).type) for i in range(len(rows[0]) if rows else 0)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *measured, *batch.columns[3:]], names=arrow_schema.names
                )

    return source.mapInArrow(run, spark_schema)
