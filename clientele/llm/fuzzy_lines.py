"""Fuzzy line dedup (operator 2).

Lines are compared by their character shingles: MinHash signatures in many
short bands find candidates, exact Jaccard similarity confirms them, and
distributed union-find joins what is linked.  One line of each component stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from clientele.llm.common import cut, small_batches, tasks_for
from clientele.llm.links import MinHash, char_shingles, linked_buckets, linked_components, mix

WIDTH = 8  # characters (bytes) in a shingle


def normal_line(line: str) -> str:
    """Lower case, every run of white space one blank."""
    return " ".join(line.lower().split())


def line_id(normal: str) -> int:
    return xxhash.xxh3_64_intdigest(normal.encode()) - (1 << 63)


def eligible(text: str | None, min_chars: int) -> Iterator[tuple[int, str]]:
    """(number, normalised line) of the lines long enough to count."""
    for i, line in enumerate((text or "").split("\n")):
        if len(line) >= min_chars and len(line := normal_line(line)) >= min_chars:
            yield i, line


def _doc_key() -> F.Column:
    return F.xxhash64("doc_id", "text")


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """id, doc_id, line, doc_key: every eligible line, the first of equal ones in a document first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (line_id(line), doc_id, i, key)
                for doc_id, text, key in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for i, line in eligible(text, min_chars)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], names=["id", "doc_id", "line", "doc_key"]
            )

    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _doc_key())
    return frame.mapInArrow(run, "id long, doc_id long, line long, doc_key long")


def band_keys(lines: list[str], hasher: MinHash, bands: int) -> np.ndarray:
    """One row a line: a 64-bit key for each band of its signature.

    All lines are hashed at once, in stretches that fit the processor's cache.
    Every line has WIDTH bytes or more.
    """
    raw = [line.encode() for line in lines]
    out = np.empty((len(raw), len(hasher.factor)), np.uint32)
    k = 0
    while k < len(raw):
        stop, size = k, 0
        while stop < len(raw) and (stop == k or size + len(raw[stop]) < 1 << 17):
            size += len(raw[stop])
            stop += 1
        data = np.frombuffer(b"".join(raw[k:stop]), np.uint8).astype(np.uint64)
        lengths = np.array([len(x) for x in raw[k:stop]])
        s = np.zeros(len(data) - WIDTH + 1, np.uint64)
        for i in range(WIDTH):
            s = (s << np.uint64(8)) | data[i : i + len(s)]
        x = (mix(s) >> np.uint64(32)).astype(np.uint32)
        ends = np.cumsum(lengths)
        inside = np.ones(len(data), bool)  # shingles that don't cross into the next line
        for i in range(1, WIDTH):
            inside[ends - i] = False
        x = x[inside[: len(x)]]
        starts = np.cumsum(lengths - WIDTH + 1) - (lengths - WIDTH + 1)
        for j in range(len(hasher.factor)):
            out[k:stop, j] = np.minimum.reduceat((x ^ hasher.offset[j, 0]) * hasher.factor[j, 0], starts)
        k = stop
    keys = np.empty((len(raw), bands), np.uint64)
    rows = out.reshape(len(raw), bands, -1).astype(np.uint64)
    for b in range(bands):
        key = np.full(len(raw), b + 1, np.uint64)
        for r in range(rows.shape[2]):
            key = mix(key * np.uint64(31) + rows[:, b, r])
        keys[:, b] = key
    return keys


def _bucket_pairs(key: np.ndarray, ids: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates within runs of one key: each line with the ``reach`` before it and the run's first."""
    begin = np.ones(len(key), bool)
    begin[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(begin)[np.cumsum(begin) - 1] if len(key) else np.empty(0, np.int64)
    place = np.arange(len(key))
    lows, highs = [], []
    for back in range(1, reach + 1):
        at = place[first <= place - back]
        lows.append(ids[at - back])
        highs.append(ids[at])
    at = place[first < place - reach]
    lows.append(ids[first[at]])
    highs.append(ids[at])
    low, high = np.concatenate(lows), np.concatenate(highs)
    keep = low != high
    low, high = low[keep], high[keep]
    return np.minimum(low, high), np.maximum(low, high)


#: Kinds of rows between the batches and their buckets.
HEAD, LED, PAIR, MEMBER = range(4)

#: Columns that are equal in most rows stand together, so that a shuffled row takes little more than the others.
BANDED = "kind int, b long, key long, a long, near int"


def _banded(docs: DataFrame, bands: int, rows: int, min_chars: int, reach: int) -> DataFrame:
    """What each batch sends on: of its lines of one key the first (HEAD, LED), pairs among them, and the other members."""
    hasher = MinHash(bands * rows)
    names = [x.split()[0] for x in BANDED.split(", ")]

    def rows_of(kind: np.ndarray | int, key: np.ndarray, near: np.ndarray | int, a: np.ndarray, b: np.ndarray | None):
        held = (kind, key, near, a)
        kind, key, near, a = (pa.array(np.ascontiguousarray(np.broadcast_to(c, len(a)))) for c in held)
        b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
        return pa.RecordBatch.from_arrays([kind.cast(pa.int32()), b, key, a, near.cast(pa.int32())], names=names)

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = {line for text in batch.column(0).to_pylist() for _, line in eligible(text, min_chars)}
            if not lines:
                continue
            some = sorted(lines)
            ids = np.array([line_id(x) for x in some], np.int64)
            keys = band_keys(some, hasher, bands)
            near = (np.roll(keys, -1, axis=1) >> np.uint64(33)).astype(np.int32).ravel()
            key, each = keys.view(np.int64).ravel(), np.repeat(ids, bands)
            order = np.lexsort((each, near, key))
            key, near, each = key[order], near[order], each[order]
            low, high = _bucket_pairs(key, each, reach)
            head = np.ones(len(key), bool)
            head[1:] = key[1:] != key[:-1]
            led = np.append(~head[1:], False)[head]  # the batch has more lines of the key
            yield rows_of(np.where(led, LED, HEAD), key[head], near[head], each[head], None)
            if len(low):
                yield rows_of(PAIR, low, 0, low, high)
                rest = ~head
                yield rows_of(MEMBER, each[rest], 0, each[rest], key[rest])

    return docs.select("text").mapInArrow(band, BANDED)


def _met(docs: DataFrame, bands: int, rows: int, min_chars: int, reach: int) -> DataFrame:
    """Two kinds of rows: (null, a, b) near lines of a bucket, once each time they met, and (key, a, null) members.

    Every line of a bucket (lines that share a band) with two lines or more is a
    member.  Before the shuffle, each batch links its own lines of one key and
    sends only one of them on to the bucket: a key with a third of all lines has
    one row a batch there.  The others are members already, dealt out by
    themselves.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None  # rows of the batch before whose key may go on
        held = None  # its key, line, and whether the bucket is known to have two lines
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            pairs, members = batch.filter(pa.array(kind == PAIR)), batch.filter(pa.array(kind == MEMBER))
            if pairs.num_rows:
                yield _met_rows(None, pairs.column("a"), pairs.column("b"))
            if members.num_rows:
                yield _met_rows(members.column("b"), members.column("a"), None)
            open_ = kind <= LED
            key, ids = batch.column("key").to_numpy()[open_], batch.column("a").to_numpy()[open_]
            if not len(key):
                continue
            led = kind[open_] == LED
            all_key, all_ids, all_led = key, ids, led
            if held is not None:
                all_key, all_ids = np.append(held[0], key), np.append(held[1], ids)
                all_led = np.append(held[2], led)
            begin = np.ones(len(all_key), bool)
            begin[1:] = all_key[1:] != all_key[:-1]
            run = np.cumsum(begin) - 1
            unlike = np.zeros(len(all_key), bool)
            unlike[1:] = ~begin[1:] & (all_ids[1:] != all_ids[:-1])
            many = np.bincount(run, unlike | all_led) > 0  # two lines, here or in a batch
            whole = many[run]
            if whole.any():
                yield _met_rows(pa.array(all_key[whole]), pa.array(all_ids[whole]), None)
            held = all_key[-1], all_ids[-1], bool(whole[-1])
            if tail is not None:
                key, ids = np.concatenate([tail[0], key]), np.concatenate([tail[1], ids])
            low, high = _bucket_pairs(key, ids, reach)
            yield _met_rows(None, pa.array(low), pa.array(high))
            last = np.flatnonzero(key == key[-1])
            last = np.unique(np.concatenate([last[:1], last[-reach:]]))  # its first line and the nearest ones
            tail = key[last], ids[last]

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    banded = _banded(docs, bands, rows, min_chars, reach).repartition(parts, "key")
    met = banded.sortWithinPartitions("key", "near", "a").mapInArrow(meet, "key long, a long, b long")
    return cut(met.groupBy("key", "a", "b").agg(F.count("*").cast("int").alias("likeness")))


def _met_rows(key: pa.Array | None, a: pa.Array, b: pa.Array | None) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([none if key is None else key, a, none if b is None else b], names=["key", "a", "b"])


def removed_lines(
    docs: DataFrame, percent: int = 80, bands: int = 10, rows: int = 4, min_chars: int = 20, reach: int = 3
) -> DataFrame:
    """doc_key, line (from 0): the lines to remove, all of a component but the first by (doc_id, line)."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    met = _met(docs, bands, rows, min_chars, reach)
    members = met.where("b is null").select("key", F.col("a").alias("id"))
    candidates = met.where("b is not null").select("a", "b", "likeness")
    candidates = candidates.coalesce(tasks_for(candidates.count()))
    wanted = candidates.select(F.col("a").alias("id")).union(candidates.select(F.col("b").alias("id"))).distinct()

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = {line for text in batch.column(0).to_pylist() for _, line in eligible(text, min_chars)}
            some = sorted(lines)
            yield pa.RecordBatch.from_arrays(
                [pa.array([line_id(x) for x in some], pa.int64()), pa.array(some, pa.string())], names=["id", "text"]
            )

    lines = docs.select("text").mapInArrow(spell, "id long, text string")
    texts = cut(lines.join(wanted, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text")))
    text_tasks = tasks_for(texts.count(), 20_000)
    texts = texts.coalesce(text_tasks)
    linked = cut(linked_components(candidates, texts, lambda line: char_shingles(line, WIDTH), percent, text_tasks))
    linked = linked_buckets(members, linked, texts, lambda line: char_shingles(line, WIDTH), percent)
    seen = _occurrences(docs, min_chars)
    group = F.coalesce("component", "id").alias("group")
    seen = cut(
        seen.join(linked.select(F.col("node").alias("id"), "component"), "id", "left")
        .select(group, "doc_id", "line", "doc_key")
    )
    place = F.struct("doc_id", "line", "doc_key")
    firsts = cut(seen.groupBy("group").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"))
    return seen.join(firsts, "group").where(place != F.col("first")).select("doc_key", "line").distinct()


def fuzzy_line_dedup(docs: DataFrame, carry: tuple[str, ...] = (), **params: int) -> DataFrame:
    """One row a document: its text without the removed lines, and how many lines went.

    Two lines are alike when the Jaccard similarity of their 8-byte shingles,
    lower case and white space as one blank, is at least ``percent`` / 100.  Of
    all lines that links connect, the first by (doc_id, line) stays, anywhere in
    the table; null identifiers come first.  Lines of fewer than ``min_chars``
    characters stay.  A null text stays null with 0 lines.  Rows of equal doc_id
    and text are one document: they lose the same lines.  The columns named in
    ``carry`` come along unchanged in a struct ``carried``.  ``bands`` of
    ``rows`` values find a pair at the threshold with probability 0.995; every
    pair that shares a band is compared, unless links join it already.

    Returns doc_id, text, n_lines, n_removed and ``carried``.
    """
    small_batches(docs.sparkSession)
    gone = removed_lines(docs, **params).groupBy("doc_key").agg(F.collect_list("line").alias("gone"))
    frame = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", _doc_key().alias("doc_key"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    ).join(gone, "doc_key", "left").drop("doc_key")
    fields = {f.name: f.dataType for f in frame.schema.fields}
    schema = StructType.fromDDL("doc_id long, text string, n_lines long, n_removed long")
    schema = StructType([*schema.fields, *([StructField("carried", fields["carried"])] if carry else [])])
    names = to_arrow_schema(schema).names

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_removed = [], [], []
            for text, out in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                lines = [] if text is None else text.split("\n")
                n_lines.append(len(lines))
                n_removed.append(len(out or ()))
                if out:
                    dropped = set(out)
                    text = "\n".join([x for i, x in enumerate(lines) if i not in dropped])
                texts.append(text)
            columns = [
                batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()),
                pa.array(n_removed, pa.int64()), *([batch.column("carried")] if carry else []),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return frame.mapInArrow(rebuild, schema)
