"""Removal of long repeated strings by merging Burrows-Wheeler transforms (operator 7).

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else.  Three steps find these strings:

1.  Stretches.  Every string of ``length`` bytes is assigned to its anchor, the
    short string inside it with the smallest hash.  Equal strings have equal
    anchors at equal places, so starts next to each other with one anchor form a
    stretch, and only stretches of one anchor can share strings.  Anchors that
    occur once drop out, stretches that are equal as a whole are settled by
    their number.
2.  Transforms.  What is left, the different stretches of one anchor, is reduced
    to the parts that share enough bytes around the anchor with another stretch
    to hold a repeat (``shared_parts``), and cut into shards.  A shard's transform lists its rotations in order, each with the
    symbol before it.  Two transforms are merged by refining their interleaving,
    one symbol deeper a round, without sorting the rotations again.  Blocks of
    rotations that agree to the full depth are the repeated intervals.
3.  Removal.  The starts found are put together for each document.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import cut, map_batches, shared_dir, small_batches
from clientele.llm.links import mix

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PIECE = 1 << 19  # starts handled at once


# -- stretches ----------------------------------------------------------------


class Hashes:
    """Hashes of any substring of ``data``, by prefix sums of a polynomial modulo 2^64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power = np.full(n, _BASE)
        if n:
            power[0] = 1
        self.power = np.multiply.accumulate(power)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power, out=self.sums[1:])
        back = np.full(n, _INVERSE)
        if n:
            back[0] = 1
        self.back = np.multiply.accumulate(back)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


def stretches(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, stretch hash, anchor place, first start, last start) of every stretch.

    Ties between equal smallest hashes go to the last one, so that the anchor
    depends on the string alone.  The anchor hash only gathers stretches; their
    equality is decided by the stretch hash, a digest: different texts can be
    written whose polynomial hashes are equal.
    """
    parts = []
    for at in range(0, max(0, len(data) - length + 1), _PIECE):
        piece = data[at : at + _PIECE + length - 1]
        h = Hashes(piece)
        place = np.arange(len(piece) - gram + 1)
        grams = h.of(place, place + gram)
        # the place fills the low 20 bits, so that a minimum tells where it is
        least = (grams & ~np.uint64(0xFFFFF)) | (np.uint64(0xFFFFF) - place.astype(np.uint64))
        window, width = length - gram + 1, 1
        while 2 * width <= window:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < window:
            least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
        anchor = (np.uint64(0xFFFFF) - (least & np.uint64(0xFFFFF))).astype(np.int64)
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        last = np.append(first[1:], len(anchor)) - 1
        q = anchor[first]
        view = memoryview(piece)
        digests = [blake2b(view[a:b], digest_size=8).digest() for a, b in zip(first.tolist(), (last + length).tolist(), strict=True)]
        whole = mix(np.frombuffer(b"".join(digests), "<u8") + (q - first).astype(np.uint64) * np.uint64(1 << 32) + (last - first).astype(np.uint64))
        parts.append((grams[q].astype(np.int64), whole.astype(np.int64), q + at, first + at, last + at))
    if not parts:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


STRETCHES = "anchor long, stretch long, doc_key long, place int, low int, high int"


def _all_stretches(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(columns: list[list]) -> list[list]:
        out: list[list] = [[] for _ in range(6)]
        for key, text in zip(*columns, strict=True):
            found = stretches(np.frombuffer(text.encode(), np.uint8), length, gram)
            row = (found[0], found[1], np.full(len(found[0]), key), *found[2:])
            for column, values in zip(out, row, strict=True):
                column.append(values)
        return [pa.array(np.concatenate(c)) for c in out]

    frame = docs.select(_doc_key(), "text").where(F.octet_length("text") >= length)
    return map_batches(frame, run, STRETCHES)


def _doc_key() -> F.Column:
    return F.xxhash64("doc_id", "text").alias("doc_key")


# -- transforms ---------------------------------------------------------------


def stable_order(ids: np.ndarray) -> np.ndarray:
    """Stable order of small non-negative integers, 16 bits a pass."""
    order = np.argsort(ids.astype(np.uint16), kind="stable")
    high = ids >> 16
    if high.any():
        order = order[np.argsort(high[order].astype(np.uint16), kind="stable")]
    return order


class Rotations:
    """All rotations of a collection of circular strings, in symbols of ``step`` bytes.

    ``symbol[r]`` numbers the ``step`` bytes at rotation r, ``before[r]`` is the
    rotation ``step`` bytes earlier in the same string.
    """

    def __init__(self, strings: list[bytes], step: int):
        lengths = np.array([len(s) for s in strings])
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        data = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint64)
        owner = np.repeat(np.arange(len(strings)), lengths)
        inside = np.arange(len(data)) - self.starts[owner]
        self.owner, self.inside = owner, inside
        own = lengths[owner]

        def later(n: int) -> np.ndarray:
            """The rotation ``n`` bytes on."""
            at = inside + n % own if n >= own.min() else inside + n
            return self.starts[owner] + at - own * (at >= own)

        # numbers of the different strings of 1, 2, 4, ... bytes, the last two overlapping up to ``step``; no hashes
        width, part = 1, data
        while 2 * width <= min(step, 8):
            part = part << np.uint64(8 * width) | part[later(width)]
            width *= 2
        symbol = np.unique(part, return_inverse=True)[1].astype(np.int64)
        while width < step:
            add = min(width, step - width)
            pair = symbol * (int(symbol.max()) + 1) + symbol[later(add)]
            symbol = np.unique(pair, return_inverse=True)[1].astype(np.int64)
            width += add
        self.symbol = symbol
        self.after = later(step)
        self.before = np.empty_like(self.after)
        self.before[self.after] = np.arange(len(self.after))


class Transform:
    """Rotations of some strings in order of their first ``rounds`` symbols; the symbol before each.

    ``block`` numbers the rotations that agree in all of them.
    """

    def __init__(self, order: np.ndarray, symbols: np.ndarray, block: np.ndarray):
        self.order, self.symbols, self.block = order, symbols, block


def build(rotations: Rotations, members: np.ndarray, rounds: int) -> Transform:
    """Transform of one shard, by doubling the compared length."""
    rank = np.zeros(len(rotations.symbol), np.int64)
    rank[members] = rotations.symbol[members]
    width, jump = 1, rotations.after
    while width < rounds:
        add = min(width, rounds - width)
        if add < width:  # the last, overlapping comparison
            jump = np.arange(len(rank))
            for _ in range(add):
                jump = rotations.after[jump]
        pair = rank[members] * (int(rank[members].max()) + 1) + rank[jump[members]]
        rank[members] = np.unique(pair, return_inverse=True)[1]
        if add == width:
            jump = jump[jump]
        width += add
    order = members[np.argsort(rank[members], kind="stable")]
    return Transform(order, rotations.symbol[rotations.before[order]], rank[order])


def merge(rotations: Rotations, left: Transform, right: Transform, rounds: int) -> Transform:
    """Merge two transforms by refining their interleaving, one symbol deeper a round.

    The orders inside each transform stay; only whose rotation comes next is
    refined: a stable bucketing of the interleaved symbols gives the interleaving
    one symbol deeper.  A block border, once there, stays: its round is the
    common prefix of its neighbours.  Ends early when a round changes nothing.
    """
    sizes = len(left.order), len(right.order)
    side = np.repeat(np.array([False, True]), sizes)
    block = np.zeros(sum(sizes), np.int64)
    symbols = np.empty(sum(sizes), np.int64)
    for _ in range(rounds):
        symbols[~side], symbols[side] = left.symbols, right.symbols
        order = stable_order(symbols)
        new_side, sorted_symbols, old = side[order], symbols[order], block[order]
        border = np.zeros(len(order), np.int64)
        border[1:] = (sorted_symbols[1:] != sorted_symbols[:-1]) | (old[1:] != old[:-1])
        new_block = np.cumsum(border)
        same = np.array_equal(new_side, side) and np.array_equal(new_block, block)
        side, block = new_side, new_block
        if same:
            break
    merged = np.empty(sum(sizes), np.int64)
    merged[~side], merged[side] = left.order, right.order
    symbols[~side], symbols[side] = left.symbols, right.symbols
    return Transform(merged, symbols, block)


def repeated_starts(strings: list[bytes], counts: list[int], length: int, shards: int = 2) -> list[np.ndarray]:
    """For each string, a flag for each start of ``length`` bytes: is that string there again?

    ``counts`` says how often each string itself occurs.
    """
    step = next(d for d in range(min(50, length), 0, -1) if length % d == 0)
    rounds = length // step
    rotations = Rotations(strings, step)
    shard_of = np.arange(len(strings)) % shards
    transforms = []
    for s in range(shards):
        members = np.flatnonzero(shard_of[rotations.owner] == s)
        if len(members):
            transforms.append(build(rotations, members, rounds))
    while len(transforms) > 1:
        transforms = [
            merge(rotations, *transforms[i : i + 2], rounds) if i + 1 < len(transforms) else transforms[i]
            for i in range(0, len(transforms), 2)
        ]
    whole = transforms[0]
    lengths = rotations.ends - rotations.starts
    owner = rotations.owner[whole.order]
    real = rotations.inside[whole.order] <= lengths[owner] - length  # rotations that don't wrap within the length
    n = np.bincount(whole.block, weights=np.asarray(counts)[owner] * real, minlength=int(whole.block[-1]) + 1)
    flags = np.zeros(len(rotations.symbol), bool)
    flags[whole.order] = real & (n[whole.block] > 1)
    return [flags[a : b - length + 1] for a, b in zip(rotations.starts, rotations.ends, strict=True)]


def _flag_runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    yield from zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True)


# -- the job ------------------------------------------------------------------

#: Stretches that still need their bytes: key of their group, the range of distances
#: from start to anchor that the group compares, the first start and its distance.
OPEN = "key long, near int, far int, doc_key long, low int, distance int, n long, data binary"
STARTS = "doc_key long, low int, high int"


def _cell_key(key: int, near: int, far: int, core: bytes) -> int:
    digest = blake2b(core, digest_size=8, key=f"{key}:{near}:{far}".encode()).digest()
    return int.from_bytes(digest, "little", signed=True)


def _halves(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Split groups by distance to the anchor, and by the bytes that all strings of a half share."""
    for batch in batches:
        out: list[tuple] = []
        for r in batch.to_pylist():
            middle = (r["near"] + r["far"] + 1) // 2
            least = r["distance"] - (len(r["data"]) - length)  # distance of the last start
            for near, far in ((r["near"], middle - 1), (middle, r["far"])):
                first, last = min(r["distance"], far), max(least, near)
                if first < last:
                    continue
                begin = r["distance"] - first
                data = r["data"][begin : r["distance"] - last + length]
                core = r["data"][r["distance"] - near : r["distance"] - far + length]
                out.append((_cell_key(r["key"], near, far, core), near, far, r["doc_key"], r["low"] + begin, first, r["n"], data))
        columns = list(zip(*out, strict=True)) or [[] for _ in range(8)]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        names = [x.split()[0] for x in OPEN.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def shared_parts(rows: list[dict], length: int, cells: int = 8) -> list[dict]:
    """The rows of whole groups, cut to what may repeat inside their group; others go.

    A group's range of distances is dealt into ``cells``.  All strings whose
    distance lies in one cell hold the bytes around the anchor that the cell's
    first and last string share, so strings without a partner in the cell's hash
    of these bytes can't repeat.  The strings from a row's first to its last
    cell with a partner stay together, for the transforms to settle.
    """
    places: list[list[tuple[int, int, tuple]]] = []
    seen: dict[tuple, int] = {}
    for r in rows:
        distance, data = r["distance"], r["data"]
        least = distance - (len(data) - length)  # distance of the last start
        width = -(-(r["far"] - r["near"] + 1) // cells)
        found = []
        for near in range(r["near"], r["far"] + 1, width):
            far = min(near + width - 1, r["far"])
            first, last = min(distance, far), max(least, near)
            if first >= last:
                core = r["key"], near, hash(data[distance - near : distance - far + length])
                seen[core] = seen.get(core, 0) + 1
                found.append((distance - first, distance - last, core))
        places.append(found)
    out = []
    for r, found in zip(rows, places, strict=True):
        met = [(a, b) for a, b, core in found if seen[core] > 1]
        if met:
            begin, end = min(a for a, _ in met), max(b for _, b in met)
            part = {"low": r["low"] + begin, "distance": r["distance"] - begin, "data": r["data"][begin : end + length]}
            out.append(r | part)
    return out


def _stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read again."""
    path = f"{shared_dir(df.sparkSession)}/repeats-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _with_bytes(docs: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """OPEN rows of the stretches in ``wanted`` (anchor, n, doc_key, place, low, high)."""
    per_doc = wanted.groupBy("doc_key").agg(F.collect_list(F.struct("anchor", "n", "place", "low", "high")).alias("list"))
    texts = docs.select(_doc_key(), "text").where(F.octet_length("text") >= length)
    joined = texts.join(per_doc, "doc_key")

    def run(columns: list[list]) -> list[list]:
        out: list[list] = [[] for _ in range(8)]
        seen: set[int] = set()
        for key, text, found in zip(*columns, strict=True):
            if key in seen:
                continue
            data = text.encode()
            for r in found:
                row = (
                    r["anchor"], 0, length - gram, key, r["low"], r["place"] - r["low"], r["n"],
                    data[r["low"] : r["high"] + length],
                )
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        return out

    return map_batches(joined.select("doc_key", "text", "list"), run, OPEN)


def _compare(open_: DataFrame, length: int, batch_bytes: int) -> DataFrame:
    """Starts of the once-occurring stretches that occur in another stretch of their group."""

    def solve(rows: list[dict]) -> list[tuple[int, int, int]]:
        rows = shared_parts(rows, length)
        single = {r["key"] for r in rows if r["n"] == 1}
        rows = [r for r in rows if r["key"] in single]
        if not rows:
            return []
        flags = repeated_starts([r["data"] for r in rows], [r["n"] for r in rows], length)
        return [
            (r["doc_key"], r["low"] + a, r["low"] + b)
            for r, f in zip(rows, flags, strict=True)
            if r["n"] == 1
            for a, b in _flag_runs(f)
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        size = 0

        def emit(done: list[dict]) -> pa.RecordBatch:
            found = solve(done)
            return pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32()))],
                names=["doc_key", "low", "high"],
            )

        for batch in batches:
            for r in batch.to_pylist():
                if size > batch_bytes and r["key"] != rows[-1]["key"]:  # whole groups only
                    yield emit(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r["data"])
        if rows:
            yield emit(rows)

    parts = int(open_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = open_.select("key", "near", "far", "doc_key", "low", "distance", "n", "data").repartition(parts, "key")
    return dealt.sortWithinPartitions("key", "doc_key", "low").mapInArrow(run, STARTS)


def repeat_starts(
    docs: DataFrame, length: int = 400, gram: int = 120, group_stretches: int = 1024, batch_bytes: int = 1 << 19
) -> DataFrame:
    """doc_key, low, high: runs of starts whose ``length`` bytes also start anywhere else.

    Groups of more than ``group_stretches`` different stretches are halved, by
    the distance of start and anchor and by the bytes that all strings of a half
    share, until they are small; a half of one distance holds equal strings
    only.  So no task gets a large group, and none is cut short.
    """
    small_batches(docs.sparkSession)
    gram = min(gram, length)
    found = _stored(_all_stretches(docs, length, gram))
    same = found.groupBy("anchor", "stretch").agg(
        F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("doc_key", "low", "high", "place"))
    )  # any of equal stretches will do: they hold the same bytes
    several = _stored(same)
    groups = several.groupBy("anchor").agg(
        F.sum("n").alias("total"), F.count("*").alias("kinds"), F.max(F.col("n") == 1).alias("single")
    ).where("total > 1")
    groups = cut(groups)
    whole = found.join(several.where("n > 1").select("anchor", "stretch"), ["anchor", "stretch"])
    results = [whole.select("doc_key", "low", "high")]
    mixed = several.join(groups.where("kinds > 1 and single").select("anchor", "kinds"), "anchor")
    open_ = _stored(_with_bytes(docs, mixed.select("anchor", "n", "doc_key", "place", "low", "high"), length, gram))
    while True:
        sizes = open_.groupBy("key").agg(F.count("*").alias("kinds"))
        hot = cut(sizes.where(F.col("kinds") > group_stretches).select("key"))
        if hot.isEmpty():
            results.append(_compare(open_, length, batch_bytes))
            break
        results.append(_compare(open_.join(hot, "key", "left_anti"), length, batch_bytes))
        split = open_.join(hot, "key").select(open_.columns).mapInArrow(lambda b: _halves(b, length), OPEN)
        split = _stored(split.withColumn("stretch", F.concat(F.sha2("data", 256), F.lit(":"), "distance")))
        counted = _stored(split.groupBy("key", "stretch").agg(
            F.sum("n").alias("total"), F.min(F.struct("doc_key", "low")).alias("first")
        ))
        joined = split.join(counted, ["key", "stretch"])
        # equal stretches are settled by their number and go on as one
        results.append(
            joined.where("total > 1 and n = 1")
            .select("doc_key", "low", (F.col("low") + F.octet_length("data") - length).cast("int").alias("high"))
        )
        kept = joined.where((F.col("doc_key") == F.col("first.doc_key")) & (F.col("low") == F.col("first.low")))
        kinds = counted.groupBy("key").agg(F.count("*").alias("kinds"), F.max(F.col("total") == 1).alias("single"))
        kinds = kinds.where("kinds > 1 and single").select("key")
        open_ = _stored(
            kept.join(kinds, "key")
            .select("key", "near", "far", "doc_key", "low", "distance", F.col("total").alias("n"), "data")
        )
    out = results[0]
    for r in results[1:]:
        out = out.union(r)
    return out


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def remove_repeats(docs: DataFrame, length: int = 400, **params: int) -> DataFrame:
    """One row a document: bytes, removed bytes and runs, and the bytes that stay.

    A null text counts as empty; texts of fewer than ``length`` bytes hold no
    such string and stay whole.  Repeated rows repeat each other's strings and
    lose them; matches never cross documents.  What stays may cut a UTF-8
    character, so ``kept`` is binary.  Other columns are ignored; an empty table
    gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    starts = repeat_starts(docs, length, **params)
    per_doc = starts.groupBy("doc_key").agg(F.collect_list(F.struct("low", "high")).alias("starts"))
    frame = docs.withColumn("doc_key", F.xxhash64("doc_id", "text")).join(per_doc, "doc_key", "left")

    def run(columns: list[list]) -> list[list]:
        out: list[list] = [[] for _ in range(5)]
        for doc_id, text, found in zip(*columns, strict=True):
            data = (text or "").encode()
            spans: list[list[int]] = []
            for r in sorted(found or (), key=lambda r: r["low"]):
                if spans and r["low"] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], r["high"] + length)
                else:
                    spans.append([r["low"], r["high"] + length])
            kept, at = [], 0
            for a, b in spans:
                kept.append(data[at:a])
                at = b
            kept = b"".join([*kept, data[at:]])
            for column, value in zip(out, (doc_id, len(data), len(data) - len(kept), len(spans), kept), strict=True):
                column.append(value)
        return out

    return map_batches(frame.select("doc_id", "text", "starts"), run, SCHEMA)
