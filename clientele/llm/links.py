"""Verified links between texts, from candidates of any search (for operators 2 and 8)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import LOWER_ASCII, components, cut, small_batches, tasks_for

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles.

    Words are [^\\x20\\x09-\\x0D]+ with A-Z lowered; fewer than ``width`` words
    make one shingle; no words, none.
    """
    words = (text or "").encode().translate(LOWER_ASCII).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    n = len(h) - width + 1
    if n < 1:  # the length keeps a short sequence apart from any full shingle
        n, width, out = 1, len(h), np.full(1, len(h), np.uint64)
    else:
        out = np.zeros(n, np.uint64)
    for i in range(width):
        out = mix(out * np.uint64(31) + h[i : i + n] + np.uint64(i + 1))
    return np.unique(out)


def char_shingles(line: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the line's UTF-8 byte strings of ``width`` (at most 8) bytes.

    A shorter line is one shingle.
    """
    data = np.frombuffer(line.encode().ljust(width, b"\x00"), np.uint8).astype(np.uint64)
    n = len(data) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = (out << np.uint64(8)) | data[i : i + n]
    return np.unique(mix(out))


class MinHash:
    """Signatures of ``size`` minima over multiply-add hashes of 32 bits."""

    def __init__(self, size: int, seed: int = 1):
        draw = mix(np.arange(1, 2 * size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        self.factor = (draw[:size] >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)
        self.offset = (draw[size:] >> np.uint64(32)).astype(np.uint32)[:, None]

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        out = np.full(len(self.factor), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 4096):
            np.minimum(out, ((x[None, i : i + 4096] ^ self.offset) * self.factor).min(axis=1), out=out)
        return out


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, over sorted distinct hashes."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both) > 0


def _verified(
    pairs: DataFrame, texts: DataFrame, shingles: Callable[[str], np.ndarray], percent: int, text_tasks: int
) -> DataFrame:
    """The pairs (a, b) whose texts are similar, confirmed on their full sets."""
    small_batches(pairs.sparkSession)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, ta, tb = (c.to_pylist() for c in batch.columns)
            sets: dict[int, np.ndarray] = {}
            keep = []
            for i in range(len(a)):
                for key, text in ((a[i], ta[i]), (b[i], tb[i])):
                    if key not in sets:
                        sets[key] = shingles(text)
                if similar(sets[a[i]], sets[b[i]], percent):
                    keep.append(i)
            if keep:
                yield pa.RecordBatch.from_pydict(
                    {"a": pa.array([a[i] for i in keep], pa.int64()), "b": pa.array([b[i] for i in keep], pa.int64())}
                )

    tasks = max(text_tasks, tasks_for(pairs.count(), 2_000))  # few pairs still meet all texts
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    joined = pairs.select("a", "b").join(left, "a").coalesce(tasks).join(right, "b").coalesce(tasks)
    return joined.select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long").coalesce(tasks_for(tasks, 25))


def linked_components(
    candidates: DataFrame, texts: DataFrame, shingles: Callable[[str], np.ndarray], percent: int, text_tasks: int,
    start: DataFrame | None = None,
) -> DataFrame:
    """Components (node, component) of the candidate pairs that prove similar, and of the links ``start`` (a, b).

    ``candidates``: (a long, b long, likeness int), a < b, once each; ``texts``:
    (id long, text), which ``text_tasks`` tasks can hold.  Only links between components matter, so the likeliest
    candidate of every text is verified first, then the likeliest of every
    component, and at last every candidate left between two components.  A
    candidate inside one component is the only kind that isn't verified.
    """
    edges = start
    open_ = candidates.select("a", "b", "likeness", F.col("a").alias("ca"), F.col("b").alias("cb"))
    tasks = tasks_for(candidates.count())
    for step in ("text", "component", "rest"):
        if edges is not None:
            comp = cut(components(edges))
            of_a = comp.select(F.col("node").alias("a"), F.col("component").alias("na"))
            of_b = comp.select(F.col("node").alias("b"), F.col("component").alias("nb"))
            open_ = cut(
                open_.drop("ca", "cb").join(of_a, "a", "left").join(of_b, "b", "left")
                .select("a", "b", "likeness", F.coalesce("na", "a").alias("ca"), F.coalesce("nb", "b").alias("cb"))
                .where("ca <> cb").coalesce(tasks)
            )
            if open_.isEmpty():
                return comp
        chosen = open_.select("a", "b")
        if step != "rest":
            ends = open_.select("ca", "a", "b", "likeness").union(open_.select("cb", "a", "b", "likeness"))
            chosen = (
                ends.groupBy("ca").agg(F.max(F.struct("likeness", "a", "b")).alias("m")).select("m.a", "m.b").distinct()
            )
        chosen = cut(chosen.coalesce(tasks)) if step != "rest" else chosen
        found = cut(_verified(chosen, texts, shingles, percent, text_tasks))
        edges = found if edges is None else edges.union(found)
        if step != "rest":
            open_ = open_.join(chosen, ["a", "b"], "left_anti")
    return components(edges)


#: Lines of a bucket that are compared with each other in one go.
BLOCK = 256


def similar_pairs(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which of ``left`` (rows) are similar to which of ``right`` (columns), as ``similar`` has it for each pair."""
    sizes = np.array([len(x) for x in sets])
    used = np.unique(np.concatenate([left, right]))
    values = np.concatenate([sets[i] for i in used])
    owner = np.repeat(used, sizes[used])
    values, column, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    order = np.flatnonzero(shared)[np.argsort(column[shared], kind="stable")]
    column, owner = column[order], owner[order]
    both = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    rank = np.cumsum(np.append(0, np.diff(column) != 0)) if len(column) else column
    for start in range(0, int(rank[-1]) + 1 if len(rank) else 0, width):
        lo, hi = np.searchsorted(rank, [start, start + width])
        grid = np.zeros((len(sets), width), np.float32)
        grid[owner[lo:hi], rank[lo:hi] - start] = 1
        both += grid[left] @ grid[right].T
    return (100 * both >= percent * (sizes[left][:, None] + sizes[right][None, :] - both)) & (both > 0)


def compared(rows: DataFrame, shingles: Callable[[str], np.ndarray], percent: int) -> DataFrame:
    """(key, a, b, degree): links that join components, and of each block the line with most links (b null).

    ``rows``: key, block (long), side, id, component, text.  Within a block all
    lines of side 2 meet, and all of side 0 those of side 1.
    """
    small_batches(rows.sparkSession)

    def compare(key: int, group: list[tuple]) -> Iterator[tuple]:
        component = {x[2]: x[2] for x in group}

        def find(x: int) -> int:
            while component[x] != x:
                component[x] = component[component[x]]
                x = component[x]
            return x

        if len(component) < 2:
            return
        side = np.array([x[0] for x in group])
        sets = [shingles(x[3]) for x in group]
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        alike = similar_pairs(sets, left, right, percent)
        alike &= left[:, None] != right[None, :]
        degree = np.zeros(len(group), np.int64)
        degree[left] = alike.sum(axis=1)
        degree[right] = np.maximum(degree[right], alike.sum(axis=0))
        top = int(degree.argmax())
        yield key, group[top][1], None, int(degree[top])
        for i, j in zip(*np.nonzero(alike), strict=True):
            x, y = group[left[i]], group[right[j]]
            a, b = find(x[2]), find(y[2])
            if a != b:
                component[max(a, b)] = min(a, b)
                yield key, x[1], y[1], 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[tuple[int, list[tuple]]]:
            now, group = None, []
            for batch in batches:
                for key, block, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if (key, block) != now:
                        if group:
                            yield now[0], group
                        now, group = (key, block), []
                    group.append(row)
            if group:
                yield now[0], group

        out: list[tuple] = []
        for key, group in groups():
            out += compare(key, group)
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in out], pa.int64()) for k in range(4)], names=["key", "a", "b", "degree"]
        )

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("key", "block", "side", "id", "component", "text").repartition(parts, "key", "block")
    found = cut(dealt.sortWithinPartitions("key", "block").mapInArrow(run, "key long, a long, b long, degree long"))
    return found.coalesce(tasks_for(found.count()))


def linked_buckets(
    members: DataFrame, linked: DataFrame, texts: DataFrame, shingles: Callable[[str], np.ndarray], percent: int,
    settled: int = 2,
) -> DataFrame:
    """Components (node, component) when all pairs of a bucket between two components are verified too.

    ``members`` (key, id): the buckets, each line once; ``linked``: components so
    far, in which buckets of up to ``settled`` members are done.  Buckets all of one
    component need nothing, and of buckets with the same lines one is enough.
    The others are dealt into blocks of about ``BLOCK`` lines.  The lines of a
    block are compared with each other, then all with the line that had most
    links in its bucket; buckets still in several components are compared block
    against block.  So no task gets a large bucket, and no pair is left out.
    """

    def still_open(frame: DataFrame) -> DataFrame:
        of = linked.select(F.col("node").alias("id"), F.col("component").alias("found"))
        frame = frame.join(of, "id", "left").withColumn("component", F.coalesce("found", "id")).drop("found")
        each = frame.groupBy("key").agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("s"),
            F.min("id").alias("low"), F.max("id").alias("high"),
            F.min("component").alias("c0"), F.max("component").alias("c1"),
        ).where(f"n > {settled} and c0 <> c1")
        one = each.groupBy("n", "s", "low", "high").agg(F.min("key").alias("key")).select("key", "n")
        count = F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks")
        frame = frame.join(one.select("key", count), "key")
        spread = F.pmod(F.xxhash64("id", "key"), F.col("blocks")).alias("own")
        return cut(frame.select("key", "id", "component", "blocks", spread))

    def join_up(found: DataFrame) -> DataFrame:
        links = found.where("b is not null").select("a", "b")
        return cut(components(linked.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links)))

    def spelt(frame: DataFrame) -> DataFrame:
        return frame.join(texts, "id")

    rows = still_open(members)
    if rows.isEmpty():
        return linked
    found = compared(
        spelt(rows.select("key", F.col("own").alias("block"), F.lit(2).alias("side"), "id", "component")), shingles, percent
    )
    linked = join_up(found)
    large = rows.where("blocks > 1").select("key", "id")
    if large.isEmpty():
        return linked
    rows = still_open(large)
    if rows.isEmpty():
        return linked
    hubs = found.where("b is null").groupBy("key").agg(F.max(F.struct("degree", "a")).alias("top"))
    hubs = rows.select("key", "id", "component", "blocks").join(hubs.select("key", F.col("top.a").alias("id")), ["key", "id"])
    hubs = hubs.select("key", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"), "id", "component")
    others = rows.select("key", F.col("own").alias("block"), F.lit(0).alias("side"), "id", "component")
    each = others.union(hubs.select("key", "block", F.lit(1).alias("side"), "id", "component"))
    linked = join_up(compared(spelt(each), shingles, percent))
    rows = still_open(large)
    if rows.isEmpty():
        return linked
    other = F.explode(F.expr("sequence(0L, blocks - 1)"))
    pairs = rows.select("key", "id", "component", "blocks", "own", other.alias("other")).where("own <> other")
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side")
    pairs = pairs.select("key", (low * F.col("blocks") + high).alias("block"), side, "id", "component")
    return join_up(compared(spelt(pairs), shingles, percent))
