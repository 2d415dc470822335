"""Sharding by best-fit-decreasing bin packing (operator 3).

Groups of equal texts are indivisible.  Sorted by size, each enters the bin with
the tightest remaining capacity, found in a balanced tree.  Packing runs on two
levels, so that no task and not the driver sees all groups: every task packs its
small groups into many small bins of fixed capacity; those bins and the few
large groups are packed into the shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientele.llm.common import cut

_MIX = 0x9E3779B97F4A7C15


class _Node:
    __slots__ = ("key", "left", "rank", "right")

    def __init__(self, key: tuple[int, int]):
        self.key, self.left, self.right = key, None, None
        x = (key[0] * _MIX + key[1] * 0xBF58476D1CE4E5B9 + 1) & (2**64 - 1)
        self.rank = ((x ^ (x >> 29)) * 0x94D049BB133111EB) & (2**64 - 1)


def _split(tree: _Node | None, key: tuple[int, int]) -> tuple[_Node | None, _Node | None]:
    """Nodes below ``key``, and the others."""
    if tree is None:
        return None, None
    if tree.key < key:
        tree.right, high = _split(tree.right, key)
        return tree, high
    low, tree.left = _split(tree.left, key)
    return low, tree


def _join(low: _Node | None, high: _Node | None) -> _Node | None:
    if low is None or high is None:
        return low or high
    if low.rank > high.rank:
        low.right = _join(low.right, high)
        return low
    high.left = _join(low, high.left)
    return high


class OpenBins:
    """Bins by remaining capacity, in a tree balanced by hashed ranks."""

    def __init__(self) -> None:
        self.root: _Node | None = None

    def add(self, remaining: int, number: int) -> None:
        low, high = _split(self.root, (remaining, number))
        self.root = _join(_join(low, _Node((remaining, number))), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the (remaining, number) with the least remaining capacity >= size."""
        low, high = _split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        node = high
        while node.left is not None:
            node = node.left
        _, high = _split(high, (node.key[0], node.key[1] + 1))
        self.root = _join(low, high)
        return node.key


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """Bin number of each size; ``sizes`` must be sorted from large to small.

    A size beyond the capacity gets a bin of its own.
    """
    bins, out, n = OpenBins(), [], 0
    for size in sizes:
        found = bins.take_tightest(size)
        if found is None:
            found = (max(capacity, size), n)
            n += 1
        out.append(found[1])
        if found[0] > size:
            bins.add(found[0] - size, found[1])
    return out


def best_fit_into(sizes: list[int], shards: int) -> list[int]:
    """Bin numbers below ``shards``, by the least capacity for which best fit needs no more bins."""
    if not sizes:
        return []
    low = max(max(sizes), -(-sum(sizes) // shards))
    high = max(sizes) + -(-sum(sizes) // shards)  # best fit opens a bin only when all others are fuller than this less a size
    while low < high:
        middle = (low + high) // 2
        if max(best_fit(sizes, middle)) < shards:
            high = middle
        else:
            low = middle + 1
    return best_fit(sizes, low)


def _pack_partition(capacity: int):
    """Best fit of one partition's groups into small bins: adds each row's bin."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        keys = [table[c].to_numpy() for c in ("hash", "text_crc32", "size")]
        order = np.lexsort(keys)
        new = np.ones(len(order), bool)
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
        group = np.cumsum(new) - 1
        totals = np.bincount(group, weights=keys[2][order]).astype(np.int64)
        by_size = np.argsort(-totals, kind="stable")  # ties in the order of the hash
        bins = np.empty(len(totals), np.int64)
        bins[by_size] = best_fit(totals[by_size].tolist(), capacity)
        item = np.empty(len(order), np.int64)
        item[order] = bins[group] + (TaskContext.get().partitionId() << 32)
        yield from table.select(["doc_id", "size", "text_crc32"]).append_column("item", pa.array(item)).to_batches(100_000)

    return pack


SCHEMA = "doc_id long, size long, text_crc32 long, item long"


def pack_shards(docs: DataFrame, shards: int = 8, bins_per_shard: int = 512) -> DataFrame:
    """One row a document: its shard, of near-equal bytes, and its place in it.

    ``size`` is the text's UTF-8 bytes plus 1; a null text counts as an empty
    one.  Documents of equal text stay together, so shards can only be as even
    as the largest group allows.  ``slot`` numbers a shard's rows from 0 without
    gaps.  Repeated rows and null identifiers are placed like any other; other
    columns are ignored; an empty table gives an empty result.

    Groups are recognised by hash, checksum and size of the text.  Those above
    1 / (shards * bins_per_shard) of all bytes or all rows are set apart: there
    are at most 2 * shards * bins_per_shard of them.  The others are dealt by
    hash to the partitions and packed there into bins of that capacity, which
    leaves at most 2 * shards * bins_per_shard bins plus one a partition.  So
    the second packing, on the driver, has a bounded number of sizes.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("hash"),
    )
    key = ["hash", "text_crc32", "size"]
    groups = cut(rows.groupBy(*key).agg(F.count("*").alias("n")))
    all_rows, all_bytes = groups.agg(F.sum("n"), F.sum(F.col("n") * F.col("size"))).first()
    slices = shards * bins_per_shard
    capacity = max(1, -(-(all_bytes or 0) // slices))
    large = groups.where(
        (F.col("n") * F.col("size") > capacity) | (F.col("n") > max(1, (all_rows or 0) // slices))
    ).orderBy(*key)
    apart = [(r.hash, r.text_crc32, r.size, -1 - i, r.n * r.size) for i, r in enumerate(large.collect())]
    apart_df = F.broadcast(spark.createDataFrame(
        [a[:4] for a in apart], "hash long, text_crc32 long, size long, item long"
    ))
    marked = rows.join(apart_df, key, "left")
    small = marked.where("item is null").select("doc_id", *key).repartition(parts, *key)
    placed = cut(
        small.mapInArrow(_pack_partition(capacity), SCHEMA)
        .union(marked.where("item is not null").select("doc_id", "size", "text_crc32", "item"))
    )
    bins = placed.where("item >= 0").groupBy("item").agg(F.sum("size").alias("n")).collect()
    items = sorted([(r.n, r.item) for r in bins] + [(a[4], a[3]) for a in apart], key=lambda x: (-x[0], x[1]))
    shard_of = best_fit_into([n for n, _ in items], shards)
    chosen = F.broadcast(spark.createDataFrame(
        [(item, s) for (_, item), s in zip(items, shard_of, strict=True)], "item long, shard int"
    ))
    # number the rows of a shard block by block: no task holds a whole shard
    block = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(parts)).alias("block")
    sharded = placed.join(chosen, "item").select("doc_id", "size", "text_crc32", "shard", block)
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sharded.groupBy("shard", "block").agg(F.count("*").alias("n")).select(
        "shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )  # shards * partitions rows
    inside = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")
    return (
        sharded.withColumn("i", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), ["shard", "block"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("start") + F.col("i")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
