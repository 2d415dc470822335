"""Near-duplicate documents by a MinHash LSH forest (operator 8).

Each tree of the forest is one order of the signature's values.  Documents
sorted by a tree's order meet those with the longest common prefix as
neighbours.  How deep the prefix must agree follows the region: as deep as
needed until few documents share it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import components, cut, map_batches, small_batches, tasks_for, tasks_for_bytes
from clientele.llm.links import MinHash, compared, linked_components, mix, word_shingles

SIZE = 64  # values in a signature
LEAD = 3  # neighbouring values that make the sets of a region


def _signatures(docs: DataFrame, width: int, size: int) -> DataFrame:
    """doc_id, hash of the text, n_shingles, two keys of the shingle set, and the signature as big-endian bytes."""
    hasher = MinHash(size)

    def run(columns: list[list]) -> list[list]:
        out: list[list] = [[] for _ in range(6)]
        for doc_id, text, text_hash in zip(*columns, strict=True):
            s = word_shingles(text, width)
            row = (
                doc_id, text_hash, len(s), int(s.sum(dtype=np.uint64).astype(np.int64)),
                int(mix(s).sum(dtype=np.uint64).astype(np.int64)),
                hasher.signature(s).astype(">u4").tobytes() if len(s) else None,
            )
            for column, value in zip(out, row, strict=True):
                column.append(value)
        return out

    schema = "doc_id long, text_hash long, n_shingles long, key_a long, key_b long, signature binary"
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text")), run, schema)


def tree_neighbours(
    tree: np.ndarray, paths: np.ndarray, ids: np.ndarray, region: int, reach: int, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates (a, b, likeness) among documents sorted by (tree, path).

    ``paths`` has one row a document: the leading value in full, then all values
    of the signature in the tree's order, 16 bits of each.
    A document's depth is the least number of leading values that at most
    ``region`` documents share with it (all values if more do).  Its candidates
    are the up to ``reach`` documents before it whose common prefix is that
    deep, and the centres of the documents that share its first value; likeness
    is the number of equal values, ``least`` at least.
    """
    n, width = paths.shape
    none = np.empty(0, np.int64)
    if n < 2:
        return none, none, none
    equal = (paths[1:] == paths[:-1]) & (tree[1:] == tree[:-1])[:, None]
    common = np.zeros(n, np.int64)  # values shared with the document before
    common[1:] = np.cumprod(equal, axis=1).sum(axis=1)
    depth, first = np.full(n, width), np.arange(n)
    waiting = np.ones(n, bool)
    for d in range(1, width + 1):
        begin = common < d
        run = np.cumsum(begin) - 1
        starts = np.flatnonzero(begin)
        sizes = np.diff(np.append(starts, n))[run]
        settled = waiting & ((sizes <= region) | (d == width))
        depth[settled], first[settled] = d, starts[run[settled]]
        waiting &= ~settled
        if not waiting.any():
            break
    lows, highs, counts = [], [], []
    place = np.arange(n)
    for back in range(1, reach + 1):
        at = place[first <= place - back]
        lows.append(at - back)
        highs.append(at)
    begin = np.flatnonzero(common < 1)
    for start, end in zip(begin, np.append(begin[1:], n), strict=True):
        if end - start > reach + 1:
            for centre, near in _centres(paths[start:end, 1:], least):
                lows.append(np.full(len(near), start + centre))
                highs.append(start + near)
    low, high = np.concatenate(lows), np.concatenate(highs)
    for k in range(0, len(low), 65536):
        counts.append((paths[low[k : k + 65536], 1:] == paths[high[k : k + 65536], 1:]).sum(axis=1))
    count = np.concatenate(counts) if counts else none
    keep = (count >= least) & (ids[low] != ids[high])
    low, high = ids[low[keep]], ids[high[keep]]
    return np.minimum(low, high), np.maximum(low, high), count[keep]


def _centres(paths: np.ndarray, least: int, most: int = 6) -> Iterator[tuple[int, np.ndarray]]:
    """(centre, rows near it) of a region, up to ``most`` times.

    The centre is the row that agrees most with the values most frequent in each
    column: copies that were edited apart still meet the text they came from.
    Rows that agree with a centre in nine of ten values are done, the others
    look for the next one.
    """
    left = np.arange(len(paths))
    for _ in range(most):
        if len(left) < 2:
            return
        own = paths[left]
        usual = np.empty(own.shape[1], own.dtype)
        for c in range(own.shape[1]):
            values, counts = np.unique(own[:, c], return_counts=True)
            usual[c] = values[counts.argmax()]
        centre = int(left[(own == usual).sum(axis=1).argmax()])
        agree = (own == paths[centre]).sum(axis=1)
        yield centre, left[(agree >= least) & (left != centre)]
        left = left[(agree < 0.9 * own.shape[1]) & (left != centre)]


def _plant(sets: DataFrame, trees: int) -> DataFrame:
    """(tree, path, id): every set once a tree; the path is the leading value in full, then 16 bits of every value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            values = _values(batch.column(1))
            for t in range(trees):
                order = np.roll(values, -(t * SIZE // trees), axis=1)
                path = np.concatenate([order[:, :1].copy().view(np.uint8), order.astype(">u2").view(np.uint8)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t] * len(ids), pa.int32()), pa.array([p.tobytes() for p in path], pa.binary()), ids],
                    names=["tree", "path", "id"],
                )

    return sets.select("id", "signature").mapInArrow(run, "tree int, path binary, id long")


def _values(signatures: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(signatures.to_pylist()), ">u4").reshape(len(signatures), SIZE)


def _neighbours(planted: DataFrame, parts: int, region: int, reach: int, least: int) -> DataFrame:
    """(a, b, likeness): candidates among the neighbours of each tree's sorted order."""
    ordered = planted.repartitionByRange(parts, "tree", "path", "id").sortWithinPartitions("tree", "path", "id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None  # the last rows of the batch before, so that runs go on
        for batch in batches:
            tree, ids = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            raw = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(len(ids), 4 + 2 * SIZE)
            lead, rest = raw[:, :4].copy().view(">u4"), raw[:, 4:].copy().view(">u2")
            paths = np.concatenate([lead.astype(np.uint32), rest.astype(np.uint32)], axis=1)
            if tail is not None:
                tree, paths, ids = (np.concatenate([x, y]) for x, y in zip(tail, (tree, paths, ids), strict=True))
            yield _pairs(*tree_neighbours(tree, paths, ids, region, reach, least))
            keep = max(len(ids) - 4 * region, 0)
            tail = tree[keep:], paths[keep:], ids[keep:]

    return ordered.mapInArrow(search, "a long, b long, likeness int")


def _pairs(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n.astype(np.int32))], names=["a", "b", "likeness"])


def _sharing(sets: DataFrame) -> DataFrame:
    """(id, stretch, key): the regions of two sets or more.

    A region shares ``LEAD`` neighbouring values of the signature, of any of its
    ``SIZE // LEAD`` stretches.
    """

    def leading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _values(batch.column("signature")).astype(np.uint64)
            for t in range(SIZE // LEAD):
                key = np.full(len(values), t + 1, np.uint64)
                for d in range(LEAD):
                    key = mix(key * np.uint64(31) + values[:, t * LEAD + d])
                columns = [batch.column("id"), pa.array([t] * len(key), pa.int32()), pa.array(key.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "stretch", "key"])

    rows = sets.select("id", "signature").mapInArrow(leading, "id long, stretch int, key long")
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    found = cut(rows.join(shared, "key").select("id", "stretch", "key"))
    return found.coalesce(tasks_for(found.count()))


def _regions(
    sharing: DataFrame, sets: DataFrame, linked: DataFrame, block: int, deepest: int
) -> tuple[DataFrame, DataFrame]:
    """(key, own, side, id, component): sets dealt into the regions that hold two components or more.

    ``sharing`` has the regions; one of more than ``block`` sets is divided by the
    next value, up to ``deepest`` - 1 times.  What is larger then is dealt into
    several parts (``own``), and the set with most members in its component goes
    to every part.  The second frame has the sets (key, id) of all regions that
    were divided: their divisions and parts haven't met each other.
    """

    def divided(depth: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = _values(batch.column("signature")).astype(np.uint64)
                at = ((batch.column("stretch").to_numpy() + 1) * LEAD + depth - 1) % SIZE
                key = batch.column("key").to_numpy().view(np.uint64) * np.uint64(31) + values[np.arange(len(values)), at]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(mix(key).view(np.int64))], names=names)

        return run

    names, schema = ["id", "component", "stretch", "key"], "id long, component long, stretch int, key long"
    rows = _in_components(sharing, linked).select(*names)
    fits, out, large = F.col("n") <= block, None, None
    for d in range(deepest):
        if d:
            rows = rows.join(sets.select("id", "signature"), "id").select(*names, "signature").mapInArrow(divided(d), schema)
        size = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("c0"), F.max("component").alias("c1"))
        rows = cut(rows.join(size.where("n > 1 and c0 <> c1").select("key", "n"), "key"))
        done = rows.where(fits).select("key", F.lit(0).cast("long").alias("own"), "id", "component")
        out = done if out is None else out.union(done)
        if large is None:
            large = rows.where(~fits).select("key", "id")
        rows = rows.where(~fits)
        if rows.isEmpty():
            break
        rows = rows if d == deepest - 1 else rows.drop("n")
    else:
        weight = linked.groupBy("component").agg(F.count("*").alias("weight"))
        weighed = rows.join(weight, "component", "left").select("key", "id", F.coalesce("weight", F.lit(1).cast("long")).alias("weight"))
        hubs = weighed.groupBy("key").agg(F.max(F.struct("weight", "id")).alias("top")).select("key", F.col("top.id").alias("hub"))
        parts = F.ceil(F.col("n") / block).cast("long")
        every = F.when(F.col("id") == F.col("hub"), F.sequence(F.lit(0).cast("long"), parts - 1)).otherwise(F.array(F.pmod(F.xxhash64("id"), parts)))
        out = out.union(rows.join(hubs, "key").select("key", F.explode(every).alias("own"), "id", "component"))
    return out.withColumn("side", F.lit(2)), large


def _in_components(rows: DataFrame, linked: DataFrame) -> DataFrame:
    of = linked.select(F.col("node").alias("id"), F.col("component").alias("found"))
    return rows.join(of, "id", "left").withColumn("component", F.coalesce("found", "id")).drop("found")


def _may_agree(large: DataFrame, sets: DataFrame, linked: DataFrame, least: int) -> DataFrame:
    """The rows (key, id) of ``large`` whose sets have ``least`` signature values in common with other components.

    A candidate agrees in so many values with one set of another component, so no other set is in a candidate.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.arange(1, SIZE + 1, dtype=np.uint64) * np.uint64(31)
        for batch in batches:
            values = mix(place + (_values(batch.column("signature")).astype(np.uint64) << np.uint64(16)))
            ids, of = (np.repeat(batch.column(c).to_numpy(), SIZE) for c in ("id", "component"))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, of, values.ravel().view(np.int64))], names=["id", "component", "value"])

    ids = _in_components(large.select("id").distinct(), linked)
    held = ids.join(sets.select("id", "signature"), "id").select("id", "component", "signature")
    held = held.mapInArrow(spread, "id long, component long, value long")
    shared = held.groupBy("value").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1")
    common = held.join(shared.select("value"), "value").groupBy("id").agg(F.count("*").alias("common"))
    return cut(large.join(common.where(F.col("common") >= least), "id", "left_semi").select("key", "id"))


def _sized(large: DataFrame, linked: DataFrame, block: int) -> DataFrame:
    """(key, id, component, main, parts, others): the sets of regions that still hold two components or more.

    ``main`` is the component with most sets of the region, ``parts`` the blocks
    that all its sets fill, ``others`` those that the sets outside ``main`` fill.
    Of regions with the same sets one is enough.
    """
    rows = _in_components(large, linked)
    each = rows.groupBy("key", "component").agg(
        F.count("*").alias("m"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("s"), F.min("id").alias("low")
    )
    size = each.groupBy("key").agg(
        F.sum("m").alias("n"), F.max(F.struct("m", "component")).alias("top"), F.count("*").alias("kinds"),
        F.sum("s").alias("s"), F.min("low").alias("low"),
    ).where("kinds > 1")
    one = size.groupBy("n", "s", "low").agg(F.min(F.struct("key", "top")).alias("one"))
    blocks = [F.ceil(c / block).cast("long") for c in (F.col("n"), F.col("n") - F.col("one.top.m"))]
    one = one.select("one.key", F.col("one.top.component").alias("main"), blocks[0].alias("parts"), blocks[1].alias("others"))
    return cut(rows.join(one, "key"))


def _may_link(rows: DataFrame, texts: DataFrame, shingles: Callable[[str], np.ndarray], percent: int) -> DataFrame:
    """The ids (id, component) in ``rows`` that hold ``percent`` of their shingles in common with other components.

    A link's intersection is at least that part of either set, so no other set has a link to another component.
    """

    def spread(columns: list[list]) -> list[list]:
        found = [shingles(text) for text in columns[2]]
        sizes = np.array([len(x) for x in found])
        values = np.concatenate(found).view(np.int64)
        return [pa.array(x) for x in (*(np.repeat(c, sizes) for c in columns[:2]), np.repeat(sizes, sizes), values)]

    spelt = rows.join(texts, "id").select("id", "component", "text")
    held = map_batches(spelt, spread, "id long, component long, n long, shingle long")
    shared = held.groupBy("shingle").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1")
    common = held.join(shared.select("shingle"), "shingle").groupBy("id", "n").agg(F.count("*").alias("common"))
    return cut(common.where(F.col("common") * 100 >= F.col("n") * percent).select("id"))


def _cells(rows: DataFrame) -> DataFrame:
    """(key, own, side, id, component): every set of a region (side 0) meets all sets outside its main component (side 1)."""
    part, other = F.pmod(F.xxhash64("id"), F.col("parts")), F.pmod(F.xxhash64("id"), F.col("others"))
    down = F.expr("sequence(0L, others - 1)")
    across = F.expr("sequence(0L, parts - 1)")
    left = rows.select("key", (part * F.col("others")).alias("at"), F.explode(down).alias("j"), "id", "component")
    left = left.select("key", (F.col("at") + F.col("j")).alias("own"), F.lit(0).alias("side"), "id", "component")
    outside = rows.where("component <> main")
    right = outside.select("key", other.alias("at"), "others", F.explode(across).alias("i"), "id", "component")
    right = right.select("key", (F.col("i") * F.col("others") + F.col("at")).alias("own"), F.lit(1).alias("side"), "id", "component")
    return left.union(right)


#: A part of a region with more candidate pairs than so many a set is compared as a whole.
DENSE = 2

#: Regions with more than so many blocks of sets outside their largest component lose those with too few common values first.
WIDE = 4

#: Regions with more than so many blocks of sets outside their largest component lose those without enough common shingles first.
MANY = 16

MET = "a long, b long, likeness int, key long, own long, side int, component long"


def _met(regions: DataFrame, sets: DataFrame, parts: int, least: int) -> DataFrame:
    """Pairs (a, b, likeness) of a region's part, in different components, whose signatures agree in ``least`` values.

    Within a part all sets of side 2 meet, and all of side 0 those of side 1.  A
    part with more than ``DENSE`` such pairs a set gives its sets instead (a,
    key, own, side, component; b null): pairs never outgrow the rows.  The last
    byte of each value is compared: it can only make more candidates, 0.25 values
    in 64, and a quarter of the bytes is dealt.
    """

    def last_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            short = [x[3::4] for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(short, pa.binary())], names=["id", "signature"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            key, own = table["key"].to_numpy(), table["own"].to_numpy()
            begin = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (own[1:] != own[:-1])))
            held = table.slice(int(begin[-1]))  # its part may go on
            yield from pairs(table.slice(0, int(begin[-1])), begin[:-1])
        if held is not None:
            yield from pairs(held, np.zeros(1, np.int64))

    def pairs(table: pa.Table, begin: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        ids, component, side = table["id"].to_numpy(), table["component"].to_numpy(), table["side"].to_numpy()
        values = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(-1, SIZE)
        for start, end in zip(begin, np.append(begin[1:], table.num_rows), strict=True):
            some, apart, found = values[start:end], component[start:end], []
            rest = np.flatnonzero(side[start:end] != 1)  # sides are in order
            begin_right = len(rest) if len(rest) < len(some) or side[start] == 0 else 0
            for i in rest.tolist():
                first = max(i + 1, begin_right)
                agree = (some[first:] == some[i]).sum(axis=1)
                at = np.flatnonzero((agree >= least) & (apart[first:] != apart[i]))
                if len(at):
                    a, b = np.full(len(at), ids[start + i]), ids[start + first + at]
                    found.append((np.minimum(a, b), np.maximum(a, b), agree[at]))
            if sum(len(x[0]) for x in found) > DENSE * len(some):
                part = table.slice(int(start), int(end - start))
                yield _met_rows(part["id"], None, None, *(part[c] for c in ("key", "own", "side", "component")))
            elif found:
                yield _met_rows(*(pa.array(np.concatenate(x)) for x in zip(*found, strict=True)), None, None, None, None)

    short = sets.select("id", "signature").mapInArrow(last_bytes, "id long, signature binary")
    dealt = regions.join(short, "id").select("key", "own", "side", "id", "component", "signature")
    dealt = dealt.repartition(parts, "key", "own").sortWithinPartitions("key", "own", "side")
    met = cut(dealt.mapInArrow(compare, MET))
    return met.coalesce(tasks_for(met.count()))


def _met_rows(a: pa.Array | pa.ChunkedArray, *rest: pa.Array | pa.ChunkedArray | None) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    columns = [pa.nulls(len(a), t) if c is None else c.cast(t) for c, t in zip((a, *rest), types, strict=True)]
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in MET.split(", ")])


def _texts(docs: DataFrame, sets: DataFrame, paired: DataFrame, shares: DataFrame) -> DataFrame:
    """(id, text, paired, shares): the texts of these sets, those in candidates and those in regions.

    Whatever a search needs later is among them, so the documents are dealt once.
    """
    flags = [F.max(c).alias(c) for c in ("paired", "shares")]
    yes, no = F.lit(True), F.lit(False)
    wanted = paired.select("id", yes.alias("paired"), no.alias("shares")).union(shares.select("id", no, yes)).groupBy("id").agg(*flags)
    named = sets.select("id", "first.doc_id", "first.text_hash").join(wanted, "id")
    spelt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return cut(spelt.join(named, ["doc_id", "text_hash"]).select("id", "text", "paired", "shares").dropDuplicates(["id"]))


def near_documents(
    docs: DataFrame, width: int = 4, percent: int = 80, trees: int = 10, region: int = 32, reach: int = 4,
    block: int = 256, deepest: int = 4,
) -> DataFrame:
    """One row a document: n_shingles, component_id and whether it is the one kept.

    Documents are linked when 100 * intersection >= ``percent`` * union of their
    ``width``-word shingle sets; ``component_id`` is the smallest doc_id that
    links reach, and its document is kept.  Documents with equal sets count as
    one in the search.  Candidates come from ``trees`` sorted orders; every
    candidate between components is confirmed on the full sets, so no link is
    false.  A candidate needs 0.55 of the signature to agree, five standard
    deviations under 0.8.  Then regions, the sets that share one of 21 stretches of
    ``LEAD`` values, are searched by signatures alone where they still hold two
    components; a pair at 0.8 shares no stretch once in three million.  All pairs
    of a region of up to ``block`` sets meet; a larger one is divided by the next
    value, up to ``deepest`` - 1 times; what is larger even there is compared part
    by part, and with the set of its largest component.  That finds most links of
    large regions cheaply.  For the rest, all sets of divided regions that still
    hold two components meet all that are outside the region's largest: no pair
    that shares a stretch is left out, however large the region.  Where the sets
    outside are more than ``WIDE`` blocks, those that agree in too few values with
    all other components together go before, and where they still are more than
    ``MANY``, those that have too few shingles in common with them.  Candidates found so are
    confirmed pair by pair, or part by part where they are many: work grows with
    the sets, and with their pairs only in regions of many sets that share most
    shingles and are not linked.

    A document without words has an empty set, is linked with nothing and kept.
    A null doc_id is linked with nothing: component_id null, kept.  Rows that
    repeat a doc_id are one node: they have one component_id, and join the
    groups of all their texts.  There is one row for every input row.  Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts, least = int(spark.conf.get("spark.sql.shuffle.partitions")), int(0.55 * SIZE)
    signed = cut(
        _signatures(docs, width, SIZE)
        .withColumn("id", F.when(F.col("n_shingles") > 0, F.xxhash64("key_a", "key_b"))).drop("key_a", "key_b")
    )
    nodes = signed.where("id is not null and doc_id is not null")
    place = F.struct("doc_id", "text_hash")
    sets = cut(nodes.groupBy("id").agg(F.min(place).alias("first"), F.first("signature").alias("signature")))
    sets = sets.coalesce(tasks_for(sets.count(), 5_000))
    planted = _plant(sets, trees)
    candidates = _neighbours(planted, parts, region, reach, least).groupBy("a", "b").agg(F.max("likeness").alias("likeness"))
    candidates = cut(candidates)
    candidates = candidates.coalesce(tasks_for(candidates.count()))
    sharing = _sharing(sets)

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id")))

    def sized(texts: DataFrame) -> tuple[DataFrame, int]:
        """These texts, and the tasks that can hold them."""
        tasks = tasks_for_bytes(texts, "text")
        return texts.coalesce(tasks), tasks

    fetched = _texts(docs, sets, ends(candidates), sharing.select("id"))

    def texts_of(ids: DataFrame) -> tuple[DataFrame, int]:
        """(id, text) of these sets, all of them in regions, and the tasks that can hold them."""
        return sized(cut(fetched.where("shares").join(ids.distinct(), "id", "left_semi").select("id", "text")))

    def shingles(text: str) -> np.ndarray:
        return word_shingles(text, width)

    texts, tasks = sized(fetched.where("paired").select("id", "text"))
    linked = cut(linked_components(candidates, texts, shingles, percent, tasks))

    def links_of(linked: DataFrame) -> DataFrame:
        return linked.select(F.col("node").alias("a"), F.col("component").alias("b"))

    def joined_up(met: DataFrame, linked: DataFrame) -> DataFrame:
        """The components when what ``_met`` found is confirmed too."""
        dense = met.where("b is null").select("key", F.col("own").alias("block"), "side", F.col("a").alias("id"), "component")
        if met.isEmpty():
            return linked
        more = cut(met.where("b is not null").groupBy("a", "b").agg(F.max("likeness").alias("likeness")))
        texts, tasks = texts_of(dense.select("id").union(ends(more)))
        if not dense.isEmpty():
            found = compared(dense.join(texts, "id"), shingles, percent)
            linked = cut(components(links_of(linked).union(found.where("b is not null").select("a", "b"))))
        if not more.isEmpty():
            more = more.coalesce(tasks_for(more.count()))
            linked = cut(linked_components(more, texts, shingles, percent, tasks, start=links_of(linked)))
        return linked

    dealt, large = _regions(sharing, sets, linked, block, deepest)
    linked = joined_up(_met(dealt, sets, parts, least), linked)
    rows = None if large.isEmpty() else _sized(large, linked, block)
    if rows is not None and not rows.isEmpty():
        wide = F.col("others") > WIDE
        if not rows.where(wide).isEmpty():
            alive = _may_agree(rows.where(wide).select("key", "id"), sets, linked, least)
            rows = _sized(rows.where(~wide).select("key", "id").union(alive), linked, block)
        many = F.col("others") > MANY
        if not rows.where(many).isEmpty():
            wanted = rows.where(many).select("id", "component").distinct()
            alive = _may_link(wanted, texts_of(wanted.select("id"))[0], shingles, percent)
            rows = rows.where(~many).select("key", "id").union(rows.where(many).join(alive, "id", "left_semi").select("key", "id"))
            rows = _sized(rows, linked, block)
        if not rows.isEmpty():
            linked = joined_up(_met(_cells(rows), sets, parts, least), linked)
    return _with_components(signed, sets.select("id", F.col("first.doc_id").alias("rep")), linked)


def _with_components(signed: DataFrame, sets: DataFrame, linked: DataFrame) -> DataFrame:
    """The rows of ``signed`` with the smallest doc_id of their component.

    Components of sets become components of their smallest documents; a doc_id
    with several sets joins them.
    """
    a, b = sets.select(F.col("id").alias("node"), F.col("rep").alias("a")), sets.select(F.col("id").alias("component"), F.col("rep").alias("b"))
    links = linked.join(a, "node").join(b, "component").select("a", "b")
    rows = signed.select("doc_id", "n_shingles", "id").join(sets, "id", "left")
    owned = rows.where("rep is not null and doc_id is not null")
    several = owned.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("most")).where("b <> most")
    links = links.union(owned.join(several, "doc_id").select(F.col("rep").alias("a"), "b").distinct())
    found = cut(components(links))
    smallest = rows.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
    smallest = smallest.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep")))
    # a row without words takes part in its doc_id's component, if other rows have one
    wordless = smallest.where("id is null").select("doc_id", "n_shingles")
    of_doc = smallest.where("id is not null and doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    wordless = wordless.join(of_doc, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    out = smallest.where("id is not null").select("doc_id", "n_shingles", "component_id").unionByName(wordless)
    return out.select("doc_id", "n_shingles", "component_id").withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
