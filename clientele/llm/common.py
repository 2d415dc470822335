"""Helpers shared by the text operators: batches, shared storage, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes that separate words in the white-space word class [^\x20\x09-\x0D]+ are
# those that bytes.split() splits on, so that class needs no table of its own.

#: A-Z become a-z, every other byte stays.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: As LOWER_ASCII, and every ASCII byte but digits and letters becomes a space:
#: ``split()`` of the result gives the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
ALNUM_ONLY = bytes(
    LOWER_ASCII[b] if b >= 128 or 48 <= b <= 57 or 97 <= LOWER_ASCII[b] <= 122 else 32 for b in range(256)
)

#: Arrow batches sent to Python hold at most so many bytes, whatever the texts' length.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, so that a batch of long texts stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a folder in the warehouse where none is set.

    Both are shared between the driver and all executors.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        base = configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        sc.setCheckpointDir(base)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, kept in the shared folder, lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def tasks_for(rows: int, rows_a_task: int = 100_000) -> int:
    """Tasks for a frame of so many rows: few rows shouldn't be dealt over many files."""
    return max(1, -(-rows // rows_a_task))


def tasks_for_bytes(df: DataFrame, column: str, bytes_a_task: int = 16 << 20) -> int:
    """Tasks for a frame whose ``column`` of text or bytes makes up most of it."""
    total = df.agg(F.sum(F.octet_length(column) + 64).alias("n")).first()["n"]
    return tasks_for(total or 0, bytes_a_task)


def map_batches(
    df: DataFrame, fn: Callable[[list[list]], list[list]], schema: str
) -> DataFrame:
    """Apply ``fn`` to lists of column values, one Arrow batch at a time.

    ``fn`` gets one list per input column and returns one list or Arrow array
    per output column; the number of rows may differ.
    """
    small_batches(df.sparkSession)
    out_schema = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = fn([c.to_pylist() for c in batch.columns])
                arrays = [
                    c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                    for c, f in zip(columns, out_schema, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=out_schema)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one partition's edges: (node, smallest node of its local tree)."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(x, find(x)) for x in parent]
    pairs = [p for p in pairs if p[0] != p[1]]
    for i in range(0, len(pairs), 100_000):
        part = pairs[i : i + 100_000]
        yield pa.RecordBatch.from_pydict(
            {"a": pa.array([p[0] for p in part], pa.int64()), "b": pa.array([p[1] for p in part], pa.int64())}
        )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): (node, component).

    Distributed union-find: every partition first joins its own edges into a
    local forest, which leaves at most one edge a node and partition; large-star
    and small-star rounds over checkpointed edges then hang every node on the
    smallest node of its component.  ``component`` is that smallest node; nodes
    without an edge to another node don't appear.  Rounds grow with the
    logarithm of the longest path.  Nothing is collected but a flag a round.
    """
    links = cut(
        edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
        .where("a is not null and b is not null and a <> b")
        .mapInArrow(_local_forest, "a long, b long")
        .distinct()
    )  # a > b
    while True:
        tasks = tasks_for(links.count())
        links = links.coalesce(tasks)
        # large-star: neighbours above a node go to the smallest of its neighbourhood
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(large.where("a <> b").coalesce(tasks).distinct().coalesce(tasks))
        # small-star: a node and its neighbours below go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        small = small.union(low.select("a", F.col("m").alias("b"))).coalesce(tasks)
        links = cut(small.mapInArrow(_local_forest, "a long, b long").distinct().coalesce(tasks))
        # done when every node has one root and no root is a node
        if not links.groupBy("a").count().where("count > 1").isEmpty():
            continue
        if links.join(links.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            break
    roots = links.select(F.col("b").alias("node")).distinct()
    members = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(roots.select("node", F.col("node").alias("component"))).coalesce(tasks)
