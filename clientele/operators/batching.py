"""Fixed-size batches without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.session import checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id(): partition index << 33 | row position


def batch_numbers(keys: DataFrame, size: int = 999, shards: int | None = None) -> DataFrame:
    """``batch_pos`` (0-based rank) and ``batch_no = batch_pos div size`` of every key.

    ``keys`` has one column of unique, non-null values.  ``row_number()`` over the
    whole table would move every row into one task; instead:

    1. checkpoint the keys, so that Spark's sampling of range cut points
       and the partitioning itself read stored keys instead of running the
       input plan twice; range-partition them and sort within each shard;
    2. take each key's shard and position in the shard, and checkpoint to
       the shared checkpoint folder, so that both are stored values (a lost
       executor or a re-planned shuffle cannot renumber them);
    3. count keys per shard and turn the counts into start offsets - a
       running sum over at most ``shards`` rows - broadcast back (its size
       is bounded by the shard count, not by the data);
    4. ``batch_pos = offset + position``.
    """
    if size <= 0:
        raise ValueError("size must be positive")
    (key,) = keys.columns
    checkpoint_dir(keys.sparkSession)
    source = keys.checkpoint(eager=True)
    ranged = source.repartitionByRange(shards, key) if shards else source.repartitionByRange(key)
    placed = ranged.sortWithinPartitions(key).withColumns(
        {
            "_shard": F.spark_partition_id(),
            "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POS_BITS) - 1)),
        }
    )
    placed = placed.checkpoint(eager=True)
    offsets = (
        placed.groupBy("_shard")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_offset",
            F.coalesce(
                F.sum("_n").over(Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .select("_shard", "_offset")
    )
    pos = F.col("_offset") + F.col("_pos")
    return placed.join(F.broadcast(offsets), "_shard", "inner").select(
        key, pos.alias("batch_pos"), F.floor(pos / F.lit(size)).cast("bigint").alias("batch_no")
    )


def assign_batches(
    df: DataFrame,
    key: str = "customer_id",
    size: int = 999,
    shards: int | None = None,
) -> DataFrame:
    """Add ``batch_pos`` (0-based rank by ``key``) and ``batch_no = batch_pos div size``.

    Every batch has ``size`` rows but the last.  ``key`` must be unique and not
    null.  Only keys are ranged and checkpointed (``batch_numbers``); their
    numbers are joined to the rows by key, which contact rows are already
    partitioned by.  ``df`` is evaluated twice, the first time for its keys
    alone, so it should read stored tables (``Store``) where sources can change.
    """
    return df.join(batch_numbers(df.select(key), size, shards), key)
