"""The calendar bucket (hour, weekday, day of month, month) a customer orders in most."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.buckets import BUCKETS, Bucket, bucket


def favourite_bucket(
    facts: DataFrame,
    kind: str,
    *,
    key: str = "customer_id",
    ts: str = "order_created_at",
    order_key: str = "order_nr",
) -> DataFrame:
    """Per ``key``: the bucket with the most distinct orders, and that count.

    ``kind`` is ``hour``, ``weekday`` (Sunday = 1), ``monthday`` or ``month``.
    Ties go to the smallest bucket.  The distinct count is planned by Spark
    in two levels (by key, bucket and order, then by key and bucket), so a
    large customer is spread over many tasks; the top-1 pick is a
    ``max`` over a packed (count, bucket) number with map-side combining, not a
    window that would gather a customer's rows in one task.
    """
    spec = bucket(kind)
    counts = (
        facts.filter(F.col(ts).isNotNull())
        .groupBy(key, spec.part(F.col(ts)).alias("bucket"))
        .agg(F.count_distinct(order_key).alias("n"))
        .filter(F.col("n") > 0)
    )
    # count * 64 + (63 - bucket): larger count first, then the smaller bucket
    # (every bucket value is below 64); one BIGINT keeps the pick a hash aggregate.
    packed = F.col("n") * F.lit(64) + (F.lit(63) - F.col("bucket"))
    top = counts.groupBy(key).agg(F.max(packed).alias("top"))
    return top.select(
        key,
        (F.lit(63) - F.pmod(F.col("top"), F.lit(64))).cast("int").alias(spec.column),
        F.floor(F.col("top") / F.lit(64)).cast("bigint").alias(spec.count_column),
    )


def bucket_masks(ts: Column) -> list[Column]:
    """Per kind the bits of the buckets that the rows of a group fall into, as an aggregate."""
    return [F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), spec.part(ts))).alias(mask) for mask, spec in _MASKS.items()]


_MASKS = {f"{kind}_mask": spec for kind, spec in BUCKETS.items()}
MASK_COLUMNS = tuple(_MASKS)
HABIT_COLUMNS = tuple(c for spec in BUCKETS.values() for c in (spec.column, spec.count_column))


def _set_bits(mask: str, base: int, spec: Bucket) -> Column:
    """``base`` plus the number of every set bit; nearly always it is one."""
    one = F.lit(1).cast("bigint")
    m = F.coalesce(F.col(mask), F.lit(0).cast("bigint"))
    every = F.sequence(F.lit(base + spec.values[0]), F.lit(base + spec.values[-1]))
    several = F.filter(every, lambda n: m.bitwiseAND(F.call_function("shiftleft", one, n - F.lit(base))) != 0)
    single = F.array(F.bit_count(m - 1) + F.lit(base))
    return F.when(m == 0, _none()).when(m.bitwiseAND(m - 1) == 0, single).otherwise(several)


def _none() -> Column:
    return F.array().cast("array<int>")


def habits_of(level: DataFrame, flags: dict[str, Column] | None = None) -> DataFrame:
    """Per customer: the favourite bucket of every kind and its count of distinct orders.

    ``level`` has one row per customer and order number with the masks of
    ``bucket_masks``, so a plain count of rows is the distinct count.  Each set
    bit gives a row numbered ``64 * kind + bucket``, and one maximum per kind
    picks the winner, as in ``favourite_bucket``.  Customers without a dated
    order have no row.  ``flags`` name columns that count the order numbers for
    which a condition holds; each is one more number.
    """
    flags = flags or {}
    first = 64 * len(BUCKETS)
    numbers = F.concat(
        *[_set_bits(mask, 64 * k, spec) for k, (mask, spec) in enumerate(_MASKS.items())],
        *[F.when(holds, F.array(F.lit(first + k))).otherwise(_none()) for k, holds in enumerate(flags.values())],
    )
    counts = (
        level.filter(F.col("order_nr").isNotNull())
        .select("customer_id", F.explode(numbers).alias("number"))
        .groupBy("customer_id", "number")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    kind = F.floor(F.col("number") / F.lit(64))
    packed = F.col("n") * F.lit(64) + (F.lit(63) - F.pmod(F.col("number"), F.lit(64)))
    top = counts.groupBy("customer_id").agg(
        *[F.max(F.when(kind == k, packed)).alias(f"top_{name}") for k, name in enumerate(BUCKETS)],
        *[F.max(F.when(F.col("number") == first + k, F.col("n"))).alias(name) for k, name in enumerate(flags)],
    )
    return top.select(
        "customer_id",
        *flags,
        *[
            column
            for name, spec in BUCKETS.items()
            for column in (
                (F.lit(63) - F.pmod(F.col(f"top_{name}"), F.lit(64))).cast("int").alias(spec.column),
                F.floor(F.col(f"top_{name}") / F.lit(64)).cast("bigint").alias(spec.count_column),
            )
        ],
    )
