"""Reason lists given as tables."""

import pytest
from pyspark.sql import functions as F

from clientele.functions.reasons import BAD_CANCEL_REASONS, BAD_RETURN_REASONS, MATCH_MODES, with_reason_flag
from clientele.operators.facts import flag_items
from clientele.plans.inspect import plan_text
from clientele.sources.fixtures import FIXTURE_AS_OF


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def long_list(spark, reasons, n=100_000):
    """``reasons``, some of them twice, among ``n`` that no item has, and a NULL."""
    some = spark.createDataFrame([(r,) for r in [*reasons, reasons[0], None]], "reason string")
    return some.union(spark.range(n).select(F.concat(F.lit("reason "), F.col("id"))))


@pytest.mark.parametrize("match", MATCH_MODES)
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_a_long_table_flags_what_the_list_flags(spark, stored, match, threshold):
    """Broadcast or, where the table is too large for it, shuffled."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = flag_items(
            stored["items"], FIXTURE_AS_OF, match=match,
            bad_cancel_reasons=long_list(spark, BAD_CANCEL_REASONS), bad_return_reasons=long_list(spark, BAD_RETURN_REASONS),
        )
        want = flag_items(stored["items"], FIXTURE_AS_OF, match=match)
        assert got.dtypes == want.dtypes and same(got, want)
        assert want.agg(F.sum("is_bad_cancel_reason")).first()[0] > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_odd_reasons(spark):
    rows = [(1, None), (2, ""), (3, "Late"), (4, "late  "), (5, "other")]
    items = spark.createDataFrame(rows, "id_sales_order_item long, why string")
    for reasons, match, bad in (
        (["Late", "", None], "exact", {2, 3}), (["LATE"], "ci", {3, 4}), ([None], "exact", set()), ([], "ci", set()),
    ):
        table = spark.createDataFrame([(r,) for r in reasons], "r string")
        got = with_reason_flag(items, "why", "bad", table, match)
        assert {r[0]: r[2] for r in got.collect()} == {i: int(i in bad) for i, _ in rows}
        assert got.columns == ["id_sales_order_item", "why", "bad"]
    with pytest.raises(ValueError, match="match must be"):
        with_reason_flag(items, "why", "bad", items.select("why"), "other")


def test_items_without_reason_are_spread(spark):
    """Shuffled by reason, a hundred thousand items without one don't meet in one task."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        items = spark.range(100_000).select(F.col("id").alias("id_sales_order_item"), F.lit(None).cast("string").alias("why"))
        table = spark.createDataFrame([("a",)], "r string")
        flagged = with_reason_flag(items, "why", "bad", table)
        assert "BroadcastHashJoin" not in plan_text(flagged)
        sizes = [r["count"] for r in flagged.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 100_000 and max(sizes) < 2 * 100_000 / len(sizes) and len(sizes) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
