"""Counts of dropped rows, taken by the jobs that run anyway."""

import uuid

import pytest
from pyspark.sql import functions as F

from clientele.functions.reasons import BAD_CANCEL_REASONS, BAD_RETURN_REASONS
from clientele.operators.losses import Losses
from clientele.plans.contact_job import run_contact_export
from clientele.session import checkpoint_dir
from clientele.sources.fixtures import FIXTURE_AS_OF


def out_path(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/losses-{uuid.uuid4().hex}"


def expected(tables):
    items = tables["items"]
    verified = items.where("finance_verified_at is not null")

    def unlisted(column, reasons):
        return verified.where(F.col(column).isNotNull() & ~F.col(column).isin(list(reasons))).count()

    return {
        "orders_without_customer": tables["orders"].where("customer_id is null").count(),
        "unverified_items": items.count() - verified.count(),
        "unlisted_cancel_reasons": unlisted("cancel_reason", BAD_CANCEL_REASONS),
        "unlisted_return_reasons": unlisted("return_reason", BAD_RETURN_REASONS),
    }


@pytest.fixture(scope="module")
def tables(stored):
    """Some orders have no customer."""
    orders = stored["orders"].withColumn("customer_id", F.when(F.col("id_sales_order") % 10 > 0, F.col("customer_id")))
    return {**stored, "orders": orders}


def test_counts_equal_sql(spark, tables):
    stats = run_contact_export(spark, tables, FIXTURE_AS_OF, out_path(spark), batch_size=60, count_losses=True)
    want = expected(tables)
    assert {k: stats[k] for k in want} == want and all(want.values())
    # contacts without e-mail are those that --require-email leaves out
    with_email = run_contact_export(spark, tables, FIXTURE_AS_OF, out_path(spark), batch_size=60, require_email=True)
    assert stats["contacts_without_email"] == stats["contacts"] - with_email["contacts"] > 0
    assert set(with_email) == {"batches", "contacts"}


def test_counting_adds_no_job(spark, tables):
    def jobs(**options):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, "losses")
        run_contact_export(spark, tables, FIXTURE_AS_OF, out_path(spark), **options)
        spark.sparkContext.setJobGroup("", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(count_losses=True) <= jobs()


def test_reason_tables_have_no_unlisted_counter(spark, tables):
    reasons = spark.createDataFrame([(r,) for r in BAD_CANCEL_REASONS], "r string")
    stats = run_contact_export(
        spark, tables, FIXTURE_AS_OF, out_path(spark), count_losses=True, bad_cancel_reasons=reasons
    )
    want = expected(tables)
    del want["unlisted_cancel_reasons"]
    assert "unlisted_cancel_reasons" not in stats and {k: stats[k] for k in want} == want


def test_empty_sources(spark, tables):
    empty = {n: df.limit(0) for n, df in tables.items()}
    stats = run_contact_export(spark, empty, FIXTURE_AS_OF, out_path(spark), count_losses=True)
    assert stats["contacts"] == 0 and not any(stats.values())


def test_a_frame_is_counted_once(spark):
    losses = Losses()
    df = losses.watch(spark.range(100), odd=F.col("id") % 2 == 1, none=F.col("id") < 0)
    assert df.count() == 100 and df.count() == 100
    assert losses.counts() == {"odd": 50, "none": 0}
