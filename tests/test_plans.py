"""Plan shape: what must hold for the job to scale."""

import re

import pytest

from clientele.operators.contacts import recent_customer_emails
from clientele.operators.metrics import customer_metrics, customer_profile, orders_of_active_customers
from clientele.plans.contact_job import build_contacts
from clientele.plans.inspect import plan_summary, plan_text, scan_filters
from clientele.plans.registry import queries
from clientele.sources.fixtures import FIXTURE_AS_OF
from conftest import SF01


def profile(t):
    orders = orders_of_active_customers(t["orders"], t["items"], FIXTURE_AS_OF)
    return customer_profile(customer_metrics(orders, t["items"], FIXTURE_AS_OF, habits=False), FIXTURE_AS_OF)


def test_contact_table_plan(stored):
    df = build_contacts(stored, FIXTURE_AS_OF)
    s = plan_summary(df)
    assert s["single_partition_exchange"] == 0
    assert s["expand"] == 0, "distinct counts must not fan rows out"
    assert s["python_udf"] == 0
    assert s["window"] == 0, "top-1 picks are aggregates, not windows"
    assert s["explicit_repartition"] == 0


def test_verified_and_activity_filters_reach_the_scan(stored):
    filters = scan_filters(profile(stored))
    assert any("IsNotNull(finance_verified_at)" in f for f in filters), filters
    assert any("GreaterThanOrEqual(created_at" in f and "finance_verified_at" in f for f in filters), filters


@pytest.mark.parametrize("name", ["customer_metrics", "contact_table"])
def test_generated_methods_fit_the_jit(spark, stored, name):
    """HotSpot compiles no method above 8,000 bytes."""
    build = {
        "customer_metrics": lambda: customer_metrics(stored["orders"], stored["items"], FIXTURE_AS_OF),
        "contact_table": lambda: build_contacts(stored, FIXTURE_AS_OF),
    }
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that every stage's code is shown
    try:
        text = plan_text(build[name](), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000, sizes


def test_single_metric_reads_only_its_columns(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        metrics = customer_metrics(stored["orders"], stored["items"], FIXTURE_AS_OF, habits=False)
        text = plan_text(metrics.select("customer_id", "avg_item_price"), "formatted")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    item_scans = [l for l in text.splitlines() if "ReadSchema" in l and "unit_price" in l]
    assert item_scans, text
    for line in item_scans:
        for unused in ("cancel_reason", "return_reason", "canceled_at", "returned_at", "shipped_at"):
            assert unused not in line, line


def test_recent_orders_filter_is_pushed_to_the_scan(stored):
    df = recent_customer_emails(stored["customers"], stored["storefront_orders"], FIXTURE_AS_OF)
    filters = scan_filters(df)
    assert any("GreaterThanOrEqual(created_at" in f for f in filters), filters
    assert "LeftSemi" in plan_text(df, "simple")


def test_favourite_bucket_plan_has_no_window(spark):
    s = plan_summary(queries()["favourite_hour"](spark, SF01))
    assert s["window"] == 0 and s["single_partition_exchange"] == 0


def test_batching_has_no_single_partition_over_rows(spark):
    df = queries()["contact_batches"](spark, SF01)
    text = plan_text(df, "simple")
    # the only single-partition step is the running sum over per-shard counts
    assert text.count("Exchange SinglePartition") <= 1
    assert "BroadcastExchange" in text
