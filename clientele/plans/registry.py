"""Named queries over the test tables: the Spark side of every oracle check.

Each entry takes ``(spark, sf_dir)``, derives the canonical input tables
from the test tables at ``sf_dir`` and returns a DataFrame over all rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.reasons import BAD_CANCEL_REASONS, BAD_RETURN_REASONS
from clientele.operators.batching import assign_batches
from clientele.operators.contacts import contact_table, recent_customer_emails
from clientele.operators.events import last_event
from clientele.operators.export import contact_export, contact_payloads, write_payloads
from clientele.operators.facts import item_facts
from clientele.operators.habits import favourite_bucket
from clientele.operators.metrics import (
    active_customers,
    customer_metrics,
    customer_profile,
    orders_of_active_customers,
)
from clientele.plans.contact_job import build_contacts
from clientele.plans.sql_twins import BATCH_SIZE_SF001
from clientele.session import checkpoint_dir
from clientele.sources.fixtures import FIXTURE_AS_OF, fixture_tables
from clientele.sources.store import Store

Query = Callable[[SparkSession, str], DataFrame]


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixture_tables(spark, sf_dir)
    return item_facts(t["orders"], t["items"], FIXTURE_AS_OF)


def _flags_by_reason_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bad reasons come as a table: here all that have an odd number of characters."""
    t = fixture_tables(spark, sf_dir)
    reasons = t["items"].where("length(cancel_reason) % 2 = 1").select("cancel_reason")
    facts = item_facts(t["orders"], t["items"], FIXTURE_AS_OF, bad_cancel_reasons=reasons)
    return facts.select("fk_sales_order", "id_sales_order_item", "cancel_reason", "is_bad_cancel_reason")


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixture_tables(spark, sf_dir)
    return customer_metrics(t["orders"], t["items"], FIXTURE_AS_OF)


def _active_metrics(t: dict[str, DataFrame], habits: bool) -> DataFrame:
    orders = orders_of_active_customers(t["orders"], t["items"], FIXTURE_AS_OF)
    return customer_metrics(orders, t["items"], FIXTURE_AS_OF, habits=habits)


def _contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixture_tables(spark, sf_dir)
    metrics = _active_metrics(t, habits=True)
    emails = recent_customer_emails(t["customers"], t["storefront_orders"], FIXTURE_AS_OF)
    return contact_table(metrics, emails, FIXTURE_AS_OF)


def _contacts_from_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By stored steps; the result is checkpointed, so that the stored tables can go."""
    checkpoint_dir(spark)
    with Store(spark) as store:
        return build_contacts(fixture_tables(spark, sf_dir), FIXTURE_AS_OF, store=store).checkpoint(eager=True)


def _item_query(*cols: str) -> Query:
    return lambda spark, sf_dir: _facts(spark, sf_dir).select(*cols)


def _metric_query(*cols: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = fixture_tables(spark, sf_dir)
        metrics = customer_metrics(t["orders"], t["items"], FIXTURE_AS_OF, habits=False)
        return metrics.select("customer_id", *cols)

    return query


def _event_query(name: str, ts: str, value: str, only=None) -> Query:
    return lambda spark, sf_dir: last_event(
        _facts(spark, sf_dir), ts, value, only=only, ts_alias=f"{name}_date", value_alias=f"{name}_reason"
    )


def _bucket_query(kind: str) -> Query:
    return lambda spark, sf_dir: favourite_bucket(_facts(spark, sf_dir), kind)


def _item_facts(spark, sf_dir):
    return _facts(spark, sf_dir).select(
        "id_sales_order_item", "id_sales_order", "customer_id", "order_nr", "status", "order_created_at",
        "created_at", F.col("unit_price").cast("double").alias("unit_price"), "coupon_money_value",
        "cart_rule_discount", "canceled_at", "cancel_reason", "returned_at", "return_reason", "refund_reject_at",
        "is_ship_broken_sla", "is_refund_broken_sla", "is_bad_cancel_reason", "is_bad_return_reason",
    )


def _last_order_status(spark, sf_dir):
    return last_event(
        _facts(spark, sf_dir), "order_created_at", "status", require_ts=False, value_alias="last_order_status"
    ).select("customer_id", "last_order_status")


def _active_customers(spark, sf_dir):
    return active_customers(_active_metrics(fixture_tables(spark, sf_dir), habits=False), FIXTURE_AS_OF).select("customer_id", "last_order_date")


def _customer_profile(spark, sf_dir):
    return customer_profile(_active_metrics(fixture_tables(spark, sf_dir), habits=False), FIXTURE_AS_OF)


def _recent_emails(spark, sf_dir):
    t = fixture_tables(spark, sf_dir)
    return recent_customer_emails(t["customers"], t["storefront_orders"], FIXTURE_AS_OF)


def _contact_batches(spark, sf_dir):
    batched = assign_batches(_contacts(spark, sf_dir).select("customer_id"), "customer_id", BATCH_SIZE_SF001)
    return batched.select("customer_id", "batch_pos", "batch_no")


def _contact_export(spark, sf_dir):
    return contact_export(_contacts(spark, sf_dir), FIXTURE_AS_OF, keep=())


def _contact_payloads(spark, sf_dir):
    batched = assign_batches(_contacts(spark, sf_dir), "customer_id", BATCH_SIZE_SF001)
    return contact_payloads(contact_export(batched, FIXTURE_AS_OF))


def _written_payloads(spark, sf_dir):
    """What the payload sink holds after a second run replaced the first."""
    checkpoint_dir(spark)
    with Store(spark) as store:
        path = f"{store.folder}/payloads"
        payloads = store.keep(_contact_payloads(spark, sf_dir), "made")
        write_payloads(payloads.withColumn("payload", F.lit("old")), path)
        write_payloads(payloads, path)
        return spark.read.parquet(path).checkpoint(eager=True)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "item_facts": _item_facts,
        "ship_sla_flag": _item_query("fk_sales_order", "id_sales_order_item", "created_at", "shipped_at", "is_ship_broken_sla"),
        "refund_sla_flag": _item_query(
            "fk_sales_order", "id_sales_order_item", "ready_for_refund_at", "refund_completed_at", "is_refund_broken_sla"
        ),
        "bad_cancel_flag": _item_query("fk_sales_order", "id_sales_order_item", "cancel_reason", "is_bad_cancel_reason"),
        "bad_return_flag": _item_query("fk_sales_order", "id_sales_order_item", "return_reason", "is_bad_return_reason"),
        "bad_cancel_flag_table": _flags_by_reason_table,
        "avg_item_price": _metric_query("avg_item_price"),
        "avg_basket_size": _metric_query("avg_basket_size"),
        "last_refund_reject": _metric_query("last_refund_reject_date"),
        "last_voucher_date": _metric_query("last_voucher_date"),
        "last_cart_rule_date": _metric_query("last_cart_rule_date"),
        "last_ship_breach": _metric_query("last_ship_broken_sla_date"),
        "last_refund_breach": _metric_query("last_refund_broken_sla_date"),
        "cancel_return_ratios": _metric_query("cancel_ratio", "return_ratio"),
        "refund_reject_ratio": _metric_query("refund_reject_ratio"),
        "voucher_order_ratio": _metric_query("order_voucher_ratio"),
        "cart_rule_order_ratio": _metric_query("order_cart_rule_ratio"),
        "bad_cancel_ratio": _metric_query("bad_cancellation_ratio"),
        "bad_return_ratio": _metric_query("bad_return_ratio"),
        "ship_sla_ratio": _metric_query("ship_broken_sla_ratio"),
        "refund_sla_ratio": _metric_query("refund_broken_sla_ratio"),
        "order_count": _metric_query("order_count", "item_count"),
        "active_customers": _active_customers,
        "customer_profile": _customer_profile,
        "last_cancel": _event_query("last_cancel", "canceled_at", "cancel_reason"),
        "last_bad_cancel": _event_query("last_bad_cancel", "canceled_at", "cancel_reason", BAD_CANCEL_REASONS),
        "last_return": _event_query("last_return", "returned_at", "return_reason"),
        "last_bad_return": _event_query("last_bad_return", "returned_at", "return_reason", BAD_RETURN_REASONS),
        "last_order_status": _last_order_status,
        "favourite_hour": _bucket_query("hour"),
        "favourite_weekday": _bucket_query("weekday"),
        "favourite_monthday": _bucket_query("monthday"),
        "favourite_month": _bucket_query("month"),
        "recent_emails": _recent_emails,
        "customer_metrics": _metrics,
        "contact_table": _contacts,
        "contact_table_snapshot": _contacts_from_snapshot,
        "contact_batches": _contact_batches,
        "contact_export": _contact_export,
        "contact_payloads": _contact_payloads,
        "written_payloads": _written_payloads,
    }
    return q
