"""E-mail lookup and the wide contact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.buckets import BUCKETS
from clientele.functions.timefns import as_of_literal, minus_days
from clientele.operators.metrics import PROFILE_COLUMNS, active_customers


def recent_customer_emails(
    customers: DataFrame, storefront_orders: DataFrame, as_of, days: int = 90
) -> DataFrame:
    """``(customer_id, email)`` of customers with a storefront order in the last ``days`` days.

    Only customer columns were ever read, so the order side is a semi join.
    The recent orders are reduced to distinct customer ids first (partial
    aggregation before the shuffle), so a customer with a huge number of
    orders sends one row per map task, not all of them.  Duplicate customer
    rows keep the smallest e-mail, a deterministic stand-in for the source's
    "last row wins".
    """
    since = minus_days(as_of_literal(as_of), days)
    buyers = (
        storefront_orders.filter(F.col("created_at") >= since)
        .select(F.col("fk_customer").alias("id_customer"))
        .filter(F.col("id_customer").isNotNull())
        .distinct()
    )
    return (
        customers.join(buyers, "id_customer", "left_semi")
        .groupBy("id_customer")
        .agg(F.min("email").alias("email"))
        .withColumnRenamed("id_customer", "customer_id")
    )


CONTACT_COLUMNS = (
    "customer_id",
    "email",
    *PROFILE_COLUMNS[1:],
    "last_cancel_date",
    "last_cancel_reason",
    "last_bad_cancel_date",
    "last_bad_cancel_reason",
    "last_return_date",
    "last_return_reason",
    "last_bad_return_date",
    "last_bad_return_reason",
    "last_order_status",
    *[c for spec in BUCKETS.values() for c in (spec.column, spec.count_column, spec.ratio_column)],
)


def contact_table(
    metrics: DataFrame,
    emails: DataFrame,
    as_of,
    *,
    active_days: int = 30,
    require_email: bool = False,
) -> DataFrame:
    """One typed row per active customer: profile, last events, habits, e-mail.

    All metric families come from one ``customer_metrics`` row, so the only
    join is the e-mail lookup, on ``customer_id`` with both sides already
    hash-partitioned by it.  Customers without an e-mail stay (with NULL)
    unless ``require_email``.  Each favourite-bucket ratio is that bucket's
    order count over the customer's order count (NULL when undefined).
    """
    active = active_customers(metrics, as_of, active_days)
    joined = active.join(emails, "customer_id", "inner" if require_email else "left")
    ratios = {
        spec.ratio_column: F.try_divide(
            F.col(spec.count_column).cast("double"), F.col("order_count").cast("double")
        )
        for spec in BUCKETS.values()
    }
    return joined.withColumns(ratios).select(*CONTACT_COLUMNS)
