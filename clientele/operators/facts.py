"""Verified sales items, their service-level and reason flags, and the item facts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.reasons import BAD_CANCEL_REASONS, BAD_RETURN_REASONS, with_reason_flag
from clientele.functions.timefns import as_of_literal, sla_broken


def flag_items(
    items: DataFrame,
    as_of,
    *,
    ship_sla_days: int = 3,
    refund_sla_days: int = 7,
    bad_cancel_reasons: Iterable[str] | DataFrame = BAD_CANCEL_REASONS,
    bad_return_reasons: Iterable[str] | DataFrame = BAD_RETURN_REASONS,
    match: str = "exact",
) -> DataFrame:
    """Financially verified items only, with four integer flags added.

    * ``is_ship_broken_sla``: 1 when shipping took (or, unshipped, has taken
      by ``as_of``) more than ``ship_sla_days`` whole days, else NULL;
    * ``is_refund_broken_sla``: the same from ready-for-refund to refund
      completed, ``refund_sla_days``;
    * ``is_bad_cancel_reason`` / ``is_bad_return_reason``: 1 or 0; the reasons
      are a list, or a DataFrame for lists too long for one (``with_reason_flag``).

    The verified filter is a plain ``IS NOT NULL`` and reaches the scan.
    """
    now = as_of_literal(as_of)
    flagged = items.filter(F.col("finance_verified_at").isNotNull()).withColumns(
        {
            "is_ship_broken_sla": sla_broken(F.col("created_at"), F.col("shipped_at"), now, ship_sla_days),
            "is_refund_broken_sla": sla_broken(
                F.col("ready_for_refund_at"), F.col("refund_completed_at"), now, refund_sla_days
            ),
        }
    )
    flagged = with_reason_flag(flagged, "cancel_reason", "is_bad_cancel_reason", bad_cancel_reasons, match)
    return with_reason_flag(flagged, "return_reason", "is_bad_return_reason", bad_return_reasons, match)


def order_attributes(orders: DataFrame) -> DataFrame:
    """Order columns the metrics use; orders without a customer are dropped.

    A NULL customer id stopped the source job; here such orders simply
    cannot belong to any profile.
    """
    return orders.filter(F.col("customer_id").isNotNull()).select(
        "id_sales_order",
        "customer_id",
        "order_nr",
        "status",
        F.col("created_at").alias("order_created_at"),
    )


def item_facts(orders: DataFrame, items: DataFrame, as_of, **flag_options) -> DataFrame:
    """One row per verified item with its order's customer, number, status and time.

    The order-to-item outer join becomes an inner join because only verified
    items are kept; Catalyst plans it as a sort-merge join on the order id,
    or a broadcast join when adaptive execution measures one side as small.
    """
    flagged = flag_items(items, as_of, **flag_options)
    return flagged.join(order_attributes(orders), F.col("fk_sales_order") == F.col("id_sales_order"), "inner")
