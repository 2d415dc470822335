"""All per-customer metrics in one pass over the items and orders.

The source job ran ten queries, each joining orders with items again and
each grouping by customer.  Here the metrics are folded into three
aggregation levels that every metric can be split into:

1. **per order** (``fk_sales_order``): items are combined before the join,
   and so are rows of one order, so neither an order with very many items nor
   a pile of copies of one order is shuffled row by row;
2. **per (customer, order number)**: exact distinct-order counts, including
   the conditional ones (voucher / cart-rule orders), without the ``Expand``
   that several ``COUNT(DISTINCT ...)`` would need;
3. **per customer**: sums and maxima.

Each level is an ordinary ``groupBy().agg()``, so Spark aggregates
partially before every shuffle, and level 2 is keyed by (customer, order
number): a customer or an order holding a third of all rows is spread or
reduced to one row per map task before it reaches a reducer.  Catalyst prunes
the aggregates a caller does not select, so a query for one metric family
reads and computes only what that family needs.

The "latest event" metrics are ``max(struct(time, text))``.  The calendar
habits are counted from level 2 as well, which carries the buckets of an order
number as bits (``habits_of``).  With a ``Store``, level 1 is written once and all
branches read it; without one, Spark computes what the habits need of it a
second time, on few columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.timefns import as_of_literal, minus_days, plus_days
from clientele.operators.facts import flag_items, order_attributes
from clientele.operators.habits import HABIT_COLUMNS, MASK_COLUMNS, bucket_masks, habits_of
from clientele.sources.store import Store


def _event(at: Column, value: Column) -> Column:
    return F.struct(at.alias("at"), value.alias("value"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def _order_partials(flagged: DataFrame, ship_sla_days: int, refund_sla_days: int) -> DataFrame:
    def event(ts: str, kind: str) -> Column:
        return _event(F.col(ts), F.col(f"{kind}_reason"))

    item = F.col("id_sales_order_item")
    created = F.col("created_at")
    # A NULL voucher value counts as used: ``NULL = 0`` is not true.
    voucher_used = F.coalesce(F.col("coupon_money_value") != 0, F.lit(True))
    cart_rule_used = F.coalesce(F.col("cart_rule_discount") != 0, F.lit(True))
    canceled = F.col("canceled_at").isNotNull()
    returned = F.col("returned_at").isNotNull()
    return flagged.groupBy("fk_sales_order").agg(
        F.count(item).alias("n_items"),
        F.sum("unit_price").alias("sum_price"),
        F.max(created).alias("last_item_at"),
        F.max("refund_reject_at").alias("last_refund_reject_at"),
        F.max(F.when(voucher_used, created)).alias("last_voucher_at"),
        F.max(F.when(cart_rule_used, created)).alias("last_cart_rule_at"),
        F.bool_or(voucher_used).alias("has_voucher"),
        F.bool_or(cart_rule_used).alias("has_cart_rule"),
        F.count("canceled_at").alias("n_canceled"),
        F.count("returned_at").alias("n_returned"),
        F.count("refund_reject_at").alias("n_refund_reject"),
        F.count(F.when(F.col("is_bad_cancel_reason") == 1, item)).alias("n_bad_cancel"),
        F.count(F.when(F.col("is_bad_return_reason") == 1, item)).alias("n_bad_return"),
        F.count(F.when(F.col("is_ship_broken_sla") == 1, item)).alias("n_ship_broken"),
        F.count(F.when(F.col("is_refund_broken_sla") == 1, item)).alias("n_refund_broken"),
        F.max(F.when(F.col("is_ship_broken_sla") == 1, plus_days(created, ship_sla_days))).alias(
            "last_ship_breach_at"
        ),
        F.max(
            F.when(F.col("is_refund_broken_sla") == 1, plus_days(F.col("ready_for_refund_at"), refund_sla_days))
        ).alias("last_refund_breach_at"),
        F.max(F.when(canceled, event("canceled_at", "cancel"))).alias("last_cancel"),
        F.max(F.when(canceled & (F.col("is_bad_cancel_reason") == 1), event("canceled_at", "cancel"))).alias(
            "last_bad_cancel"
        ),
        F.max(F.when(returned, event("returned_at", "return"))).alias("last_return"),
        F.max(F.when(returned & (F.col("is_bad_return_reason") == 1), event("returned_at", "return"))).alias(
            "last_bad_return"
        ),
    )


_SUMMED = (
    "n_items",
    "sum_price",
    "n_canceled",
    "n_returned",
    "n_refund_reject",
    "n_bad_cancel",
    "n_bad_return",
    "n_ship_broken",
    "n_refund_broken",
)
_MAXED = (
    "last_item_at",
    "last_refund_reject_at",
    "last_voucher_at",
    "last_cart_rule_at",
    "last_ship_breach_at",
    "last_refund_breach_at",
    "last_cancel",
    "last_bad_cancel",
    "last_return",
    "last_bad_return",
)


def orders_of_active_customers(orders: DataFrame, items: DataFrame, as_of, active_days: int = 30) -> DataFrame:
    """The orders of customers with a verified item at most ``active_days`` days before ``as_of``.

    ``max(created_at) >= X`` holds exactly when some verified item has
    ``created_at >= X``, so active customers are known from one narrow scan with
    both filters pushed down, before any metric is computed.  All orders of an
    active customer stay.
    """
    since = minus_days(as_of_literal(as_of), active_days)
    recent = (
        items.filter(F.col("finance_verified_at").isNotNull() & (F.col("created_at") >= since))
        .select(F.col("fk_sales_order").alias("id_sales_order"))
        .distinct()
    )
    active = (
        orders.filter(F.col("customer_id").isNotNull())
        .select("id_sales_order", "customer_id")
        .join(recent, "id_sales_order", "left_semi")
        .select("customer_id")
        .distinct()
    )
    return orders.join(active, "customer_id", "left_semi")


def order_rows(orders: DataFrame) -> DataFrame:
    """One row per order, customer and number: how many rows it stands for, latest status, calendar buckets."""
    created = F.col("order_created_at")
    return (
        order_attributes(orders)
        .groupBy("id_sales_order", "customer_id", "order_nr")
        .agg(
            F.count(F.lit(1)).alias("n_copies"),
            F.max(_event(created, F.col("status"))).alias("last_status"),
            *bucket_masks(created),
        )
    )


def order_level(
    rows: DataFrame, items: DataFrame, as_of, *, ship_sla_days: int = 3, refund_sla_days: int = 7, **reason_options
) -> DataFrame:
    """Level 1: the verified items of each of ``rows`` (see ``order_rows``), sums over its copies included."""
    flagged = flag_items(
        items, as_of, ship_sla_days=ship_sla_days, refund_sla_days=refund_sla_days, **reason_options
    )
    per_order = _order_partials(flagged, ship_sla_days, refund_sla_days)
    joined = per_order.join(rows, F.col("fk_sales_order") == F.col("id_sales_order"), "inner")
    return joined.select(
        "customer_id",
        "order_nr",
        *[(F.col(c) * F.col("n_copies")).alias(c) for c in _SUMMED],
        *_MAXED,
        "has_voucher",
        "has_cart_rule",
        "last_status",
        *MASK_COLUMNS,
    )


def _order_numbers(level: DataFrame, *more: Column) -> DataFrame:
    """Level 2: one row per customer and order number.

    Spark combines each group map-side, then shuffles by both keys: a hot
    customer or a hot order number is spread or reduced before any task sees it.
    """
    return level.groupBy("customer_id", "order_nr").agg(
        F.bool_or("has_voucher").alias("has_voucher"),
        F.bool_or("has_cart_rule").alias("has_cart_rule"),
        *[F.bit_or(c).alias(c) for c in MASK_COLUMNS],
        *more,
    )


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in _SUMMED] + [F.max(c).alias(c) for c in (*_MAXED, "last_status")]


def customer_metrics(
    orders: DataFrame, items: DataFrame, as_of, *, habits: bool = True, store: Store | None = None, **options
) -> DataFrame:
    """One typed row per customer with at least one verified item.

    No recency filter: ``customer_profile`` and ``contact_table`` apply it; pass
    ``orders_of_active_customers(...)`` as ``orders``, or use
    ``active_customer_metrics``, to compute active customers only.  ``options`` are
    ``ship_sla_days``, ``refund_sla_days`` and those of ``flag_items``
    (``bad_cancel_reasons``, ``bad_return_reasons``, ``match``).  ``habits=False``
    leaves out the favourite-bucket columns and the branch that computes them.
    With a ``store``, level 1 is written there now and the habits always come
    along; else nothing runs yet.
    """
    level = order_level(order_rows(orders), items, as_of, **options)
    if store is not None:
        return _metrics_of_stored(store.keep(level, "order_level"))
    numbers = _order_numbers(level, *_sums())
    order_nr = F.col("order_nr")
    per_customer = numbers.groupBy("customer_id").agg(
        *_sums(),
        F.count(order_nr).alias("order_count"),
        F.count(F.when(F.col("has_voucher"), order_nr)).alias("voucher_orders"),
        F.count(F.when(F.col("has_cart_rule"), order_nr)).alias("cart_rule_orders"),
    )
    metrics = _metric_columns(per_customer)
    return metrics.join(habits_of(numbers), "customer_id", "left") if habits else metrics


def active_customer_metrics(
    orders: DataFrame, items: DataFrame, as_of, store: Store, *, active_days: int = 30, **options
) -> DataFrame:
    """``customer_metrics`` of active customers, by stored steps.

    The order rows of active customers are stored first.  Joined with the
    items, they let Spark build a Bloom filter of their order ids and apply it
    in the item scan (``spark.sql.optimizer.runtime.bloomFilter.*``, set by
    ``build_session``): items of other customers are dropped before they are
    aggregated or shuffled.  The comparison on ``n_copies`` holds for every row;
    Catalyst takes it as the sign that the rows are a selection.
    """
    active = orders_of_active_customers(orders, items, as_of, active_days)
    rows = store.keep(order_rows(active), "active_order_rows").where(F.col("n_copies") > 0)
    return _metrics_of_stored(store.keep(order_level(rows, items, as_of, **options), "order_level"))


def _metrics_of_stored(level: DataFrame) -> DataFrame:
    """All metrics from the stored level 1, which both branches read.

    Sums and maxima need no order numbers and go to the customer at once, so the
    wide rows are shuffled by customer only; the distinct counts and the habits
    are counted together from few columns.
    """
    flags = {"order_count": F.lit(True), "voucher_orders": F.col("has_voucher"), "cart_rule_orders": F.col("has_cart_rule")}
    counted = habits_of(_order_numbers(level), flags)
    joined = level.groupBy("customer_id").agg(*_sums()).join(counted, "customer_id", "left")
    counts = {name: F.coalesce(name, F.lit(0).cast("bigint")) for name in flags}
    return _metric_columns(joined.withColumns(counts), *HABIT_COLUMNS)


def _metric_columns(per_customer: DataFrame, *more: str) -> DataFrame:
    """Level 3: the metrics of a customer from the sums, maxima and counts."""
    n_items = F.col("n_items")
    order_count = F.col("order_count")
    return per_customer.select(
        "customer_id",
        _ratio(F.col("sum_price"), n_items).alias("avg_item_price"),
        F.try_divide(n_items, order_count).cast("bigint").alias("avg_basket_size"),
        F.col("last_refund_reject_at").alias("last_refund_reject_date"),
        F.col("last_voucher_at").alias("last_voucher_date"),
        F.col("last_cart_rule_at").alias("last_cart_rule_date"),
        _ratio(F.col("n_canceled"), n_items).alias("cancel_ratio"),
        _ratio(F.col("n_returned"), n_items).alias("return_ratio"),
        _ratio(F.col("n_refund_reject"), n_items).alias("refund_reject_ratio"),
        _ratio(F.col("voucher_orders"), order_count).alias("order_voucher_ratio"),
        _ratio(F.col("cart_rule_orders"), order_count).alias("order_cart_rule_ratio"),
        F.col("last_ship_breach_at").alias("last_ship_broken_sla_date"),
        F.col("last_refund_breach_at").alias("last_refund_broken_sla_date"),
        _ratio(F.col("n_bad_cancel"), n_items).alias("bad_cancellation_ratio"),
        _ratio(F.col("n_bad_return"), n_items).alias("bad_return_ratio"),
        _ratio(F.col("n_ship_broken"), n_items).alias("ship_broken_sla_ratio"),
        _ratio(F.col("n_refund_broken"), n_items).alias("refund_broken_sla_ratio"),
        order_count,
        n_items.alias("item_count"),
        F.col("last_item_at").alias("last_order_date"),
        *_event_columns(),
        *more,
    )


# latest-event output columns: (aggregate column, date column, text column)
_EVENTS = (
    ("last_cancel", "last_cancel_date", "last_cancel_reason"),
    ("last_bad_cancel", "last_bad_cancel_date", "last_bad_cancel_reason"),
    ("last_return", "last_return_date", "last_return_reason"),
    ("last_bad_return", "last_bad_return_date", "last_bad_return_reason"),
    ("last_status", None, "last_order_status"),
)


def _event_columns() -> list[Column]:
    """Date and text columns of the latest events."""
    out = []
    for agg, date, text in _EVENTS:
        if date:
            out.append(F.col(agg)["at"].alias(date))
        out.append(F.col(agg)["value"].alias(text))
    return out


PROFILE_COLUMNS = (
    "customer_id",
    "avg_item_price",
    "avg_basket_size",
    "last_refund_reject_date",
    "last_voucher_date",
    "last_cart_rule_date",
    "refund_reject_ratio",
    "order_voucher_ratio",
    "order_cart_rule_ratio",
    "last_ship_broken_sla_date",
    "last_refund_broken_sla_date",
    "bad_cancellation_ratio",
    "bad_return_ratio",
    "ship_broken_sla_ratio",
    "refund_broken_sla_ratio",
    "order_count",
    "last_order_date",
)


def active_customers(metrics: DataFrame, as_of, active_days: int = 30) -> DataFrame:
    """Customers whose latest verified item is at most ``active_days`` days before ``as_of``.

    The filter on the finished metrics.  ``orders_of_active_customers`` keeps
    the work for other customers from being done at all.
    """
    return metrics.filter(F.col("last_order_date") >= minus_days(as_of_literal(as_of), active_days))


def customer_profile(metrics: DataFrame, as_of, active_days: int = 30) -> DataFrame:
    """Spend, basket, voucher, cancellation, return and SLA metrics of active customers."""
    return active_customers(metrics, as_of, active_days).select(*PROFILE_COLUMNS)
