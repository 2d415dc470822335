"""Hand-made cases for the semantics the source job relied on."""

import datetime as dt

from pyspark.sql import functions as F

from clientele.functions.reasons import BAD_CANCEL_REASONS, is_listed
from clientele.functions.timefns import hour_boundaries, sla_broken
from clientele.operators.facts import item_facts
from clientele.operators.events import last_event
from clientele.operators.habits import favourite_bucket
from clientele.operators.metrics import customer_metrics

AS_OF = "2020-01-10 00:00:00"
T = dt.datetime

ORDER_SCHEMA = "id_sales_order long, order_nr string, customer_id long, status string, created_at timestamp_ntz"
ITEM_SCHEMA = (
    "id_sales_order_item long, fk_sales_order long, unit_price decimal(18,2), coupon_money_value double, "
    "cart_rule_discount double, created_at timestamp_ntz, finance_verified_at timestamp_ntz, "
    "shipped_at timestamp_ntz, canceled_at timestamp_ntz, cancel_reason string, returned_at timestamp_ntz, "
    "return_reason string, ready_for_refund_at timestamp_ntz, refund_completed_at timestamp_ntz, "
    "refund_reject_at timestamp_ntz"
)


def item(i, order, created, **kw):
    from decimal import Decimal

    row = dict(
        id_sales_order_item=i, fk_sales_order=order, unit_price=Decimal("10.00"), coupon_money_value=0.0,
        cart_rule_discount=0.0, created_at=created, finance_verified_at=created, shipped_at=created,
        canceled_at=None, cancel_reason=None, returned_at=None, return_reason=None, ready_for_refund_at=None,
        refund_completed_at=None, refund_reject_at=None,
    )
    row.update(kw)
    return row


def frames(spark, orders, items):
    o = spark.createDataFrame(orders, ORDER_SCHEMA)
    cols = [c.split()[0] for c in ITEM_SCHEMA.split(", ")]
    i = spark.createDataFrame([tuple(r[c] for c in cols) for r in items], ITEM_SCHEMA)
    return o, i


def test_hour_boundaries_count_clock_hours(spark):
    df = spark.createDataFrame(
        [(T(2020, 1, 1, 0, 59), T(2020, 1, 1, 1, 1)), (T(2020, 1, 1, 1, 0), T(2020, 1, 1, 1, 59)),
         (T(2020, 1, 1, 23, 30), T(2020, 1, 3, 0, 10))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    got = [r[0] for r in df.select(hour_boundaries(F.col("a"), F.col("b"))).collect()]
    assert got == [1, 0, 25]


def test_sla_flag_uses_whole_days_over_limit(spark):
    start = T(2020, 1, 1, 12, 0)
    df = spark.createDataFrame(
        [(start, start + dt.timedelta(hours=95)), (start, start + dt.timedelta(hours=96)), (start, None),
         (T(2020, 1, 8, 0, 0), None), (None, None)],
        "s timestamp_ntz, d timestamp_ntz",
    )
    now = F.lit(T(2020, 1, 10)).cast("timestamp_ntz")
    got = [r[0] for r in df.select(sla_broken(F.col("s"), F.col("d"), now, 3)).collect()]
    assert got == [None, 1, 1, None, None]


def test_reason_matching_modes(spark):
    df = spark.createDataFrame([("Lost in Warehouse",), ("lost in warehouse  ",), (None,), ("other",)], "r string")
    exact = [r[0] for r in df.select(is_listed(F.col("r"), BAD_CANCEL_REASONS)).collect()]
    ci = [r[0] for r in df.select(is_listed(F.col("r"), BAD_CANCEL_REASONS, "ci")).collect()]
    assert exact == [True, False, False, False]
    assert ci == [True, True, False, False]


def test_null_coupon_counts_as_used_and_zero_does_not(spark):
    d = T(2020, 1, 5)
    orders = [(1, "A", 7, "F", d), (2, "B", 7, "F", d), (3, "C", 7, "F", d)]
    items = [item(1, 1, d, coupon_money_value=None), item(2, 2, d, coupon_money_value=0.0),
             item(3, 3, d + dt.timedelta(hours=1), coupon_money_value=0.5)]
    o, i = frames(spark, orders, items)
    r = customer_metrics(o, i, AS_OF).first()
    assert r["order_voucher_ratio"] == 2 / 3
    assert r["last_voucher_date"] == d + dt.timedelta(hours=1)
    assert r["avg_basket_size"] == 1


def test_two_reasons_at_one_time_largest_wins_and_null_ignored(spark):
    d = T(2020, 1, 5)
    orders = [(1, "A", 7, "F", d)]
    items = [item(1, 1, d, canceled_at=d, cancel_reason="Merchant - Out of stock"),
             item(2, 1, d, canceled_at=d, cancel_reason="Lost in Warehouse"),
             item(3, 1, d, canceled_at=d, cancel_reason=None),
             item(4, 1, d, canceled_at=d - dt.timedelta(days=1), cancel_reason="Zzz")]
    o, i = frames(spark, orders, items)
    m = customer_metrics(o, i, AS_OF).first()
    assert (m["last_cancel_date"], m["last_cancel_reason"]) == (d, "Merchant - Out of stock")
    assert (m["last_bad_cancel_date"], m["last_bad_cancel_reason"]) == (d, "Merchant - Out of stock")
    facts = i.join(o, i.fk_sales_order == o.id_sales_order)
    e = last_event(facts, "canceled_at", "cancel_reason").first()
    assert (e["canceled_at"], e["cancel_reason"]) == (d, "Merchant - Out of stock")


def test_only_reason_null_gives_null_reason(spark):
    d = T(2020, 1, 5)
    o, i = frames(spark, [(1, "A", 7, "F", d)], [item(1, 1, d, canceled_at=d, cancel_reason=None)])
    m = customer_metrics(o, i, AS_OF).first()
    assert m["last_cancel_date"] == d and m["last_cancel_reason"] is None
    assert m["last_bad_cancel_date"] is None


def test_customer_with_only_good_reasons_has_no_bad_event(spark):
    d = T(2020, 1, 5)
    o, i = frames(spark, [(1, "A", 7, "F", d)],
                  [item(1, 1, d, returned_at=d, return_reason="Changed mind")])
    m = customer_metrics(o, i, AS_OF).first()
    assert m["last_return_reason"] == "Changed mind"
    assert m["last_bad_return_date"] is None and m["bad_return_ratio"] == 0.0


def test_bucket_tie_goes_to_smallest_and_counts_distinct_orders(spark):
    orders = [(1, "A", 7, "F", T(2020, 1, 1, 15)), (2, "B", 7, "F", T(2020, 1, 2, 9)),
              (3, "C", 7, "F", T(2020, 1, 3, 15)), (4, "D", 7, "F", T(2020, 1, 4, 9))]
    items = [item(k, k, T(2020, 1, k)) for k in range(1, 5)] + [item(9, 3, T(2020, 1, 3))]
    o, i = frames(spark, orders, items)
    m = customer_metrics(o, i, AS_OF).first()
    assert (m["hour_of_day_most_order"], m["order_count_hod_most_order"]) == (9, 2)
    facts = i.join(o.withColumnRenamed("created_at", "order_created_at"), i.fk_sales_order == o.id_sales_order)
    f = favourite_bucket(facts, "hour").first()
    assert (f["hour_of_day_most_order"], f["order_count_hod_most_order"]) == (9, 2)


def test_weekday_counts_sunday_as_one(spark):
    sunday = T(2020, 1, 5, 10)
    o, i = frames(spark, [(1, "A", 7, "F", sunday)], [item(1, 1, sunday)])
    assert customer_metrics(o, i, AS_OF).first()["day_of_week_most_order"] == 1


def test_unverified_items_and_null_customers_are_ignored(spark):
    d = T(2020, 1, 5)
    orders = [(1, "A", 7, "F", d), (2, "B", None, "F", d)]
    items = [item(1, 1, d), item(2, 1, d, finance_verified_at=None), item(3, 2, d)]
    o, i = frames(spark, orders, items)
    rows = customer_metrics(o, i, AS_OF).collect()
    assert [(r["customer_id"], r["item_count"]) for r in rows] == [(7, 1)]


def test_same_order_number_on_two_orders_counts_once(spark):
    d = T(2020, 1, 5)
    orders = [(1, "A", 7, "F", d), (2, "A", 7, "O", d + dt.timedelta(hours=2))]
    items = [item(1, 1, d), item(2, 2, d)]
    o, i = frames(spark, orders, items)
    m = customer_metrics(o, i, AS_OF).first()
    assert m["order_count"] == 1 and m["avg_basket_size"] == 2
    assert m["last_order_status"] == "O"


def test_texts_that_change_between_evaluations_are_never_lost(spark):
    """Nothing is read ahead of the query itself: every evaluation gives the texts it sees."""
    d = T(2020, 1, 5)
    orders, items = frames(spark, [(1, "A", 7, "F", d)], [item(1, 1, d, canceled_at=d, cancel_reason="x")])
    changing = items.withColumn("cancel_reason", F.concat(F.lit("r"), F.floor(F.rand() * 1e9).cast("string")))
    for _ in range(3):
        row = customer_metrics(orders, changing, AS_OF).first()
        assert row["last_cancel_reason"].startswith("r")


def test_building_a_query_starts_no_job(spark):
    from clientele.operators.contacts import contact_table, recent_customer_emails
    from clientele.operators.metrics import orders_of_active_customers

    d = T(2020, 1, 5)
    orders, items = frames(spark, [(1, "A", 7, "F", d)], [item(1, 1, d)])
    customers = spark.createDataFrame([(7, "a@example.test")], "id_customer long, email string")
    storefront = spark.createDataFrame([(7, d)], "fk_customer long, created_at timestamp_ntz")
    spark.sparkContext.setJobGroup("build-only", "build-only")
    try:
        metrics = customer_metrics(orders_of_active_customers(orders, items, AS_OF), items, AS_OF)
        contact_table(metrics, recent_customer_emails(customers, storefront, AS_OF), AS_OF)
        last_event(item_facts(orders, items, AS_OF), "canceled_at", "cancel_reason")
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("build-only")) == []
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")


def test_reason_lists_matching_mode_and_sla_days_are_parameters(spark):
    d = T(2020, 1, 5)
    orders = [(1, "A", 7, "F", d)]
    items = [
        item(1, 1, d, canceled_at=d, cancel_reason="lost in warehouse ", shipped_at=d + dt.timedelta(hours=50)),
        item(2, 1, d, canceled_at=d - dt.timedelta(hours=1), cancel_reason="Custom reason"),
    ]
    o, i = frames(spark, orders, items)
    exact = customer_metrics(o, i, AS_OF).first()
    ci = customer_metrics(o, i, AS_OF, match="ci").first()
    custom = customer_metrics(o, i, AS_OF, bad_cancel_reasons=["Custom reason"]).first()
    strict = customer_metrics(o, i, AS_OF, ship_sla_days=1).first()
    assert exact["bad_cancellation_ratio"] == 0.0 and exact["last_bad_cancel_date"] is None
    assert ci["bad_cancellation_ratio"] == 0.5 and ci["last_bad_cancel_reason"] == "lost in warehouse "
    assert custom["last_bad_cancel_reason"] == "Custom reason"
    assert exact["ship_broken_sla_ratio"] == 0.0 and strict["ship_broken_sla_ratio"] == 0.5


def test_undefined_metrics_export_as_empty_text(spark):
    from clientele.operators.contacts import contact_table
    from clientele.operators.export import contact_export

    d = T(2020, 1, 8)
    o, i = frames(spark, [(1, None, 7, "F", d)], [item(1, 1, d)])
    metrics = customer_metrics(o, i, AS_OF)
    m = metrics.first()
    assert m["order_count"] == 0 and m["avg_basket_size"] is None and m["order_voucher_ratio"] is None
    assert m["hour_of_day_most_order"] is None and m["avg_item_price"] == 10.0
    emails = spark.createDataFrame([], "customer_id long, email string")
    row = contact_export(contact_table(metrics, emails, AS_OF), AS_OF).first().asDict()
    assert row["3"] == "" and row["4819"] == "7" and row["18126"] == "10.0"
    for fid in ("18130", "18146", "18147", "18156", "18157", "18158", "18159"):
        assert row[fid] == "", (fid, row[fid])
    assert row["18125"] == "2020-01-10"
