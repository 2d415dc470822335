"""Adapters from the TPC-H-like test tables to the canonical input tables.

The test tables have no cancellation, refund, voucher or verification
columns and only midnight order dates.  These rules derive them with integer
arithmetic and intervals that read the same in Spark and in the SQL oracle
(``clientele.plans.sql_twins``), so both sides see the same input.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the test fixture: "now" for every oracle comparison.
FIXTURE_AS_OF = "2001-08-02 00:00:00"

# Fixed values of the test fixture: reason texts chosen by ``h % 5`` and ``h % 4``
# (None = no reason given).
FIXTURE_CANCEL_REASONS = (
    "Merchant - Out of stock",
    "Lost in Warehouse",
    "Customer - Changed mind",
    "SC/Bob Error",
    None,
)
FIXTURE_RETURN_REASONS = ("Damaged item", "wrong color", "Changed mind", None)


# Each test table is one file with one row group, which Spark can only read in
# one task.  Hash-partitioning the two order-keyed tables on the order key
# lets the derivation run in parallel (the item times need the order join) and
# writes the stored tables as several files, like production tables.
_ORDER_KEYED = {"lineitem": "l_orderkey", "orders": "o_orderkey"}


def _read(spark: SparkSession, sf_dir: str, name: str, by_order: bool = True) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    key = _ORDER_KEYED.get(name)
    if key is None or not by_order:
        return df
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key)


def _hours(n: Column) -> Column:
    return F.make_dt_interval(hours=n)


def _pick(selector: Column, texts: tuple) -> Column:
    out = None
    for i, text in enumerate(texts):
        value = F.lit(text) if text is not None else F.lit(None).cast("string")
        out = F.when(selector == i, value) if out is None else out.when(selector == i, value)
    return out


def _order_created_at(o: DataFrame) -> Column:
    return o["o_orderdate"] + _hours((o["o_orderkey"] * 7) % 24)


def sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    return o.select(
        o["o_orderkey"].alias("id_sales_order"),
        F.concat(F.lit("SO"), o["o_orderkey"].cast("string")).alias("order_nr"),
        o["o_custkey"].alias("customer_id"),
        o["o_orderstatus"].alias("status"),
        _order_created_at(o).alias("created_at"),
    )


def sales_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    o = _read(spark, sf_dir, "orders")
    orders = o.select(o["o_orderkey"], _order_created_at(o).alias("order_created_at"))
    j = li.join(orders, li["l_orderkey"] == orders["o_orderkey"], "inner")
    h = F.col("l_orderkey") * 7 + F.col("l_partkey") * 13 + F.col("l_suppkey") * 17 + F.col("l_linenumber")
    created = F.col("order_created_at") + F.make_dt_interval(mins=F.col("l_partkey") % 60)
    canceled = (F.col("l_linestatus") == "F") & (h % 3 == 0)
    returned = F.col("l_returnflag") == "R"
    null_ts = F.lit(None).cast("timestamp_ntz")
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_sales_order_item"),
        F.col("l_orderkey").alias("fk_sales_order"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("unit_price"),
        F.when(h % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("l_discount")).alias("coupon_money_value"),
        F.when(h % 13 == 0, F.lit(None).cast("double")).otherwise(F.col("l_tax")).alias("cart_rule_discount"),
        created.alias("created_at"),
        F.when(h % 10 == 0, null_ts).otherwise(created + _hours(F.lit(1))).alias("finance_verified_at"),
        F.when(h % 7 == 0, null_ts).otherwise(created + _hours(h % 200)).alias("shipped_at"),
        F.when(canceled, created + _hours(h % 48)).alias("canceled_at"),
        F.when(canceled, _pick(h % 5, FIXTURE_CANCEL_REASONS)).alias("cancel_reason"),
        F.when(returned, created + _hours(240 + h % 72)).alias("returned_at"),
        F.when(returned, _pick(h % 4, FIXTURE_RETURN_REASONS)).alias("return_reason"),
        F.when(returned, created + _hours(F.lit(336))).alias("ready_for_refund_at"),
        F.when(returned & (h % 4 != 0), created + _hours(336 + h % 300)).alias("refund_completed_at"),
        F.when((F.col("l_returnflag") == "A") & (h % 6 == 0), created + _hours(F.lit(288))).alias(
            "refund_reject_at"
        ),
    )


def store_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    return c.filter(c["c_custkey"] % 17 != 0).select(
        c["c_custkey"].alias("id_customer"),
        F.concat(F.lower(c["c_name"]), F.lit("@example.test")).alias("email"),
    )


def storefront_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders", by_order=False)
    return o.select(o["o_custkey"].alias("fk_customer"), _order_created_at(o).alias("created_at"))


def derived_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four canonical tables as lazy derivations from the test tables."""
    return {
        "orders": sales_orders(spark, sf_dir),
        "items": sales_items(spark, sf_dir),
        "customers": store_customers(spark, sf_dir),
        "storefront_orders": storefront_orders(spark, sf_dir),
    }


def fixture_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The canonical tables for ``sf_dir``, derived as they are read; nothing is kept."""
    return derived_tables(spark, sf_dir)


def stored_tables(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, DataFrame]:
    """The canonical tables written to ``folder`` (shared storage) and read back.

    What production has: stored tables that the operators scan with column
    pruning and pushed filters.  The bench and the plan tests use it to keep
    the derivation out of what they look at.
    """
    out = {}
    for name, df in derived_tables(spark, sf_dir).items():
        path = f"{folder.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        out[name] = spark.read.parquet(path)
    return out
