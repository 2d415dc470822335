"""Canonical input tables and how to read them.

The operators expect these column names (other columns are ignored and
pruned away by Catalyst):

* sales orders: ``id_sales_order, order_nr, customer_id, status, created_at``
* sales items: ``id_sales_order_item, fk_sales_order, unit_price,
  coupon_money_value, cart_rule_discount, created_at, finance_verified_at,
  shipped_at, canceled_at, cancel_reason, returned_at, return_reason,
  ready_for_refund_at, refund_completed_at, refund_reject_at``
* storefront customers: ``id_customer, email``
* storefront orders: ``fk_customer, created_at``

Datetimes are TIMESTAMP_NTZ: the source systems store wall-clock time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SALES_ORDER_COLUMNS = ("id_sales_order", "order_nr", "customer_id", "status", "created_at")
SALES_ITEM_COLUMNS = (
    "id_sales_order_item",
    "fk_sales_order",
    "unit_price",
    "coupon_money_value",
    "cart_rule_discount",
    "created_at",
    "finance_verified_at",
    "shipped_at",
    "canceled_at",
    "cancel_reason",
    "returned_at",
    "return_reason",
    "ready_for_refund_at",
    "refund_completed_at",
    "refund_reject_at",
)
STORE_CUSTOMER_COLUMNS = ("id_customer", "email")
STOREFRONT_ORDER_COLUMNS = ("fk_customer", "created_at")

TABLE_COLUMNS = {
    "orders": SALES_ORDER_COLUMNS,
    "items": SALES_ITEM_COLUMNS,
    "customers": STORE_CUSTOMER_COLUMNS,
    "storefront_orders": STOREFRONT_ORDER_COLUMNS,
}

#: The numeric column by which a database read of each table is sliced.
SLICE_COLUMNS = {
    "orders": "id_sales_order",
    "items": "fk_sales_order",
    "customers": "id_customer",
    "storefront_orders": "fk_customer",
}


#: What the job never uses of a table, left in the database.
SOURCE_FILTERS = {"orders": "customer_id IS NOT NULL", "items": "finance_verified_at IS NOT NULL"}


def checked(df: DataFrame, table: str) -> DataFrame:
    """``df`` itself, if it has the columns of ``table`` and no zoned datetimes among them."""
    wanted = TABLE_COLUMNS[table]
    types = dict(df.dtypes)
    if missing := [c for c in wanted if c not in types]:
        raise ValueError(f"{table}: missing columns {', '.join(missing)}")
    if zoned := [c for c in wanted if types[c] == "timestamp"]:
        raise ValueError(f"{table}: {', '.join(zoned)} must be TIMESTAMP_NTZ, not a zoned TIMESTAMP")
    return df


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A columnar file table; filters and projections reach the scan."""
    return spark.read.format(fmt).load(path)


def quantile_cuts(keys: DataFrame, key: str, slices: int) -> list[int]:
    """Key values that cut the rows into about ``slices`` equal parts, however unevenly the keys lie.

    Fewer where single values hold more than a part; none for an empty table.
    A mergeable sketch finds them, within a tenth of a part.
    """
    shares = [k / slices for k in range(1, slices)]
    found = keys.where(F.col(key).isNotNull()).approxQuantile(key, shares, 0.1 / slices) if shares else []
    return sorted({int(x) for x in found})


def slice_predicates(key: str, cuts: list[int], condition: str | None = None) -> list[str]:
    """One SQL condition a slice: below the first cut (or NULL), between cuts, from the last on.

    Together they hold for every row that ``condition`` holds for, each row once.
    """
    if not cuts:
        return [condition or "1 = 1"]
    ranges = [f"({key} < {cuts[0]} OR {key} IS NULL)"]
    ranges += [f"({key} >= {a} AND {key} < {b})" for a, b in zip(cuts, cuts[1:], strict=False)]
    ranges.append(f"({key} >= {cuts[-1]})")
    return [f"{r} AND ({condition})" for r in ranges] if condition else ranges


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    key: str,
    slices: int,
    condition: str | None = None,
    properties: dict[str, str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A database table read in about ``slices`` parallel slices of equal size.

    The key column alone is read first, in even ranges between the table's own
    least and largest key, and its quantiles are the cut points: gaps, a late
    start or a dense end of the keys leave no slice empty and none too large.
    ``condition`` goes to the database with each slice (see ``SOURCE_FILTERS``).
    Credentials come from ``properties`` (e.g. from the cluster's secret store),
    never from code.
    """
    options = {"fetchsize": str(fetch_size), "preferTimestampNTZ": "true", **(properties or {})}

    def read(query: str, **more: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=url, dbtable=query, **options, **more).load()

    ends = read(f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) ends").first()
    cuts: list[int] = []
    if ends is not None and ends[0] is not None:
        even = {"partitionColumn": key, "lowerBound": str(ends[0]), "upperBound": str(int(ends[1]) + 1)}
        keys = read(f"(SELECT {key} FROM {table}) ids", numPartitions=str(slices), **even)
        cuts = quantile_cuts(keys, key, slices)
    return spark.read.jdbc(url, table, predicates=slice_predicates(key, cuts, condition), properties=options)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``key``; return the table.

    Write the sales orders bucketed by ``id_sales_order`` and the sales items
    by ``fk_sales_order`` with the same bucket count, and every run of the
    metrics skips both order-keyed shuffles: the per-order aggregation and
    the order join read co-located buckets.  ``path`` should be in shared
    storage; the table is registered in the session's catalog (the
    cluster's metastore, where there is one).
    """
    (
        df.write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)
