"""Reason classification for returns and cancellations."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the source job's lists for equal results.
# A return or cancellation with one of these reasons counts as "bad".
# ---------------------------------------------------------------------------
BAD_RETURN_REASONS = (
    "content issue",
    "Damaged item",
    "Expiring date",
    "Fake A",
    "Fake C",
    "Fake Product",
    "Guarantee issue / wrong details base on our site",
    "Internal - wrong item",
    "Lost in Shipment",
    "Merchant - Defective",
    "merchant - wrong item",
    "Merchant-Not complete product",
    "Poor quality of the product",
    "wrong color",
    "Wrong product information",
)

BAD_CANCEL_REASONS = (
    "cancellation - unable to send via 3PL/own-rider",
    "Customer - Late fulfillment",
    "Customer - Some items were out of stock",
    "Customer - Wrong product information",
    "Internal-Defective",
    "Internal-Error",
    "Late Fulfilment by Seller",
    "Lost in Warehouse",
    "Merchant - Defective",
    "Merchant - Order replacement",
    "Merchant - Out of stock",
    "Merchant - Price was wrong (Bamilo mistake)",
    "Merchant - Price was wrong (Merchant mistake)",
    "Merchant-Late Fulfilment",
    "Merchant-Wrong",
    "Out of stock(Cancellation - Internal)",
    "Price Was wrong-Merchant",
    "SC/Bob Error",
)
# ---------------------------------------------------------------------------

MATCH_MODES = ("exact", "ci")


def is_listed(reason: Column, reasons: Iterable[str], match: str = "exact") -> Column:
    """True when ``reason`` is one of ``reasons``; NULL reasons are never listed.

    ``match="exact"`` compares strings as they are.  ``match="ci"`` ignores
    case and trailing blanks, as a case-insensitive, blank-padding database
    collation would.  Both compile to one ``InSet`` check, no join.
    """
    if match not in MATCH_MODES:
        raise ValueError(f"match must be one of {MATCH_MODES}, got {match!r}")
    values = list(reasons)
    if match == "ci":
        folded = sorted({v.rstrip(" ").lower() for v in values})
        test = F.lower(F.rtrim(reason)).isin(folded)
    else:
        test = reason.isin(values)
    return F.coalesce(test, F.lit(False))


def reason_flag(reason: Column, reasons: Iterable[str], match: str = "exact") -> Column:
    """1 when the reason is listed, else 0 (an integer flag, as in the source SQL)."""
    return F.when(is_listed(reason, reasons, match), F.lit(1)).otherwise(F.lit(0))


def with_reason_flag(
    df: DataFrame, column: str, flag: str, reasons: Iterable[str] | DataFrame, match: str = "exact", spread_by: str = "id_sales_order_item"
) -> DataFrame:
    """``df`` with ``flag``: 1 when the reason in ``column`` is listed, else 0.

    A list of strings becomes an expression.  A DataFrame, whose first column
    holds the reasons, is a list of any length: it is reduced to its different
    reasons and joined.  Spark broadcasts it only if its measured size is below
    ``spark.sql.autoBroadcastJoinThreshold``; else both sides are shuffled by
    reason, where rows without a reason are spread by ``spread_by`` and
    adaptive execution splits a reason that many rows share.  No row is added
    or lost: reasons that repeat in the list, or are NULL, change nothing.
    """
    if not isinstance(reasons, DataFrame):
        return df.withColumn(flag, reason_flag(F.col(column), reasons, match))
    if match not in MATCH_MODES:
        raise ValueError(f"match must be one of {MATCH_MODES}, got {match!r}")

    def folded(reason: Column) -> Column:
        return F.lower(F.rtrim(reason)) if match == "ci" else reason

    key, spread = f"__{flag}_reason", f"__{flag}_spread"
    listed = (
        reasons.select(folded(F.col(reasons.columns[0]).cast("string")).alias(key))
        .where(F.col(key).isNotNull())
        .distinct()
        .withColumns({spread: F.lit(0).cast("bigint"), flag: F.lit(1)})
    )
    no_reason = F.when(F.col(column).isNull(), F.xxhash64(spread_by)).otherwise(F.lit(0).cast("bigint"))
    keyed = df.withColumns({key: F.coalesce(folded(F.col(column)), F.lit("")), spread: no_reason})
    joined = keyed.join(listed, [key, spread], "left")
    found = F.col(column).isNotNull() & F.col(flag).isNotNull()
    return joined.select(*df.columns, F.when(found, F.lit(1)).otherwise(F.lit(0)).alias(flag))
