"""Export projection (text fields keyed by external field id), payloads, sink."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.formatting import edge_text, iso_date, scientific_text
from clientele.functions.timefns import as_of_literal
from clientele.sources.store import file_system


def _date(c: str):
    return lambda as_of: edge_text(iso_date(F.col(c)))


def _text(c: str):
    return lambda as_of: edge_text(F.col(c))


def _sci(c: str):
    return lambda as_of: edge_text(scientific_text(F.col(c)))


def _blank(as_of: Column) -> Column:
    return F.lit("")


# ---------------------------------------------------------------------------
# The receiving system's field ids, in the order the fields
# appear in each contact object, and the typed column each is made from.
# Placeholders the source never filled are sent as ''.
# ---------------------------------------------------------------------------
EXPORT_FIELDS = (
    ("3", _text("email")),                              # e-mail
    ("4819", _text("customer_id")),                     # customer id
    ("18124", _blank),                                  # cluster id (placeholder)
    ("18125", lambda as_of: iso_date(as_of)),           # date of this refresh
    ("18126", _text("avg_item_price")),
    ("18130", _text("avg_basket_size")),
    ("18138", _date("last_cancel_date")),
    ("18129", _text("last_cancel_reason")),
    ("18131", _date("last_bad_cancel_date")),
    ("18132", _text("last_bad_cancel_reason")),
    ("18135", _date("last_return_date")),
    ("18134", _text("last_return_reason")),
    ("18136", _date("last_bad_return_date")),
    ("18137", _text("last_bad_return_reason")),
    ("18139", _date("last_refund_reject_date")),
    ("18140", _blank),                                  # last delivered date (placeholder)
    ("18141", _text("last_order_status")),
    ("18142", _date("last_voucher_date")),
    ("18143", _blank),                                  # last voucher type (placeholder)
    ("18144", _date("last_cart_rule_date")),
    ("18145", _text("refund_reject_ratio")),
    ("18146", _text("order_voucher_ratio")),
    ("18147", _text("order_cart_rule_ratio")),
    ("18148", _blank),                                  # main voucher type (placeholder)
    ("18149", _date("last_ship_broken_sla_date")),
    ("18152", _date("last_refund_broken_sla_date")),
    ("18151", _text("bad_cancellation_ratio")),
    ("18153", _text("bad_return_ratio")),
    ("18154", _text("ship_broken_sla_ratio")),
    ("18155", _text("refund_broken_sla_ratio")),
    ("18156", _text("hour_of_day_most_order")),
    ("18157", _sci("ratio_hod_most_order")),
    ("18158", _text("day_of_week_most_order")),
    ("18159", _sci("ratio_dow_most_order")),
    ("18160", _text("day_of_month_most_order")),
    ("18161", _sci("ratio_dom_most_order")),
    ("18162", _text("month_of_year_most_order")),
    ("18163", _sci("ratio_moy_most_order")),
)
PAYLOAD_KEY_ID = "3"
# Untagged count fields the source's contact objects also carried, after the
# tagged ones; the source never filled them, so they were always 0.
UNTAGGED_ZERO_FIELDS = (
    "OrderCount",
    "OrderCountHodMostOrder",
    "OrderCountDowMostOrder",
    "OrderCountDomMostOrder",
    "OrderCountMoyMostOrder",
)
# ---------------------------------------------------------------------------

FIELD_IDS = tuple(fid for fid, _ in EXPORT_FIELDS)


def contact_export(contacts: DataFrame, as_of, keep: tuple[str, ...] = ("batch_no", "batch_pos")) -> DataFrame:
    """Every contact field as text under its field id; NULL becomes ``''``.

    Dates become ``yyyy-MM-dd``; counts and database ratios use Spark's
    number text; the four favourite-bucket ratios use the shortest
    scientific notation.  Columns named in ``keep`` that exist pass through.
    """
    now = as_of_literal(as_of)
    fields = [make(now).alias(fid) for fid, make in EXPORT_FIELDS]
    passthrough = [c for c in keep if c in contacts.columns]
    return contacts.select(*passthrough, *fields)


def _json_like_source(text: Column) -> Column:
    # The payloads were HTML-safe JSON: <, >, & and the two Unicode line
    # separators appear escaped.  They can only occur inside string values,
    # so replacing them in the JSON text is exact.
    escapes = (
        ("&", "\\u0026"),
        ("<", "\\u003c"),
        (">", "\\u003e"),
        ("\u2028", "\\u2028"),
        ("\u2029", "\\u2029"),
    )
    for raw, escaped in escapes:
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return text


def contact_payloads(exported: DataFrame, with_untagged_counts: bool = False) -> DataFrame:
    """``(batch_no, n_contacts, payload)``: one JSON document per batch.

    ``payload`` is ``{"key_id": "3", "contacts": [...]}`` with the contacts
    in ``batch_pos`` order.  A batch holds at most the batch size of rows,
    so each group is small and bounded.  ``with_untagged_counts`` appends the
    five always-0 count fields to every contact, as the source's objects had.
    """
    fields = [F.col(f"`{fid}`") for fid in FIELD_IDS]
    if with_untagged_counts:
        fields += [F.lit(0).alias(name) for name in UNTAGGED_ZERO_FIELDS]
    contact = F.struct(*fields)
    grouped = exported.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n_contacts"),
        F.sort_array(F.collect_list(F.struct(F.col("batch_pos").alias("pos"), contact.alias("c")))).alias("rows"),
    )
    contacts_json = _json_like_source(F.to_json(F.transform("rows", lambda r: r["c"])))
    payload = F.concat(F.lit(f'{{"key_id": "{PAYLOAD_KEY_ID}", "contacts": '), contacts_json, F.lit("}"))
    return grouped.select("batch_no", "n_contacts", payload.alias("payload"))


def write_payloads(payloads: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write the payload dataset; delivery to the receiving service is the consumer's job.

    Rows are independent, so the write is parallel across tasks.  ``fmt="text"``
    writes one payload document per line (the text sink takes one column).
    ``mode="overwrite"`` writes beside ``path`` and only puts the finished set in
    the place of the old one: a failing run leaves the last payloads whole.
    """
    if fmt == "text":
        payloads = payloads.select("payload")
    if mode != "overwrite":
        payloads.write.mode(mode).format(fmt).save(path)
        return
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    files, staged = file_system(payloads.sparkSession, f"{beside}.new")
    try:
        payloads.write.format(fmt).save(staged.toString())
        _replace(payloads.sparkSession, path, beside)
    finally:
        files.delete(staged, True)  # nothing there after a successful run


def _replace(spark: SparkSession, path: str, beside: str) -> None:
    """Rename ``beside``.new to ``path``; what was there is removed, or put back if that fails."""
    files, target = file_system(spark, path)
    _, staged = file_system(spark, f"{beside}.new")
    _, old = file_system(spark, f"{beside}.old")
    had = files.exists(target)
    if had and not files.rename(target, old):
        raise OSError(f"{path} can't be set aside")
    if not files.rename(staged, target):
        if had:
            files.rename(old, target)
        raise OSError(f"{path} can't be replaced")
    files.delete(old, True)
