"""The whole export: metrics -> contact table -> batches -> payloads -> files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.operators.batching import batch_numbers
from clientele.operators.contacts import contact_table, recent_customer_emails
from clientele.operators.export import contact_export, contact_payloads, write_payloads
from clientele.operators.losses import Losses, source_conditions
from clientele.operators.metrics import active_customer_metrics, customer_metrics, orders_of_active_customers
from clientele.sources.store import Store, snapshot


def build_contacts(
    tables: dict[str, DataFrame],
    as_of,
    *,
    store: Store | None = None,
    stored_sources: bool = False,
    active_days: int = 30,
    email_days: int = 90,
    require_email: bool = False,
    losses: Losses | None = None,
    **metric_options,
) -> DataFrame:
    """Typed contact table from ``tables`` = ``orders, items, customers, storefront_orders``.

    Without a ``store`` this is one lazy plan, whose branches each read the
    sources.  With one, the sources are first stored as a snapshot - each is read
    exactly once, so all columns speak of the same rows - and the metrics go by
    stored steps (``active_customer_metrics``).  ``stored_sources=True`` says
    that the tables don't change and need no snapshot.  ``losses`` counts, as the
    snapshot is taken, the source rows that the run drops.
    """
    if store is None:
        orders = orders_of_active_customers(tables["orders"], tables["items"], as_of, active_days)
        metrics = customer_metrics(orders, tables["items"], as_of, **metric_options)
    else:
        if not stored_sources:
            lists = ("bad_cancel_reasons", "bad_return_reasons", "match")
            conditions = source_conditions(**{k: metric_options[k] for k in lists if k in metric_options})
            tables = snapshot(tables, store, as_of, email_days, losses, conditions)
        metrics = active_customer_metrics(
            tables["orders"], tables["items"], as_of, store, active_days=active_days, **metric_options
        )
    emails = recent_customer_emails(tables["customers"], tables["storefront_orders"], as_of, email_days)
    return contact_table(metrics, emails, as_of, active_days=active_days, require_email=require_email)


def run_contact_export(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    as_of,
    out_path: str,
    *,
    batch_size: int = 999,
    fmt: str = "parquet",
    with_untagged_counts: bool = False,
    stored_sources: bool = False,
    count_losses: bool = False,
    **contact_options,
) -> dict[str, int]:
    """Compute and write one payload row per batch; return contact and batch counts.

    The snapshot, the levels and the batch numbers are stored in the shared
    checkpoint folder: a lost executor during the payload stage recomputes
    customers from the last level, not from the source tables.  The stored
    tables are removed at the end.

    ``count_losses`` adds, without a further job, ``contacts_without_email``
    and, unless ``stored_sources``, ``orders_without_customer``,
    ``unverified_items``, ``unlisted_cancel_reasons`` and
    ``unlisted_return_reasons`` (verified items whose reason no list names).
    """
    losses = Losses() if count_losses else None
    with Store(spark) as store:
        contacts = build_contacts(
            tables, as_of, store=store, stored_sources=stored_sources, losses=losses, **contact_options
        )
        numbers = batch_numbers(contacts.select("customer_id"), batch_size)
        batched = contacts.join(numbers, "customer_id")
        if losses is not None:
            batched = losses.watch(batched, contacts_without_email=F.col("email").isNull())
        payloads = contact_payloads(contact_export(batched, as_of), with_untagged_counts)
        write_payloads(payloads, out_path, fmt)
        # Counted from the checkpointed numbers: a small job over stored rows.
        row = numbers.agg(F.count(F.lit(1)).alias("contacts"), F.max("batch_no").alias("last")).first()
    stats = {"batches": 0 if row["last"] is None else int(row["last"]) + 1, "contacts": int(row["contacts"])}
    return stats if losses is None else {**stats, **losses.counts()}


def main(argv: list[str] | None = None) -> dict[str, int]:
    """``spark-submit clientele/plans/contact_job.py --orders ... --out ...``.

    Reads the four canonical tables (see ``clientele.sources.tables``), runs
    the export and writes one payload row per batch to ``--out``.  ``--as-of``
    defaults to the current time, truncated to the second; pass it
    explicitly to make a run repeatable.
    """
    import argparse
    import datetime as dt

    from clientele.functions.reasons import MATCH_MODES
    from clientele.session import build_session
    from clientele.sources.tables import SLICE_COLUMNS, SOURCE_FILTERS, checked, read_jdbc_table, read_table

    parser = argparse.ArgumentParser(description="Customer contact export")
    for name in ("orders", "items", "customers", "storefront-orders"):
        parser.add_argument(f"--{name}", required=True, help=f"path (or database table) of the {name.replace('-', ' ')}")
    parser.add_argument("--format", default="parquet", help="format of the input tables")
    parser.add_argument("--jdbc-url", default=None, help="read the tables from this database instead of files")
    parser.add_argument("--jdbc-driver", default=None, help="driver class, if the URL doesn't tell")
    parser.add_argument("--jdbc-slices", type=int, default=64, help="parallel connections per table")
    parser.add_argument("--stored-sources", action="store_true", help="the files don't change: read them without a snapshot")
    parser.add_argument("--out", required=True, help="where the payload dataset is written")
    parser.add_argument("--out-format", default="parquet", help="parquet, json or text (one document per line)")
    parser.add_argument("--as-of", default=None, help="'YYYY-MM-DD HH:MM:SS' (default: now)")
    parser.add_argument("--batch-size", type=int, default=999, help="contacts per payload")
    parser.add_argument("--active-days", type=int, default=30, help="latest verified item at most this old")
    parser.add_argument("--email-days", type=int, default=90, help="storefront order window for e-mails")
    parser.add_argument("--require-email", action="store_true", help="drop contacts without e-mail")
    parser.add_argument("--match", choices=MATCH_MODES, default="exact", help="reason matching (ci: case, trailing blanks)")
    parser.add_argument("--bad-cancel-reasons", default=None, help="text file(s) of bad cancellation reasons, one a line")
    parser.add_argument("--bad-return-reasons", default=None, help="text file(s) of bad return reasons, one a line")
    parser.add_argument("--count-losses", action="store_true", help="also count dropped rows, missing e-mails and unlisted reasons")
    parser.add_argument("--with-untagged-counts", action="store_true", help="add the always-0 count fields")
    args = parser.parse_args(argv)

    as_of = args.as_of or dt.datetime.now().replace(microsecond=0).isoformat(sep=" ")
    spark = build_session(app_name="clientele-contact-export")
    paths = {
        "orders": args.orders,
        "items": args.items,
        "customers": args.customers,
        "storefront_orders": args.storefront_orders,
    }
    if args.jdbc_url:
        properties = {"driver": args.jdbc_driver} if args.jdbc_driver else {}
        tables = {
            name: read_jdbc_table(
                spark, args.jdbc_url, path, key=SLICE_COLUMNS[name], slices=args.jdbc_slices,
                condition=SOURCE_FILTERS.get(name), properties=properties,
            )
            for name, path in paths.items()
        }
    else:
        tables = {name: read_table(spark, path, args.format) for name, path in paths.items()}
    tables = {name: checked(df, name) for name, df in tables.items()}
    reasons = {
        name: spark.read.text(path).where("value <> ''")
        for name, path in (("bad_cancel_reasons", args.bad_cancel_reasons), ("bad_return_reasons", args.bad_return_reasons))
        if path
    }
    stats = run_contact_export(
        spark,
        tables,
        as_of,
        args.out,
        batch_size=args.batch_size,
        fmt=args.out_format,
        active_days=args.active_days,
        email_days=args.email_days,
        require_email=args.require_email,
        match=args.match,
        stored_sources=args.stored_sources and not args.jdbc_url,
        with_untagged_counts=args.with_untagged_counts,
        count_losses=args.count_losses,
        **reasons,
    )
    print({"as_of": as_of, **stats})
    return stats


if __name__ == "__main__":
    main()
