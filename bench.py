"""Headline-query timings: one JSON line on stdout.

The canonical tables are derived from ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) once and stored in a scratch folder; ``derive_sec`` is
that cost.  Every query then reads the stored tables on
``local[$BENCH_CPUS]`` and runs in full with the ``noop`` sink (all rows
computed, nothing sent to the driver): once to warm up, then
``$BENCH_RUNS`` (default 3) times, of which the median counts.  Times hold
building and planning the query, and the stored steps of the ``_stored`` and
``_snapshot`` forms; ``plan_sec`` is that part of the last run.
``one_join_per_metric`` is the yardstick: the same contact table with one
order-item join for every metric family (``tests/test_bench.py`` holds the two
equal).  ``export_job`` runs the whole export into a scratch folder;
``customer_metrics_bucketed`` repeats the metrics over tables bucketed by
order id.  ``shuffle_mb`` is the shuffle bytes that the last run of each query
wrote, from Spark's event log in a scratch folder.
"""

from __future__ import annotations

import glob
import itertools
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from clientele.functions.buckets import BUCKETS  # noqa: E402
from clientele.functions.reasons import BAD_CANCEL_REASONS, BAD_RETURN_REASONS  # noqa: E402
from clientele.functions.timefns import plus_days  # noqa: E402
from clientele.operators.contacts import CONTACT_COLUMNS, recent_customer_emails  # noqa: E402
from clientele.operators.events import last_event  # noqa: E402
from clientele.operators.export import contact_export  # noqa: E402
from clientele.operators.facts import item_facts  # noqa: E402
from clientele.operators.habits import favourite_bucket  # noqa: E402
from clientele.operators.metrics import (  # noqa: E402
    active_customers,
    customer_metrics,
    customer_profile,
    orders_of_active_customers,
)
from clientele.plans.contact_job import build_contacts, run_contact_export  # noqa: E402
from clientele.session import build_session  # noqa: E402
from clientele.sources.fixtures import FIXTURE_AS_OF, stored_tables  # noqa: E402
from clientele.sources.store import Store  # noqa: E402
from clientele.sources.tables import save_bucketed  # noqa: E402


def _facts(t):
    return item_facts(t["orders"], t["items"], FIXTURE_AS_OF)


def _profile(t):
    orders = orders_of_active_customers(t["orders"], t["items"], FIXTURE_AS_OF)
    return customer_profile(customer_metrics(orders, t["items"], FIXTURE_AS_OF, habits=False), FIXTURE_AS_OF)


def one_join_per_metric(t):
    """The contact table with an order-item join of its own for each metric family, as a job of ten queries has it."""

    def family(*columns):
        return _facts(t).groupBy("customer_id").agg(*columns)

    def share(part, whole, name):
        return F.try_divide(part.cast("double"), whole.cast("double")).alias(name)

    def used(discount):  # a NULL discount counts as used
        return F.coalesce(F.col(discount) != 0, F.lit(True))

    def event(ts, value, only, date, text):
        return last_event(_facts(t), ts, value, only=only, ts_alias=date, value_alias=text)

    items, orders, created = F.count("id_sales_order_item"), F.count_distinct("order_nr"), F.col("created_at")
    broken_ship, broken_refund = F.col("is_ship_broken_sla") == 1, F.col("is_refund_broken_sla") == 1
    base = active_customers(family(F.max("created_at").alias("last_order_date"), orders.alias("order_count")), FIXTURE_AS_OF)
    families = [
        family(share(F.sum("unit_price"), items, "avg_item_price"), F.try_divide(items, orders).cast("bigint").alias("avg_basket_size")),
        family(F.max("refund_reject_at").alias("last_refund_reject_date"), share(F.count("refund_reject_at"), items, "refund_reject_ratio")),
        family(
            F.max(F.when(used("coupon_money_value"), created)).alias("last_voucher_date"),
            share(F.count_distinct(F.when(used("coupon_money_value"), F.col("order_nr"))), orders, "order_voucher_ratio"),
        ),
        family(
            F.max(F.when(used("cart_rule_discount"), created)).alias("last_cart_rule_date"),
            share(F.count_distinct(F.when(used("cart_rule_discount"), F.col("order_nr"))), orders, "order_cart_rule_ratio"),
        ),
        family(
            F.max(F.when(broken_ship, plus_days(created, 3))).alias("last_ship_broken_sla_date"),
            share(F.count(F.when(broken_ship, 1)), items, "ship_broken_sla_ratio"),
        ),
        family(
            F.max(F.when(broken_refund, plus_days(F.col("ready_for_refund_at"), 7))).alias("last_refund_broken_sla_date"),
            share(F.count(F.when(broken_refund, 1)), items, "refund_broken_sla_ratio"),
        ),
        family(
            share(F.count(F.when(F.col("is_bad_cancel_reason") == 1, 1)), items, "bad_cancellation_ratio"),
            share(F.count(F.when(F.col("is_bad_return_reason") == 1, 1)), items, "bad_return_ratio"),
        ),
        event("canceled_at", "cancel_reason", None, "last_cancel_date", "last_cancel_reason"),
        event("canceled_at", "cancel_reason", BAD_CANCEL_REASONS, "last_bad_cancel_date", "last_bad_cancel_reason"),
        event("returned_at", "return_reason", None, "last_return_date", "last_return_reason"),
        event("returned_at", "return_reason", BAD_RETURN_REASONS, "last_bad_return_date", "last_bad_return_reason"),
        last_event(_facts(t), "order_created_at", "status", require_ts=False, value_alias="last_order_status").drop("order_created_at"),
        *[favourite_bucket(_facts(t), kind) for kind in BUCKETS],
        recent_customer_emails(t["customers"], t["storefront_orders"], FIXTURE_AS_OF),
    ]
    out = base
    for part in families:
        out = out.join(part, "customer_id", "left")
    ratios = {b.ratio_column: F.try_divide(F.col(b.count_column).cast("double"), F.col("order_count").cast("double")) for b in BUCKETS.values()}
    return out.withColumns(ratios).select(*CONTACT_COLUMNS)


def _stored(build):
    """A query by stored steps: they run while it is built."""
    return lambda t: build(t, Store(t["orders"].sparkSession))


HEADLINE = {
    "customer_profile": _profile,
    "customer_metrics": lambda t: customer_metrics(t["orders"], t["items"], FIXTURE_AS_OF),
    "customer_metrics_stored": _stored(lambda t, store: customer_metrics(t["orders"], t["items"], FIXTURE_AS_OF, store=store)),
    "contact_table": lambda t: build_contacts(t, FIXTURE_AS_OF),
    "contact_table_stored": _stored(lambda t, store: build_contacts(t, FIXTURE_AS_OF, store=store, stored_sources=True)),
    "contact_table_snapshot": _stored(lambda t, store: build_contacts(t, FIXTURE_AS_OF, store=store)),
    "contact_export": lambda t: contact_export(build_contacts(t, FIXTURE_AS_OF), FIXTURE_AS_OF, keep=()),
    "one_join_per_metric": one_join_per_metric,
    "item_facts": _facts,
    "last_cancel": lambda t: last_event(_facts(t), "canceled_at", "cancel_reason"),
    "last_bad_return": lambda t: last_event(_facts(t), "returned_at", "return_reason", only=BAD_RETURN_REASONS),
    "last_order_status": lambda t: last_event(_facts(t), "order_created_at", "status", require_ts=False),
    "favourite_hour": lambda t: favourite_bucket(_facts(t), "hour"),
    "favourite_monthday": lambda t: favourite_bucket(_facts(t), "monthday"),
    "recent_emails": lambda t: recent_customer_emails(t["customers"], t["storefront_orders"], FIXTURE_AS_OF),
}


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _shuffle_mb(log_dir: str) -> dict[str, float]:
    """Shuffle bytes written per timed query, from the event log (job group = query name)."""
    stage_group: dict[int, str] = {}
    written: dict[int, int] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path, encoding="utf-8") as f:
            for line in f:
                event = json.loads(line)
                kind = event.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (event.get("Properties") or {}).get("spark.jobGroup.id")
                    if group and group.startswith("timed:"):
                        for sid in event.get("Stage IDs", []):
                            stage_group[sid] = group[len("timed:"):]
                elif kind == "SparkListenerStageCompleted":
                    info = event["Stage Info"]
                    for acc in info.get("Accumulables", []):
                        if acc.get("Name") == "internal.metrics.shuffle.write.bytesWritten":
                            written[info["Stage ID"]] = int(acc.get("Value") or 0)
    totals: dict[str, float] = {}
    for sid, group in stage_group.items():
        totals[group] = totals.get(group, 0) + written.get(sid, 0)
    return {k: round(v / 2**20, 2) for k, v in sorted(totals.items())}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    log_dir = tempfile.mkdtemp(prefix="clientele-bench-events-", dir=os.environ.get("TMPDIR", "/tmp"))
    conf = {
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="clientele-bench-warehouse-", dir=os.environ.get("TMPDIR", "/tmp")),
    }
    if os.environ.get("BENCH_JAVA_OPTS"):
        conf["spark.driver.extraJavaOptions"] = os.environ["BENCH_JAVA_OPTS"]
    spark = build_session(f"local[{cpus}]", app_name="clientele-bench", shuffle_partitions=max(cpus * 2, 8), extra_conf=conf)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="clientele-bench-", dir=os.environ.get("TMPDIR", "/tmp"))
    start = time.perf_counter()
    tables = stored_tables(spark, sf_dir, f"{scratch}/tables")
    derive_sec = round(time.perf_counter() - start, 3)
    timings: dict[str, float] = {}
    plan_sec: dict[str, float] = {}

    def timed(name: str, build, execute=_run) -> None:
        took = []
        for k in range(runs + 1):  # the first warms up: JIT, file listing, generated code
            group = f"timed:{name}" if k == runs else "untimed"
            spark.sparkContext.setJobGroup(group, group)
            start = time.perf_counter()
            df = build()
            if hasattr(df, "_jdf"):
                df._jdf.queryExecution().executedPlan()
            plan_sec[name] = round(time.perf_counter() - start, 3)
            execute(df)
            took.append(time.perf_counter() - start)
            spark.sparkContext.setJobGroup("untimed", "untimed")
        timings[name] = round(statistics.median(took[1:]), 3)

    for name, build in HEADLINE.items():
        timed(name, lambda build=build: build(tables))

    # The same metrics over tables bucketed by order id (written once, untimed):
    # the per-order aggregation of the items needs no shuffle.
    buckets = max(cpus * 2, 8)
    orders = save_bucketed(tables["orders"], "bench_sales_order", "id_sales_order", buckets, f"{scratch}/bucketed/orders")
    items = save_bucketed(tables["items"], "bench_sales_item", "fk_sales_order", buckets, f"{scratch}/bucketed/items")
    timed("customer_metrics_bucketed", lambda: customer_metrics(orders, items, FIXTURE_AS_OF))

    stats: dict[str, int] = {}

    def export(out: str, stored_sources: bool = True) -> None:
        stats.update(run_contact_export(spark, tables, FIXTURE_AS_OF, out, stored_sources=stored_sources))

    numbers = itertools.count()
    timed("export_job", lambda: f"{scratch}/payloads-{next(numbers)}", export)
    timed("export_job_snapshot", lambda: f"{scratch}/payloads-{next(numbers)}", lambda out: export(out, False))

    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    spark.stop()
    result = {
        "metric": "total_headline_seconds",
        "value": round(sum(t for name, t in timings.items() if name != "one_join_per_metric"), 3),
        "unit": "sec",
        "queries": timings,
        "plan_sec": plan_sec,
        "derive_sec": derive_sec,
        "runs": runs,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "contacts": stats["contacts"],
        "batches": stats["batches"],
    }
    try:
        result["shuffle_mb"] = _shuffle_mb(log_dir)
    except (OSError, ValueError, KeyError):
        pass
    print(json.dumps(result))


if __name__ == "__main__":
    main()
