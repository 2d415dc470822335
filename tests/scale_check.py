"""Scaling check (not a test): metrics and export on k stacked copies of sf0.1.

Copy i shifts order ids, order numbers and customer ids so the copies are
disjoint; rows per customer stay as in the fixture.  Prints one JSON line per
k with wall times.  Usage: python tests/scale_check.py 1 4 16
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from clientele.operators.metrics import customer_metrics  # noqa: E402
from clientele.plans.contact_job import run_contact_export  # noqa: E402
from clientele.session import build_session, checkpoint_dir  # noqa: E402
from clientele.sources.fixtures import FIXTURE_AS_OF, fixture_tables  # noqa: E402

SHIFT = 10**9


def stacked(spark, base, k, root):
    shift = F.col("copy").cast("bigint") * F.lit(SHIFT)
    out = {}
    rep = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("copy")
    orders = base["orders"].select("*", rep).select(
        (F.col("id_sales_order") + shift).alias("id_sales_order"),
        F.concat(F.col("order_nr"), F.lit("-"), F.col("copy").cast("string")).alias("order_nr"),
        (F.col("customer_id") + shift).alias("customer_id"), "status", "created_at")
    items = base["items"].select("*", rep).withColumn("fk_sales_order", F.col("fk_sales_order") + shift).drop("copy")
    customers = base["customers"].select("*", rep).select(
        (F.col("id_customer") + shift).alias("id_customer"), "email")
    storefront = base["storefront_orders"].select("*", rep).select(
        (F.col("fk_customer") + shift).alias("fk_customer"), "created_at")
    for name, df in {"orders": orders, "items": items, "customers": customers, "storefront_orders": storefront}.items():
        path = f"{root}/k{k}/{name}"
        df.write.mode("overwrite").parquet(path)
        out[name] = spark.read.parquet(path)
    return out


def main(ks):
    spark = build_session("local[8]", shuffle_partitions=16, extra_conf={"spark.driver.memory": "16g"})
    base = fixture_tables(spark, "/root/testdata/sf0.1")
    root = f"{checkpoint_dir(spark).rstrip('/')}/scale-check"
    for k in ks:
        t = stacked(spark, base, k, root)
        n_items = t["items"].count()
        times = []
        for _ in range(2):
            start = time.perf_counter()
            customer_metrics(t["orders"], t["items"], FIXTURE_AS_OF).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        start = time.perf_counter()
        stats = run_contact_export(spark, t, FIXTURE_AS_OF, f"{root}/k{k}/payloads")
        export = time.perf_counter() - start
        print(json.dumps({"k": k, "items": n_items, "metrics_sec": round(min(times), 2),
                          "export_sec": round(export, 2), **stats}), flush=True)


if __name__ == "__main__":
    main([int(a) for a in sys.argv[1:]] or [1, 4, 16])
