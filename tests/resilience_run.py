"""Run the export with task failures injected (test helper, run in a subprocess).

The session allows 3 attempts per task (``local[4,3]``).  A Python UDF used
only here fails the first attempt of partition 0 in two places: the order
scan, and the contacts that feed the batching.  Prints the payload rows of a
failure-free run and of the failing run as JSON.
"""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clientele.operators.batching import assign_batches  # noqa: E402
from clientele.operators.export import contact_export, contact_payloads  # noqa: E402
from clientele.plans.contact_job import build_contacts  # noqa: E402
from clientele.session import build_session  # noqa: E402
from clientele.sources.fixtures import FIXTURE_AS_OF, fixture_tables  # noqa: E402


MARKERS = os.environ.get("CLIENTELE_FAILURE_MARKERS", "")


def _flaky_true(_):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
        if MARKERS:  # local-mode test: leave a trace that the failure happened
            open(os.path.join(MARKERS, f"stage-{ctx.stageId()}"), "w").close()
        raise RuntimeError("injected task failure")
    return True


def payloads(spark, tables, inject):
    flaky_true = F.udf(_flaky_true, "boolean")
    if inject:
        tables = dict(tables, orders=tables["orders"].filter(flaky_true("id_sales_order")))
    contacts = build_contacts(tables, FIXTURE_AS_OF)
    if inject:
        contacts = contacts.filter(flaky_true("customer_id"))
    batched = assign_batches(contacts, "customer_id", 50)
    rows = contact_payloads(contact_export(batched, FIXTURE_AS_OF)).orderBy("batch_no").collect()
    return [r.asDict() for r in rows]


def main(sf_dir):
    spark = build_session("local[4,3]", app_name="clientele-resilience", shuffle_partitions=4)
    tables = fixture_tables(spark, sf_dir)
    clean = payloads(spark, tables, inject=False)
    failed = payloads(spark, tables, inject=True)
    print("RESULT " + json.dumps({"clean": clean, "failed": failed}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
