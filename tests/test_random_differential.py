"""Randomised differential test: fused Spark metrics vs reference-shaped SQL.

Hypothesis draws small order/item tables full of the awkward cases (NULL
customer, repeated order numbers, tied timestamps, NULL vs 0 vouchers, good,
bad and NULL reasons, unverified items, NULL order times); the one-pass Spark
operator must give exactly what the per-family SQL gives on the same rows.
"""

import datetime as dt
import os
from decimal import Decimal

import duckdb
import pandas as pd
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from clientele.functions.reasons import BAD_RETURN_REASONS
from clientele.operators.events import last_event
from clientele.operators.facts import item_facts
from clientele.operators.habits import favourite_bucket
from clientele.operators.metrics import customer_metrics
from clientele.plans.sql_twins import AS_OF, EVENT_CTES, FACTS_CTE, _bucket_cte, _with, metrics_sql
from clientele.sources.fixtures import FIXTURE_AS_OF
from oracle import normalise

BASE = dt.datetime(2001, 7, 20)
TIMES = [BASE + dt.timedelta(hours=h, minutes=m) for h in (0, 5, 23, 30, 100, 300) for m in (0, 59)]
REASONS = [None, "Lost in Warehouse", "SC/Bob Error", "Customer - Changed mind", "Damaged item", "wrong color",
           "Changed mind", "lost in warehouse"]

maybe_time = st.one_of(st.none(), st.sampled_from(TIMES))

order_st = st.fixed_dictionaries(
    {
        "order_nr": st.one_of(st.sampled_from(["A", "B", "C", "D"]), st.none()),
        "customer_id": st.one_of(st.sampled_from([1, 2, 3]), st.none()),
        "status": st.one_of(st.sampled_from(["F", "O", "P"]), st.none()),
        "created_at": st.one_of(st.sampled_from(TIMES), st.none()),
    }
)
item_st = st.fixed_dictionaries(
    {
        "order": st.integers(0, 5),
        "unit_price": st.sampled_from([Decimal("1.00"), Decimal("2.50"), Decimal("99.99")]),
        "coupon_money_value": st.sampled_from([None, 0.0, 0.3]),
        "cart_rule_discount": st.sampled_from([None, 0.0, 0.1]),
        "created_at": st.sampled_from(TIMES),
        "verified": st.booleans(),
        "shipped_at": maybe_time,
        "canceled_at": maybe_time,
        "cancel_reason": st.sampled_from(REASONS),
        "returned_at": maybe_time,
        "return_reason": st.sampled_from(REASONS),
        "ready_for_refund_at": maybe_time,
        "refund_completed_at": maybe_time,
        "refund_reject_at": maybe_time,
    }
)

BAD_RETURNS = BAD_RETURN_REASONS

ORDER_SCHEMA = "id_sales_order long, order_nr string, customer_id long, status string, created_at timestamp_ntz"
ITEM_SCHEMA = (
    "id_sales_order_item long, fk_sales_order long, unit_price decimal(18,2), coupon_money_value double, "
    "cart_rule_discount double, created_at timestamp_ntz, finance_verified_at timestamp_ntz, "
    "shipped_at timestamp_ntz, canceled_at timestamp_ntz, cancel_reason string, returned_at timestamp_ntz, "
    "return_reason string, ready_for_refund_at timestamp_ntz, refund_completed_at timestamp_ntz, "
    "refund_reject_at timestamp_ntz"
)
ITEM_COLS = [c.split()[0] for c in ITEM_SCHEMA.split(", ")]
ORDER_COLS = [c.split()[0] for c in ORDER_SCHEMA.split(", ")]


@settings(
    max_examples=int(os.environ.get("DIFF_EXAMPLES", "25")),
    deadline=None,
    phases=[Phase.explicit, Phase.reuse, Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    orders=st.lists(order_st, min_size=1, max_size=6),
    items=st.lists(item_st, min_size=1, max_size=14),
)
def test_fused_metrics_equal_reference_sql(spark, orders, items):
    order_rows = [(i, o["order_nr"], o["customer_id"], o["status"], o["created_at"]) for i, o in enumerate(orders)]
    item_rows = []
    for k, it in enumerate(items):
        row = dict(it, id_sales_order_item=k, fk_sales_order=it["order"] % len(orders))
        row["finance_verified_at"] = it["created_at"] if it["verified"] else None
        item_rows.append(tuple(row[c] for c in ITEM_COLS))

    o = spark.createDataFrame(order_rows, ORDER_SCHEMA)
    i = spark.createDataFrame(item_rows, ITEM_SCHEMA)
    got = customer_metrics(o, i, FIXTURE_AS_OF)
    got = got.drop(*[c for c in got.columns if c.startswith("ratio_")])
    s_cols, s_rows = normalise(got.columns, got.collect())

    con = duckdb.connect()
    con.register("so_df", pd.DataFrame(order_rows, columns=ORDER_COLS))
    con.register("si_df", pd.DataFrame(item_rows, columns=ITEM_COLS).astype({"unit_price": "float64"}))
    con.execute(f"CREATE VIEW sales_order AS SELECT id_sales_order, order_nr, CAST(customer_id AS BIGINT) AS customer_id, status, "
                f"CAST(created_at AS TIMESTAMP) AS created_at FROM so_df")
    ts_cols = [c for c in ITEM_COLS if c.endswith("_at")]
    casts = ", ".join(
        f"CAST({c} AS TIMESTAMP) AS {c}" if c in ts_cols else
        ("CAST(unit_price AS DECIMAL(18,2)) AS unit_price" if c == "unit_price" else c)
        for c in ITEM_COLS
    )
    con.execute(f"CREATE VIEW sales_item AS SELECT {casts} FROM si_df")
    rel = con.execute(metrics_sql(fixture=False))
    d_cols, d_rows = normalise([d[0] for d in rel.description], rel.fetchall())
    assert AS_OF.endswith(f"'{FIXTURE_AS_OF}'")
    assert s_cols == d_cols
    diff = [
        (s_cols[k], a[k], b[k])
        for a, b in zip(s_rows, d_rows)
        for k in range(len(s_cols))
        if a[k] != b[k]
    ]
    assert len(s_rows) == len(d_rows) and not diff, (len(s_rows), len(d_rows), diff[:8])

    # the standalone operators on the same rows, against their SQL twins
    facts = item_facts(o, i, FIXTURE_AS_OF)
    checks = {
        "last_bad_return": (
            last_event(facts, "returned_at", "return_reason", only=BAD_RETURNS,
                       ts_alias="last_bad_return_date", value_alias="last_bad_return_reason"),
            f"{_with(FACTS_CTE, EVENT_CTES['last_bad_return'], fixture=False)}\n"
            "SELECT customer_id, last_bad_return_date, last_bad_return_reason FROM last_bad_return",
        ),
        "favourite_hour": (
            favourite_bucket(facts, "hour"),
            f"{_with(FACTS_CTE, _bucket_cte('hour'), fixture=False)}\n"
            "SELECT customer_id, hour_of_day_most_order, order_count_hod_most_order FROM fav_hour",
        ),
    }
    for name, (df, sql) in checks.items():
        s_cols, s_rows = normalise(df.columns, df.collect())
        rel = con.execute(sql)
        d_cols, d_rows = normalise([d[0] for d in rel.description], rel.fetchall())
        assert (s_cols, s_rows) == (d_cols, d_rows), name
