"""One customer holding a third of all orders: results stay exact, plan spreads it."""

from pyspark.sql import functions as F

from clientele.operators.contacts import contact_table, recent_customer_emails
from clientele.operators.metrics import customer_metrics
from clientele.plans.inspect import plan_text
from clientele.plans.sql_twins import FIXTURE_CTES, metrics_sql
from clientele.sources.fixtures import FIXTURE_AS_OF, fixture_tables
from conftest import SF01
from oracle import duck, normalise

HOT = 1


def skewed(spark):
    t = fixture_tables(spark, SF01)
    hot = F.when(F.col("id_sales_order") % 3 == 0, F.lit(HOT).cast("bigint")).otherwise(F.col("customer_id"))
    t["orders"] = t["orders"].withColumn("customer_id", hot)
    return t


def test_hot_customer_metrics_match_sql(spark):
    t = skewed(spark)
    got = customer_metrics(t["orders"], t["items"], FIXTURE_AS_OF)
    got = got.drop(*[c for c in got.columns if c.startswith("ratio_")])
    s_cols, s_rows = normalise(got.columns, got.collect())

    con = duck(SF01)
    con.execute(
        f"CREATE VIEW sales_order AS WITH {FIXTURE_CTES} SELECT id_sales_order, order_nr, "
        f"CASE WHEN id_sales_order % 3 = 0 THEN {HOT} ELSE customer_id END AS customer_id, status, created_at "
        f"FROM sales_order"
    )
    con.execute(f"CREATE VIEW sales_item AS WITH {FIXTURE_CTES} SELECT * FROM sales_item")
    rel = con.execute(metrics_sql(fixture=False))
    d_cols, d_rows = normalise([d[0] for d in rel.description], rel.fetchall())
    assert s_cols == d_cols
    assert s_rows == d_rows
    counts = {r["customer_id"]: r["order_count"] for r in got.select("customer_id", "order_count").collect()}
    assert counts[HOT] > 4500, "a third of 15,000 orders belongs to the hot customer"
    assert counts[HOT] == max(counts.values())


def test_hot_customer_is_spread_before_the_customer_shuffle(spark):
    t = skewed(spark)
    text = plan_text(customer_metrics(t["orders"], t["items"], FIXTURE_AS_OF), "simple")
    lines = text.splitlines()
    # per-order rows are shuffled by (customer, order number), not by customer alone
    assert any("hashpartitioning(customer_id" in line and "order_nr" in line for line in lines), text
    # and every level combines map-side before its shuffle
    assert "partial_sum" in text and "partial_max" in text and "Expand" not in text


def test_pile_of_copies_of_one_order_matches_sql(spark):
    """A third of all order rows are copies of one order: map-side combining reduces them."""
    t = fixture_tables(spark, SF01)
    n_copies = 7500  # sf0.01 has 15,000 orders
    hot_id = 7
    copies = (
        t["orders"].filter(F.col("id_sales_order") == hot_id)
        .select("*", F.explode(F.sequence(F.lit(2), F.lit(n_copies))).alias("_copy")).drop("_copy")
    )
    orders = t["orders"].unionByName(copies)
    got = customer_metrics(orders, t["items"], FIXTURE_AS_OF)
    got = got.drop(*[c for c in got.columns if c.startswith("ratio_")])
    s_cols, s_rows = normalise(got.columns, got.collect())

    con = duck(SF01)
    con.execute(
        f"CREATE VIEW sales_order AS WITH {FIXTURE_CTES} "
        f"SELECT id_sales_order, order_nr, customer_id, status, created_at FROM ("
        f"SELECT so.*, unnest(CASE WHEN so.id_sales_order = {hot_id} THEN range({n_copies}) ELSE range(1) END) AS c "
        f"FROM sales_order so)"
    )
    con.execute(f"CREATE VIEW sales_item AS WITH {FIXTURE_CTES} SELECT * FROM sales_item")
    rel = con.execute(metrics_sql(fixture=False))
    d_cols, d_rows = normalise([d[0] for d in rel.description], rel.fetchall())
    assert s_cols == d_cols
    assert s_rows == d_rows


def test_pile_of_copies_of_one_order_is_combined_before_the_join(spark):
    """No exchange on the order id carries raw order rows: copies are counted map-side first."""
    t = fixture_tables(spark, SF01)
    lines = plan_text(customer_metrics(t["orders"], t["items"], FIXTURE_AS_OF, habits=False), "simple").splitlines()
    combined = [i for i, line in enumerate(lines) if "partial_count(1)" in line and "id_sales_order" in line]
    assert combined, "orders are combined before their shuffle"


def test_require_email_drops_contacts_without_one(spark):
    t = fixture_tables(spark, SF01)
    metrics = customer_metrics(t["orders"], t["items"], FIXTURE_AS_OF)
    emails = recent_customer_emails(t["customers"], t["storefront_orders"], FIXTURE_AS_OF)
    assert contact_table(metrics, emails, FIXTURE_AS_OF).count() == 175
    assert contact_table(metrics, emails, FIXTURE_AS_OF, require_email=True).count() == 164
