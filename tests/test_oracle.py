"""Every registered query equals its DuckDB twin at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as entry
from clientele.plans.registry import queries as registry_queries
from conftest import SF01
from oracle import compare, duck

# the text operators' queries have tests of their own in tests/llm
TWINS = {name: sql for name, sql in entry.oracle_sql().items() if name in registry_queries()}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF01)
    result = compare(spark, con, name, df, TWINS[name])
    assert result["columns_match"], (result["spark_columns"], result["duckdb_columns"])
    assert result["rows"][0] == result["rows"][1]
    assert result["values_match"], result["diff"]


def test_every_query_has_a_twin():
    assert set(registry_queries()) == set(TWINS)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 29
    assert df.columns[0] == "customer_id"


def test_fixture_figures(spark):
    q = entry.queries()
    assert q["contact_table"](spark, SF01).count() == 175
    assert q["contact_table"](spark, SF01).filter("email is null").count() == 11
    assert q["last_cancel"](spark, SF01).count() == 1475
    assert q["last_bad_cancel"](spark, SF01).count() == 1415
    assert q["last_return"](spark, SF01).count() == 1497
    assert q["last_bad_return"](spark, SF01).count() == 1485
    assert q["item_facts"](spark, SF01).count() == 53898


@pytest.mark.parametrize("name", ["customer_metrics", "contact_export", "last_bad_return", "favourite_weekday"])
def test_results_do_not_depend_on_the_session_time_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        result = compare(spark, con, name, entry.queries()[name](spark, SF01), TWINS[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert result["values_match"], result["diff"]


@pytest.mark.parametrize("name", ["customer_metrics", "contact_batches", "contact_payloads"])
def test_results_do_not_depend_on_adaptive_execution_or_partition_count(spark, con, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        result = compare(spark, con, name, entry.queries()[name](spark, SF01), TWINS[name])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert result["values_match"], result["diff"]


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                   "timestamp_ntz": "TIMESTAMP"}


def test_column_types_match_the_twins(spark, con):
    mismatches = []
    for name, query in registry_queries().items():
        spark_types = dict(query(spark, SF01).dtypes)
        rel = con.execute(f"SELECT * FROM ({TWINS[name]}) t LIMIT 0")
        duck_types = {d[0]: str(d[1]) for d in rel.description}
        mismatches += [(name, c, t, duck_types.get(c)) for c, t in spark_types.items()
                       if SPARK_TO_DUCKDB.get(t, t) != duck_types.get(c)]
    assert not mismatches


def test_fixture_figures_at_sf01_scale(spark):
    sf = "/root/testdata/sf0.1"
    q = entry.queries()
    contacts = q["contact_table"](spark, sf)
    assert contacts.count() == 1720 and contacts.filter("email is null").count() == 97
    counts = {n: q[n](spark, sf).count() for n in
              ("last_cancel", "last_bad_cancel", "last_return", "last_bad_return", "last_order_status")}
    assert counts == {"last_cancel": 14833, "last_bad_cancel": 14120, "last_return": 14983,
                      "last_bad_return": 14851, "last_order_status": 14998}
