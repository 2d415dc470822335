"""Batches, export text and payloads."""

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clientele.functions.formatting import scientific_text
from clientele.operators.batching import assign_batches
from clientele.operators.export import FIELD_IDS, contact_export, contact_payloads, write_payloads
from clientele.plans.registry import queries
from conftest import SF01


def go_scientific(v: float) -> str:
    """Reference formatter: shortest digits (Python repr) in one-digit-mantissa E form."""
    r = repr(v)
    neg = r.startswith("-")
    m, _, e = r.lstrip("-").partition("e")
    ip, _, fp = m.partition(".")
    digits = ip + fp
    lead = len(digits) - len(digits.lstrip("0"))
    sig = digits.lstrip("0").rstrip("0")
    sign = "-" if neg else ""
    if not sig:
        return sign + "0E+00"
    ex = (int(e) if e else 0) + len(ip) - lead - 1
    return f"{sign}{sig[0]}{'.' + sig[1:] if len(sig) > 1 else ''}E{'-' if ex < 0 else '+'}{abs(ex):02d}"


@pytest.mark.parametrize("n", [0, 1, 999, 1000, 1998, 1999])
def test_batch_sizes(spark, n):
    df = spark.range(n).select((F.col("id") * 7 + 3).alias("k"))
    rows = assign_batches(df, "k", 999, shards=4).collect()
    assert len(rows) == n
    sizes = {}
    for r in rows:
        sizes[r["batch_no"]] = sizes.get(r["batch_no"], 0) + 1
    expected = [999] * (n // 999) + ([n % 999] if n % 999 else [])
    assert [sizes[b] for b in sorted(sizes)] == expected
    assert sorted(r["batch_pos"] for r in rows) == list(range(n))


def test_batches_follow_key_order_like_a_global_row_number(spark):
    df = spark.range(12345).select(((F.col("id") * 7919) % 100003).alias("k"))
    got = assign_batches(df, "k", 999, shards=7)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("k")) - 1)
    joined = got.join(want, "k")
    assert joined.filter(F.col("batch_pos") != F.col("rn")).count() == 0
    assert joined.filter(F.col("batch_no") != F.floor(F.col("rn") / 999)).count() == 0


def test_scientific_text_matches_shortest_e_format(spark):
    values = [p / q for q in range(1, 120) for p in range(q + 1)] + [1e-5, 123.25, 7.5e-22, -0.5, 0.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x double")
    got = dict(df.select("i", scientific_text(F.col("x"))).collect())
    assert all(got[i] == go_scientific(v) for i, v in enumerate(values))
    assert go_scientific(0.5) == "5E-01" and go_scientific(1.0) == "1E+00"


def test_export_has_all_fields_as_text_without_nulls(spark):
    export = queries()["contact_export"](spark, SF01)
    assert tuple(export.columns) == FIELD_IDS
    assert all(t == "string" for _, t in export.dtypes)
    nulls = export.select([F.sum(F.col(f"`{c}`").isNull().cast("int")).alias(c) for c in FIELD_IDS]).first()
    assert all(v == 0 for v in nulls)


def test_payloads_parse_back_to_the_export_rows(spark):
    q = queries()
    payloads = q["contact_payloads"](spark, SF01).collect()
    export = {r["4819"]: r.asDict() for r in q["contact_export"](spark, SF01).collect()}
    seen = []
    for p in sorted(payloads, key=lambda r: r["batch_no"]):
        doc = json.loads(p["payload"])
        assert p["payload"].startswith('{"key_id": "3", "contacts": [')
        assert doc["key_id"] == "3" and len(doc["contacts"]) == p["n_contacts"] <= 50
        for c in doc["contacts"]:
            assert list(c) == list(FIELD_IDS)
            assert c == export[c["4819"]]
            seen.append(int(c["4819"]))
    assert seen == sorted(int(k) for k in export)


def test_payload_escapes_html_characters_like_the_source(spark):
    df = spark.createDataFrame(
        [(1, 0, 0, "a<b>&c@x.test")], "customer_id long, batch_no long, batch_pos long, email string"
    )
    export = contact_export(
        df.select(
            "batch_no", "batch_pos", "customer_id", "email",
            *[F.lit(None).cast("string").alias(c) for c in _typed_columns() if c not in ("customer_id", "email")],
        ),
        "2020-01-01 00:00:00",
    )
    payload = contact_payloads(export).first()["payload"]
    assert "\\u003c" in payload and "\\u003e" in payload and "\\u0026" in payload and "<" not in payload
    assert json.loads(payload)["contacts"][0]["3"] == "a<b>&c@x.test"


def _typed_columns():
    from clientele.operators.contacts import CONTACT_COLUMNS

    return CONTACT_COLUMNS


def test_payload_can_carry_the_untagged_zero_counts(spark):
    from clientele.operators.batching import assign_batches
    from clientele.operators.export import UNTAGGED_ZERO_FIELDS
    from clientele.sources.fixtures import FIXTURE_AS_OF
    from clientele.plans.registry import _contacts

    batched = assign_batches(_contacts(spark, SF01), "customer_id", 999)
    row = contact_payloads(contact_export(batched, FIXTURE_AS_OF), with_untagged_counts=True).first()
    contact = json.loads(row["payload"])["contacts"][0]
    assert list(contact) == list(FIELD_IDS) + list(UNTAGGED_ZERO_FIELDS)
    assert all(contact[name] == 0 for name in UNTAGGED_ZERO_FIELDS)
    assert ',"OrderCount":0,' in row["payload"]


def test_payload_sinks(spark):
    import uuid

    from clientele.operators.export import write_payloads
    from clientele.session import checkpoint_dir

    payloads = queries()["contact_payloads"](spark, SF01)
    base = f"{checkpoint_dir(spark).rstrip('/')}/sinks-{uuid.uuid4().hex}"
    write_payloads(payloads, f"{base}/json", "json")
    write_payloads(payloads, f"{base}/text", "text")
    assert spark.read.json(f"{base}/json").count() == 4
    docs = [json.loads(r["value"]) for r in spark.read.text(f"{base}/text").collect()]
    assert sorted(len(d["contacts"]) for d in docs) == [25, 50, 50, 50]


def test_a_failing_write_leaves_the_last_payloads(spark, tmp_path):
    path = str(tmp_path / "payloads")
    first = spark.range(5).select(F.col("id").alias("batch_no"), F.lit("old").alias("payload"))
    write_payloads(first, path)
    broken = spark.range(0, 50, 1, 5).select(
        F.col("id").alias("batch_no"), F.when(F.col("id") == 49, F.raise_error(F.lit("lost"))).otherwise(F.lit("new")).alias("payload")
    )
    with pytest.raises(Exception, match="lost"):
        write_payloads(broken, path)
    assert {r.payload for r in spark.read.parquet(path).collect()} == {"old"}
    assert [p.name for p in tmp_path.iterdir()] == ["payloads"], "nothing else is left"
    write_payloads(broken.where("batch_no < 49"), path)
    assert spark.read.parquet(path).count() == 49
    assert [p.name for p in tmp_path.iterdir()] == ["payloads"]


def test_only_keys_are_checkpointed(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    seen, checkpoint = [], DataFrame.checkpoint

    def noted(self, eager=True):
        seen.append(set(self.columns))
        return checkpoint(self, eager)

    monkeypatch.setattr(DataFrame, "checkpoint", noted)
    rows = assign_batches(spark.range(10).select(F.col("id").alias("customer_id"), F.lit("wide").alias("text")), size=4).collect()
    assert seen == [{"customer_id"}, {"customer_id", "_shard", "_pos"}]
    assert sorted((r.customer_id, r.batch_pos, r.batch_no, r.text) for r in rows) == [(i, i, i // 4, "wide") for i in range(10)]
