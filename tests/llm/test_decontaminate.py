import random

import duckdb
from llm_rows import ODD, SF01, docs_of  # noqa: F401

from clientele.llm.decontaminate import Matcher, Pattern, benchmark_leaks, decontaminated, normal
from clientele.llm.queries import queries


def best_distance(item, text):
    """Least edits between ``item`` and any part of ``text``, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row), row.index(min(row))


def edited(r, text, n):
    out = list(text)
    for _ in range(min(n, len(out) - 1)):
        i = r.randrange(len(out))
        kind = r.randrange(3)
        if kind == 0:
            out[i] = r.choice("abcé ")
        elif kind == 1:
            out.insert(i, r.choice("abcé"))
        else:
            del out[i]
    return "".join(out)


def test_bit_parallel_distance_equals_the_table():
    r = random.Random(1)
    for _ in range(300):
        item = "".join(r.choice("abc") for _ in range(r.randrange(1, 90)))
        text = "".join(r.choice("abc") for _ in range(r.randrange(0, 60)))
        if r.random() < 0.6:
            text += edited(r, item, 3) + "ab"
        assert Pattern(item).search(text) == best_distance(item, text) if text else True


def test_matches_equal_brute_force():
    r = random.Random(2)
    words = ["".join(r.choice("abcdefg") for _ in range(r.randrange(2, 7))) for _ in range(60)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randrange(10, 25)))) for i in range(12)]
    matcher = Matcher(items, 0.1, 20)
    for _ in range(60):
        parts = [" ".join(r.choice(words) for _ in range(r.randrange(0, 20)))]
        for _ in range(r.randrange(3)):
            item = r.choice(items)[1]
            parts.append(edited(r, item, r.randrange(0, int(len(item) * 0.13))))
        text = "  ".join(parts).title()
        want = {}
        for i, item in items:
            d, _ = best_distance(normal(item), normal(text))
            if d <= int(len(normal(item)) * 0.1):
                want[i] = d
        got = matcher.matches(text)
        assert {m["item_id"]: m["distance"] for m in got} == want
        for m in got:
            part = normal(text)[m["start"] : m["end"]]
            assert best_distance(normal(dict(items)[m["item_id"]]), part)[0] == m["distance"]


def test_short_items_match_unchanged_as_whole_words():
    matcher = Matcher([(1, "Tiny"), (2, "of the  day?"), (3, "日本"), (4, " "), (5, "x" * 40)], 0.1, 40)
    for text, want in [
        ("destiny, tinys", {}), ("a TINY\tthing, tiny", {1: 2}), ("tin y", {}), ("destiny (tiny)", {1: 9}),
        ("news of the day? yes", {2: 5}), ("news of the day yes", {}), ("proof the day?", {}), ("", {}), (None, {}),
        ("x" * 39, {5: 0}), ("。日本。", {3: 1}),
    ]:
        assert {m["item_id"]: m["start"] for m in matcher.matches(text)} == want, text


def test_blocks_and_odd_rows(spark, docs_of):
    bench = spark.createDataFrame(
        [(1, "Same text here for all"), (2, None), (3, "tiny"), (None, "text without an identifier"), (1, "word " * 9)],
        "item_id long, text string",
    )
    one = benchmark_leaks(docs_of(ODD), bench, min_chars=20)
    many = benchmark_leaks(docs_of(ODD), bench, min_chars=20, block_chars=1)
    rows = sorted(map(str, one.collect()))
    assert rows == sorted(map(str, many.collect())) and len(rows) == 4
    clean = decontaminated(docs_of(ODD), bench, min_chars=20)
    assert clean.columns == docs_of(ODD).columns
    assert sorted(r.doc_id for r in clean.collect()) == [1, 2, 3, 4, 7, 8]
    assert benchmark_leaks(docs_of([]), bench).count() == 0
    assert decontaminated(docs_of(ODD), bench.limit(0)).count() == len(ODD)


def test_query_finds_every_passage(spark):
    found = {(r.doc_id, r.item_id) for r in queries()["op4_benchmark_leaks"](spark, SF01).collect()}
    docs = duckdb.sql(f"select doc_id, text from '{SF01}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{SF01}/benchmark.parquet'").fetchall()
    exact = {(d, i) for d, t in docs for i, x in items if normal(x) in normal(t)}
    assert exact and exact <= found
    texts, wanted = dict(docs), dict(items)
    for d, i in found - exact:
        assert best_distance(normal(wanted[i]), normal(texts[d]))[0] <= len(normal(wanted[i])) * 0.06
