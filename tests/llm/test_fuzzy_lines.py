import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
from llm_rows import ODD, SF01, docs_of  # noqa: F401

from clientele.llm.fuzzy_lines import WIDTH, band_keys, fuzzy_line_dedup, normal_line
from clientele.llm.links import MinHash, char_shingles, similar
from clientele.llm.queries import queries


def brute_gone(docs, percent=80, least=20):
    """(doc, line) of every line but the first of each component, by all pairs."""
    places = {}
    for d, text in docs:
        for i, line in enumerate((text or "").split("\n")):
            if len(line) >= least and len(normal_line(line)) >= least:
                places.setdefault(normal_line(line), []).append((d, i))
    sets = {x: {x.encode()[i : i + WIDTH] for i in range(len(x.encode()) - WIDTH + 1)} for x in places}
    lines = sorted(places)
    parent = {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(lines):
        for y in lines[:i]:
            both = len(sets[x] & sets[y])
            if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                parent[find(x)] = find(y)
    groups = {}
    for x in lines:
        groups.setdefault(find(x), []).extend(places[x])
    return {p for g in groups.values() for p in set(g) - {min(g)}}


def gone_by_rarest_shingles(docs, percent=80, least=20):
    """As ``brute_gone``; only lines that share one of their rarest fifth of shingles can be alike."""
    places = {}
    for d, text in docs:
        for i, line in enumerate((text or "").split("\n")):
            if len(line) >= least and len(normal_line(line)) >= least:
                places.setdefault(normal_line(line), []).append((d, i))
    sets = {x: {x.encode()[i : i + WIDTH] for i in range(len(x.encode()) - WIDTH + 1)} for x in places}
    often = Counter(s for shingles in sets.values() for s in shingles)
    parent = {x: x for x in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = {}
    for x in sorted(sets, key=lambda x: (len(sets[x]), x)):
        rarest = sorted(sets[x], key=lambda s: (often[s], s))[: len(sets[x]) - -(-percent * len(sets[x]) // 100) + 1]
        for y in {y for s in rarest for y in having.get(s, ())}:
            both = len(sets[x] & sets[y])
            if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                parent[find(x)] = find(y)
        for s in rarest:
            having.setdefault(s, []).append(x)
    groups = {}
    for x in sets:
        groups.setdefault(find(x), []).extend(places[x])
    return {p for g in groups.values() for p in set(g) - {min(g)}}


def test_query_removes_what_all_pairs_remove(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF01}/documents.parquet'").fetchall()
    gone = gone_by_rarest_shingles(docs)
    rows = {r.doc_id: r for r in queries()["op2_fuzzy_lines"](spark, SF01).collect()}
    assert len(rows) == len(docs) and len(gone) > 1000
    for d, text in docs:
        lines = (text or "").split("\n")
        kept = "\n".join(x for i, x in enumerate(lines) if (d, i) not in gone)
        assert rows[d].n_removed == sum((d, i) in gone for i in range(len(lines)))
        assert rows[d].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_prefixes_of_rarest_shingles_lose_nothing():
    assert gone_by_rarest_shingles(corpus()) == brute_gone(corpus())


def corpus(seed=1):
    r = random.Random(seed)

    def word():
        return "".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 9)))

    base = [" ".join(word() for _ in range(r.randrange(4, 40))) for _ in range(120)]
    docs = []
    for d in range(90):
        lines = []
        for _ in range(r.randrange(0, 8)):
            line = r.choice(base) if r.random() < 0.6 else " ".join(word() for _ in range(12))
            words = line.split()
            for _ in range(r.choice([0, 0, 1, 2])):
                words[r.randrange(len(words))] = word()
            lines.append(r.choice(["", "  "]) + " ".join(words).upper() if r.random() < 0.2 else " ".join(words))
        docs.append((d, "\n".join([*lines, "short", "a line that is everywhere in the table"])))
    return docs


def test_equals_all_pairs(docs_of):
    docs = corpus()
    gone = brute_gone(docs)
    rows = {r.doc_id: r for r in fuzzy_line_dedup(docs_of(docs), carry=("doc_id", "lang")).collect()}
    assert len(gone) > 100
    wrong = 0
    for d, text in docs:
        lines = text.split("\n")
        want = "\n".join(x for i, x in enumerate(lines) if (d, i) not in gone)
        assert rows[d].n_lines == len(lines) and rows[d].carried.doc_id == d
        wrong += (rows[d].text, rows[d].n_removed) != (want, sum(p[0] == d for p in gone))
    assert wrong == 0


def test_band_keys_do_not_depend_on_the_company():
    hasher = MinHash(40)
    lines = [x for _, t in corpus(2) for x in t.split("\n") if len(x) >= 20]
    together = band_keys(lines, hasher, 10)
    for k in range(0, len(lines), 17):
        assert (band_keys([lines[k]], hasher, 10)[0] == together[k]).all()


def test_exact_similarity():
    r = random.Random(3)
    for _ in range(200):
        a = "".join(r.choice("ab") for _ in range(60))
        b = a[:40] + "".join(r.choice("ab") for _ in range(r.randrange(30)))
        x = {a[i : i + 8] for i in range(len(a) - 7)}
        y = {b[i : i + 8] for i in range(len(b) - 7)}
        want = 100 * len(x & y) >= 70 * len(x | y)
        assert similar(char_shingles(a, 8), char_shingles(b, 8), 70) == want
    empty = np.empty(0, np.uint64)
    assert not similar(empty, empty, 80)


def test_odd_rows(docs_of):
    rows = fuzzy_line_dedup(docs_of(ODD), carry=("text", "n_words")).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].text is None and by_id[1].n_lines == 0 and by_id[2].text == ""
    assert by_id[6].n_removed == 0, "rows of equal doc_id and text are one document"
    assert all(r.carried.text == r.text for r in rows)
    assert fuzzy_line_dedup(docs_of([])).count() == 0


def star(copies, seed=5):
    """A line and copies of it at 0.8 or more that are unlike each other."""
    r = random.Random(seed)
    original = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(380))
    out = []
    for _ in range(copies):
        at = sorted(r.sample(range(8, 372), 5))
        out.append("".join(r.choice("0123456789") if i in at else c for i, c in enumerate(original)))
    return original, out


def test_a_star_of_several_hundred_lines_over_many_batches_is_one_component(docs_of, spark):
    original, copies = star(600)
    lines = [*copies[:300], original, *copies[300:]]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        rows = fuzzy_line_dedup(docs_of(list(enumerate(lines)))).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute_gone(list(enumerate(lines)))
    assert len(want) > 590
    assert sum(r.n_removed for r in rows) >= 0.99 * len(want)


def test_pairs_among_variants_of_a_template_over_many_batches(docs_of, spark):
    r = random.Random(8)

    def edited(line, edits):
        at = set(r.sample(range(8, 372), edits))
        return "".join(r.choice("0123456789") if i in at else c for i, c in enumerate(line))

    template = star(0)[0]
    variants = [edited(template, 3) for _ in range(250)]
    lines = [x for v in variants for x in (v, edited(v, 2))]
    r.shuffle(lines)
    docs = list(enumerate(lines))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        rows = fuzzy_line_dedup(docs_of(docs)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute_gone(docs)
    assert len(want) > 200
    assert sum(r.n_removed for r in rows) >= 0.99 * len(want)


def test_a_shuffled_row_takes_little_more_than_its_keys(docs_of):
    """A line's row of a band holds 20 bytes that no other has; the rest compresses away."""
    import pyarrow as pa

    from clientele.llm.fuzzy_lines import _banded

    r = random.Random(3)
    lines = [" ".join(f"w{r.randrange(10**6)}" for _ in range(8)) for _ in range(500)]
    banded = _banded(docs_of([(0, "\n".join(lines))]), 10, 4, 20, 3)
    wide = {"int": "i4", "bigint": "i8"}
    raw = bytearray()  # as Spark lays rows out: their size, a bit for each null, eight bytes a column
    for row in banded.collect():
        raw += np.array([8 + 8 * len(row)], "i4").tobytes()
        raw += sum(1 << i for i, x in enumerate(row) if x is None).to_bytes(8, "little")
        for x, (_, kind) in zip(row, banded.dtypes, strict=True):
            raw += np.array([x or 0], wide[kind]).tobytes().ljust(8, b"\0")
    size = sum(len(pa.Codec("lz4_raw").compress(bytes(raw[k : k + 32768]))) for k in range(0, len(raw), 32768))
    assert banded.count() == 5000
    assert size < 28 * 5000
