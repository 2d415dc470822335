import hashlib
import random
from collections import Counter

import duckdb
import pytest
from llm_rows import ODD, SF01, docs_of  # noqa: F401

from clientele.llm.long_repeats import Rotations, build, merge, remove_repeats, repeated_starts, shared_parts
from clientele.llm.queries import queries


def brute(texts, length):
    """(removed, runs, kept) of each text, by counting all strings of ``length`` bytes."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d) - len(kept), runs, kept))
    return out


def corpus(seed, n=60, alphabet="ab é"):
    r = random.Random(seed)

    def text(size):
        return "".join(r.choice(alphabet) for _ in range(size))

    passages = [text(r.randrange(10, 120)) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [text(r.randrange(0, 30))]
        for _ in range(r.randrange(4)):
            parts += [r.choice(passages)[r.randrange(5) :], text(r.randrange(0, 9))]
        out.append("".join(parts))
    return [*out, out[3], "a" * 300, None, ""]


@pytest.mark.parametrize("params", [{}, {"group_stretches": 1, "batch_bytes": 200}])
@pytest.mark.parametrize("length", [24, 35])
def test_equals_brute_force(docs_of, length, params):
    texts = corpus(length)
    rows = {r.doc_id: r for r in remove_repeats(docs_of(list(enumerate(texts))), length, gram=6, **params).collect()}
    want = brute(texts, length)
    assert sum(w[0] for w in want) > 500
    for i, (removed, runs, kept) in enumerate(want):
        assert (rows[i].n_removed, rows[i].n_spans, bytes(rows[i].kept)) == (removed, runs, kept)


def test_merged_transform_equals_one_transform():
    r = random.Random(1)
    strings = [bytes(r.choice(b"ab") for _ in range(r.randrange(20, 60))) for _ in range(9)]
    rotations = Rotations(strings, 4)
    import numpy as np

    parts = [np.flatnonzero(rotations.owner % 2 == k) for k in (0, 1)]
    merged = merge(rotations, *(build(rotations, p, 5) for p in parts), 5)
    whole = build(rotations, np.arange(len(rotations.owner)), 5)
    text = [s * 3 for s in strings]
    at = [text[o][i : i + 20] for o, i in zip(rotations.owner, rotations.inside, strict=True)]
    assert [at[k] for k in merged.order] == [at[k] for k in whole.order]
    for t in (merged, whole):
        same = [a == b for a, b in zip(t.block, t.block[1:], strict=False)]
        assert same == [at[a] == at[b] for a, b in zip(t.order, t.order[1:], strict=False)]


@pytest.mark.parametrize("shards", [1, 2, 3, 5])
def test_repeated_starts(shards):
    strings = [b"0123456789abcdefghij", b"xx3456789abcdyyyyyyy", b"zzzzzzzzzzzzzzzzzzzz"]
    flags = repeated_starts(strings, [1, 1, 1], 10, shards)
    assert [f.nonzero()[0].tolist() for f in flags] == [[3, 4], [2, 3], list(range(11))]
    assert repeated_starts(strings[:1], [2], 10, shards)[0].all()


def test_odd_rows(docs_of):
    rows = remove_repeats(docs_of(ODD)).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[1].n_bytes, by_id[1].n_removed, by_id[1].n_spans, bytes(by_id[1].kept)) == (0, 0, 0, b"")
    assert (by_id[5].n_removed, by_id[5].n_spans) == (150_000, 1)
    assert by_id[8].n_removed == 5000, "a run overlaps itself"
    twice = remove_repeats(docs_of([(9, "y" + "".join(map(str, range(900))))] * 2)).collect()
    assert all(r.n_removed == r.n_bytes for r in twice)
    assert remove_repeats(docs_of([])).count() == 0


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in queries()["op7_long_repeats"](spark, SF01).collect()}
    docs = duckdb.sql(f"select doc_id, text from '{SF01}/documents.parquet'").fetchall()
    hashed = [[hash(d[i : i + 400]) for i in range(len(d) - 399)] for d in (t.encode() for _, t in docs)]
    seen = Counter(h for hs in hashed for h in hs)
    for (doc_id, text), hs in zip(docs, hashed, strict=True):
        data, gone = text.encode(), bytearray(len(text.encode()))
        for i, h in enumerate(hs):
            if seen[h] > 1:
                gone[i : i + 400] = b"\x01" * 400
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        r = got[doc_id]
        n_spans = sum(g and not before for g, before in zip(gone, b"\x00" + gone, strict=False))
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(data), len(data) - len(kept), n_spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("cells", [1, 3, 8, 40])
def test_shared_parts_lose_no_repeat(cells):
    r = random.Random(cells)
    length, gram = 30, 8
    for _ in range(40):
        core = "".join(r.choice("abc") for _ in range(r.randrange(gram, 60)))
        rows = []
        for k in range(r.randrange(1, 7)):
            data = list(core)
            for _ in range(r.randrange(3)):
                data[r.randrange(len(data))] = "x"
            left = r.randrange(length - gram + 1)
            data = ["y"] * left + data + ["z"] * (length - min(length, left + len(data)))
            rows.append({
                "key": k // 4, "near": 0, "far": length - gram, "doc_key": k, "low": 100, "distance": left,
                "n": 1, "data": "".join(data[: left + length]).encode(),
            })
        parts = shared_parts(rows, length, cells)
        for key in {x["key"] for x in rows}:
            windows = Counter(
                (x["distance"] - i, x["data"][i : i + length])
                for x in rows if x["key"] == key
                for i in range(len(x["data"]) - length + 1)
            )
            kept = Counter(
                (x["distance"] - i, x["data"][i : i + length])
                for x in parts if x["key"] == key
                for i in range(len(x["data"]) - length + 1)
            )
            repeated = {w: n for w, n in windows.items() if n > 1}
            assert {w: kept[w] for w in repeated} == repeated
        for x in parts:
            whole = next(y for y in rows if y["doc_key"] == x["doc_key"])
            at = x["low"] - whole["low"]
            assert whole["data"][at : at + len(x["data"])] == x["data"] and whole["distance"] - at == x["distance"]


#: Differences d of two texts with sum(d[i] * base^i) = 0 modulo 2^64: their polynomial hashes are equal.
BASE, EQUAL_HASH = 0x9E3779B97F4A7C15, [-2, -4, -6, 5, 6, 3, 0, -2, 2, 0, 3, 0, 1, -1, 0, -2, -5, -2]


def equal_hashes(left, right, differences=EQUAL_HASH):
    """Two texts, unlike in the middle only."""
    middle = (tuple(chr(109 + max(s * d, 0)) for d in differences) for s in (1, -1))
    return [left + "".join(x) + right for x in middle]


def test_texts_of_equal_polynomial_hashes_are_no_repeats(docs_of):
    assert sum(d * BASE**i for i, d in enumerate(EQUAL_HASH)) % 2**64 == 0
    r = random.Random(1)
    texts = []
    for _ in range(20):  # no string of 400 bytes without the middle
        left, right = ("".join(r.choice("abcdefgh ") for _ in range(300)) for _ in range(2))
        texts += equal_hashes(left, right)
    rows = remove_repeats(docs_of(list(enumerate(texts)))).collect()
    assert [(x.n_removed, x.n_spans) for x in rows] == [(0, 0)] * 40
    assert all(bytes(x.kept).decode() == texts[x.doc_id] for x in rows)


def test_rotations_number_symbols_by_their_bytes():
    strings = [x.encode() for x in equal_hashes("a" * 30, "b" * 52, EQUAL_HASH[::-1])]
    assert not any(f.any() for f in repeated_starts(strings, [1, 1], 100))
