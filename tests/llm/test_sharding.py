import random
import zlib

import duckdb
from llm_rows import ODD, SF01, docs_of  # noqa: F401

from clientele.llm.queries import queries
from clientele.llm.sharding import OpenBins, best_fit, best_fit_into, pack_shards


def plain_best_fit(sizes, capacity):
    room, out = [], []
    for s in sizes:
        fits = [(r, i) for i, r in enumerate(room) if r >= s]
        if fits:
            i = min(fits)[1]
        else:
            i = len(room)
            room.append(max(capacity, s))
        room[i] -= s
        out.append(i)
    return out


def test_tree_finds_the_tightest_bin():
    r = random.Random(1)
    for _ in range(200):
        sizes = sorted((r.randrange(1, 60) for _ in range(r.randrange(0, 80))), reverse=True)
        assert best_fit(sizes, 100) == plain_best_fit(sizes, 100)
    bins = OpenBins()
    for remaining, n in ((5, 0), (3, 1), (3, 2), (9, 3)):
        bins.add(remaining, n)
    assert [bins.take_tightest(s) for s in (4, 3, 3, 9, 1)] == [(5, 0), (3, 1), (3, 2), (9, 3), None]


def test_shards_hold_everything_within_the_least_capacity():
    r = random.Random(2)
    for _ in range(50):
        sizes = sorted((r.randrange(1, 1000) for _ in range(r.randrange(1, 300))), reverse=True)
        shards = best_fit_into(sizes, 8)
        load = [sum(s for s, b in zip(sizes, shards, strict=True) if b == k) for k in range(8)]
        assert max(shards) < 8 and sum(load) == sum(sizes)
        assert max(load) <= max(max(sizes), 4 / 3 * sum(sizes) / 8 + 1)


def check(rows, texts, even):
    assert len(rows) == len(texts)
    by_shard, of_text = {}, {}
    sizes = {}
    for r in rows:
        text = texts[r.doc_id] or ""
        assert (r.size, r.text_crc32) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
        assert 0 <= r.shard < 8 and r.law == "bytes" and r.grown_shard is None
        by_shard.setdefault(r.shard, []).append(r.slot)
        of_text.setdefault(text, set()).add(r.shard)
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert all(len(s) == 1 for s in of_text.values()), "equal texts stay together"
    if even:
        assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 0.01 * sum(sizes.values()) / 8


def test_query(spark):
    texts = dict(duckdb.sql(f"select doc_id, text from '{SF01}/documents.parquet'").fetchall())
    check(queries()["op3_pack_shards"](spark, SF01).collect(), texts, even=True)


def test_a_third_of_all_rows_is_one_text(docs_of):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i} " + "x" * (i % 50)) for i in range(1500)]
    check(pack_shards(docs_of(rows), bins_per_shard=64).collect(), dict(rows), even=True)


def test_odd_rows(docs_of):
    rows = pack_shards(docs_of(ODD)).collect()
    assert len(rows) == len(ODD)
    assert len({r.shard for r in rows if r.size == 1}) == 1, "null and empty texts are equal"
    assert pack_shards(docs_of([])).count() == 0
