import math
import random
import zlib

import pytest
from llm_rows import ODD, SF01, docs_of  # noqa: F401

from clientele.llm.queries import queries, sql_twins
from clientele.llm.resampling import bucket_counts, bucket_gains, features, importance_resample, noise, splitters
from oracle import compare, duck


def test_features():
    assert features("The cat, the CAT!", 1) == (4, [b"the", b"cat", b"the", b"cat"])
    assert features("a b c", 2) == (3, [b"a", b"b", b"c", b"a b", b"b c"])
    assert features(None, 1) == features(" ,. ", 3) == (0, [])


def test_gains_and_noise():
    corpus, target = [0] * 4, [0] * 4
    corpus[1], target[2] = 3, 5
    import numpy as np

    got = bucket_gains(np.array(corpus), np.array(target))
    want = [math.floor(1000 * math.log((t + 1) * (3 + 4) / ((s + 1) * (5 + 4)))) for s, t in zip(corpus, target, strict=True)]
    assert got == want
    assert noise(2024, 5) == noise(2024, 5) != noise(2024, 6)


def test_buckets_count_repeats(docs_of):
    counts = bucket_counts(docs_of([(1, "x y x"), (2, None), (3, "x")]).select("text"), 1, 10_000)
    assert counts.sum() == 4 and counts[zlib.crc32(b"x") % 10_000] == 3


def test_splitters_share_rows_evenly():
    samples = [(i, 0, 0, 0, 0, 10) for i in range(100)]
    assert [s[0] for s in splitters(samples, 4)] == [25, 50, 75]
    assert splitters([], 4) == [] and splitters(samples, 1) == []


def test_query_equals_its_twin(spark):
    name = "op12_importance_resampling"
    result = compare(spark, duck(SF01), name, queries()[name](spark, SF01), sql_twins()[name])
    assert result["columns_match"] and result["rows"][0] == 1000
    assert result["values_match"], result["diff"]


@pytest.mark.parametrize("partitions,percent", [(1, 100), (7, 33), (23, 1)])
def test_ranks_are_those_of_one_sorted_list(docs_of, partitions, percent):
    r = random.Random(partitions)
    words = [f"w{i}" for i in range(40)]
    rows = [(r.randrange(50) if i % 3 else 7, " ".join(r.choices(words, k=r.randrange(15, 40)))) for i in range(600)]
    docs = docs_of(rows, partitions)
    out = importance_resample(docs, docs.limit(5), percent=percent).collect()
    assert len(out) == 600
    eligible = sorted((x for x in out if x.n_words >= 20), key=lambda x: (-x.score, x.doc_id, x.n_features))
    drawn = len(eligible) * percent // 100
    ranked = sorted((x for x in out if x["rank"] is not None), key=lambda x: x["rank"])
    assert [x["rank"] for x in ranked] == list(range(1, drawn + 1))
    key = lambda x: (x.score, x.doc_id, x.n_features)
    assert [key(x) for x in ranked] == [key(x) for x in eligible[:drawn]]


def test_odd_rows(docs_of):
    out = importance_resample(docs_of(ODD), docs_of([(1, "word text"), (2, None)]), percent=100, min_words=1).collect()
    assert len(out) == len(ODD)
    by_id = {x.doc_id: x for x in out}
    assert (by_id[1].n_features, by_id[1].weight, by_id[1]["rank"]) == (0, 0, None)
    assert by_id[5].n_features == 30_000 and by_id[None]["rank"] is not None
    assert sorted(x["rank"] for x in out if x["rank"]) == list(range(1, 8))
    assert importance_resample(docs_of([]), docs_of([])).count() == 0
    plain = importance_resample(docs_of([(1, "a b")]), docs_of([]), min_words=1, percent=100).collect()
    assert [x["rank"] for x in plain] == [1]
