import itertools
import random

import duckdb
import numpy as np
from llm_rows import ODD, SF01, docs_of  # noqa: F401

from clientele.llm.common import components
from clientele.llm.near_documents import near_documents, tree_neighbours
from clientele.llm.queries import queries


def shingles(text, width=4):
    w = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()
    if not w:
        return frozenset()
    return frozenset([tuple(w[i : i + width]) for i in range(len(w) - width + 1)] or [tuple(w)])


def brute_components(texts, width=4):
    """Smallest reachable doc_id, by comparing all pairs that share a shingle."""
    sets = {d: shingles(t, width) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = {}
    for d in sorted(sets):
        near = {}
        for s in sets[d]:
            for e in having.setdefault(s, []):
                near[e] = near.get(e, 0) + 1
            having[s].append(d)
        for e, both in near.items():
            if 100 * both >= 80 * (len(sets[d]) + len(sets[e]) - both):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


def variants(seed, n, length, edits):
    r = random.Random(seed)
    base = [f"w{r.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(r.randrange(edits + 1)):
            words[r.randrange(length)] = f"e{r.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def check(rows, texts, width=4):
    want = brute_components(texts, width)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_query_equals_brute_force(spark):
    texts = dict(duckdb.sql(f"select doc_id, text from '{SF01}/documents.parquet'").fetchall())
    check(queries()["op8_near_documents"](spark, SF01).collect(), texts)


def test_a_large_group_of_near_copies_and_a_common_passage(docs_of):
    texts = variants(1, 300, 120, 2) + variants(2, 40, 60, 1) + ["hot copy of one text and nothing else"] * 200
    passage = " ".join(f"p{i}" for i in range(12))
    r = random.Random(3)
    texts += [f"{passage} " + " ".join(f"u{r.randrange(10**6)}" for _ in range(30)) for _ in range(200)]
    rows = dict(enumerate(texts))
    check(near_documents(docs_of(list(rows.items()))).collect(), rows)


def test_links_at_the_threshold_to_one_text_only(docs_of):
    """The hardest case of a search by signatures: some texts reach the group through its original alone."""
    rows = dict(enumerate(variants(1, 300, 120, 3)))
    want = brute_components(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_documents(docs_of(list(rows.items()))).collect()}
    lost = [d for d in rows if got[d] != want[d]]
    assert all(got[d][1] == d for d in lost), "what is lost is a link, never is one made up"
    assert len(lost) <= 0.02 * len(rows)


def test_five_word_shingles(docs_of):
    rows = dict(enumerate(variants(4, 60, 120, 2)))
    check(near_documents(docs_of(list(rows.items())), width=5).collect(), rows, width=5)


def test_odd_rows(docs_of):
    rows = near_documents(docs_of(ODD)).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[1].n_shingles, by_id[1].component_id, by_id[1].kept) == (0, 1, True)
    assert (by_id[None].component_id, by_id[None].kept) == (None, True)
    assert by_id[5].n_shingles == 1 and by_id[6].kept
    assert near_documents(docs_of([])).count() == 0


def test_repeated_doc_ids_are_one_node(docs_of):
    r = random.Random(11)
    a, b, c, d = (" ".join(f"w{r.randrange(10**6)}" for _ in range(30)) for _ in range(4))
    rows = near_documents(docs_of([(1, a), (2, b), (5, a), (5, b), (5, None), (9, c), (7, d), (7, c), (7, c), (None, a)])).collect()
    got = sorted((x.doc_id or 0, x.component_id or 0, x.kept) for x in rows)
    assert got == sorted(
        [(1, 1, True), (2, 1, False), (5, 1, False), (5, 1, False), (5, 1, False), (9, 7, False), *[(7, 7, True)] * 3, (0, 0, True)]
    )


def test_first_texts_of_one_doc_id_are_told_apart(docs_of):
    """Two texts of the smallest doc_id, each with a near copy of its own."""
    a, b = variants(21, 1, 100, 0)[0], variants(22, 1, 100, 0)[0]
    near = [" ".join([*t.split()[:-1], "changed"]) for t in (a, b)]
    rows = near_documents(docs_of([(1, a), (1, b), (3, near[0]), (4, near[1])])).collect()
    assert len(rows) == 4 and all(x.component_id == 1 for x in rows)


def test_candidates_of_a_shared_passage_grow_with_the_rows(docs_of, monkeypatch):
    """Documents that share a passage and are otherwise unlike: few of their pairs are verified."""
    from clientele.llm import near_documents as module

    seen = []
    found = module.linked_components
    monkeypatch.setattr(module, "linked_components", lambda pairs, *x, **y: (seen.append(pairs.count()), found(pairs, *x, **y))[1])
    r = random.Random(12)
    passage = " ".join(f"p{i}" for i in range(60))
    counts = []
    for n in (300, 1200):
        seen.clear()
        docs = [(i, f"{passage} " + " ".join(f"u{r.randrange(10**6)}" for _ in range(60))) for i in range(n)]
        rows = near_documents(docs_of(docs)).collect()
        assert len(rows) == n and all(x.kept for x in rows)
        counts.append(sum(seen) / n)
    assert counts[1] <= 2 * counts[0] + 1, counts


def test_depth_follows_the_region():
    r = np.random.default_rng(1)
    paths = r.integers(0, 3, (200, 6))
    paths = paths[np.lexsort(paths.T[::-1])]  # the first column is the lead, apart from the likeness
    a, b, n = tree_neighbours(np.zeros(200, np.int64), paths, np.arange(200), region=4, reach=2, least=0)
    pairs = set(zip(a.tolist(), b.tolist(), strict=True))
    assert all(x < y and (paths[x, 1:] == paths[y, 1:]).sum() == k for x, y, k in zip(a, b, n, strict=True))
    for y in range(1, 200):
        depth = next(d for d in range(1, 7) if d == 6 or (paths[:, :d] == paths[y, :d]).all(axis=1).sum() <= 4)
        for x in (y - 1, y - 2):
            if x >= 0 and (paths[x, :depth] == paths[y, :depth]).all():
                assert (x, y) in pairs


def test_components_of_awkward_graphs(spark):
    r = random.Random(5)
    order = r.sample(range(400), 400)
    graphs = [
        list(zip(order, order[1:], strict=False)),
        [(7, i) for i in range(8, 300)],
        [(r.randrange(900), r.randrange(900)) for _ in range(500)],
        [],
    ]
    for edges in graphs:
        parent = {}

        def find(x, parent=parent):
            parent.setdefault(x, x)
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            if a != b:
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
        frame = spark.createDataFrame(edges, "a long, b long").repartition(5)
        got = {x.node: x.component for x in components(frame).collect()}
        assert got == {x: find(x) for x in parent}


def test_copies_of_one_document_over_many_partitions_are_one_component(docs_of, spark):
    r = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    original = [r.choice(words) for _ in range(120)]
    docs = [(0, " ".join(original))]
    for d in range(1, 401):
        copy = list(original)
        for at in r.sample(range(4, 116), 3):
            copy[at] = r.choice(words)
        docs.append((d, " ".join(copy)))
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        rows = near_documents(docs_of(docs), width=4).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert sum(row.component_id == 0 for row in rows) > 395


def pairs_of_one_family(seed, n):
    """Pairs of texts near the threshold, unlike the other pairs by little more."""
    r = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    places = [10 * i + 5 for i in range(12)]
    texts = []
    for three in r.sample(list(itertools.combinations(places, 3)), n):
        one = list(base)
        for at in three:
            one[at] = f"e{r.randrange(10**9)}"
        two = list(one)
        for at in r.sample([i for i in places if one[i] == base[i]], 3):
            two[at] = f"e{r.randrange(10**9)}"
        texts += [" ".join(one), " ".join(two)]
    r.shuffle(texts)
    return dict(enumerate(texts))


def test_regions_larger_than_a_block_lose_no_pair(docs_of):
    rows = pairs_of_one_family(7, 100)
    assert len({c for _, c in brute_components(rows).values()}) == 100
    check(near_documents(docs_of(list(rows.items())), region=1, reach=1, block=8, deepest=1).collect(), rows)


def test_divided_regions_lose_no_pair(docs_of):
    """Pairs that share a tree's first value meet, though the values that divide their region differ."""
    rows = pairs_of_one_family(7, 100)
    check(near_documents(docs_of(list(rows.items())), region=1, reach=1, block=8, deepest=8).collect(), rows)


def test_regions_with_few_sets_outside_lose_no_pair(docs_of):
    """Regions of several blocks, whose sets meet without a look at their single values first."""
    rows = pairs_of_one_family(8, 60)
    check(near_documents(docs_of(list(rows.items())), region=1, reach=1, block=32, deepest=1).collect(), rows)


def test_a_shared_passage_makes_no_region_of_many_sets(docs_of, monkeypatch):
    """Documents that share half their shingles and aren't alike: no value of theirs is dealt out by itself."""
    from clientele.llm import near_documents as module

    seen = []
    found = module._may_agree
    monkeypatch.setattr(module, "_may_agree", lambda large, *x: (seen.append(large.count()), found(large, *x))[1])
    r = random.Random(13)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(i, f"{passage} " + " ".join(f"u{r.randrange(10**6)}" for _ in range(60))) for i in range(900)]
    rows = near_documents(docs_of(docs)).collect()
    assert len(rows) == 900 and all(x.kept for x in rows)
    assert sum(seen) == 0


def test_documents_are_read_once_for_their_texts(docs_of, spark, tmp_path, monkeypatch):
    """One pass for the signatures, one for the texts of all searches: a pass deals the whole table."""
    from clientele.llm import near_documents as module

    rows = pairs_of_one_family(7, 100)
    docs_of(list(rows.items())).write.parquet(f"{tmp_path}/docs")
    passes, confirmed = [], []
    cut, compared = module.cut, module.compared
    monkeypatch.setattr(module, "cut", lambda df: (passes.append(bool(df.inputFiles())), cut(df))[1])
    monkeypatch.setattr(module, "compared", lambda *x: (confirmed.append(1), compared(*x))[1])
    docs = spark.read.parquet(f"{tmp_path}/docs")
    check(near_documents(docs, region=1, reach=1, block=8, deepest=1).collect(), rows)
    assert confirmed  # later searches needed texts too
    assert sum(passes) == 2


def test_few_links_are_in_few_partitions(spark):
    """Every later round reads these: many partitions of few rows cost a file and a task each."""
    from clientele.llm.links import compared, word_shingles

    text = " ".join(f"w{i}" for i in range(40))
    rows = spark.createDataFrame(
        [(k, 0, 2, 10 * k + i, 10 * k + i, f"{text} {k}{i}") for k in range(20) for i in range(3)],
        "key long, block long, side int, id long, component long, text string",
    )
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        found = compared(rows, lambda text: word_shingles(text, 4), 80)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert found.where("b is not null").count() == 40
    assert found.rdd.getNumPartitions() == 1
