import random
from collections import Counter

import pytest
from llm_rows import ODD, SF01, docs_of  # noqa: F401

from clientele.llm.queries import queries, sql_twins
from clientele.llm.spelling import blocks, document_words, near_in_list, near_words, roots, spelling_variants
from oracle import compare, duck


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def vocabulary_of(r, n, letters="ab", lengths=(5, 9)):
    return sorted({"".join(r.choice(letters) for _ in range(r.randint(*lengths))) for _ in range(n)})


def test_sorted_list_scan_equals_edit_distance():
    r = random.Random(1)
    for _ in range(60):
        words = vocabulary_of(r, 25, "abc", (0, 5))
        queries_ = r.sample(words, min(10, len(words)))
        want = {(i, j) for i, q in enumerate(queries_) for j, w in enumerate(words) if distance(q, w) == 1}
        assert set(near_in_list(words, queries_)) == want


@pytest.mark.parametrize("most", [2, 40, 10_000])
def test_all_pairs_whatever_the_block_size(spark, most):
    words = vocabulary_of(random.Random(2), 400)
    got = near_words(spark.createDataFrame([(w, 3) for w in words], "word string, n long"), 5, most).collect()
    pairs = [(x.word, x.near) for x in got]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if abs(len(a) - len(b)) < 2 and distance(a, b) == 1}


def test_blocks_stay_small(spark):
    words = ["abcdef" + w for w in vocabulary_of(random.Random(3), 3000, "abcdefghij", (5, 6))]
    dealt = blocks(spark.createDataFrame([(w, 3) for w in words], "word string, n long"), 5, 30)
    largest = dealt.groupBy("size", "lo", "hi", "shared").count().where("hi - lo > 1").agg({"count": "max"}).first()[0]
    assert largest <= 30, "one prefix for all words doesn't make one block"


def test_roots_follow_forms_to_the_last(spark):
    forms = [(f"w{i:02}", f"w{i + 1:02}") for i in range(20)] + [("x", "w05"), ("y", "z")]
    got = {r.word: r.root for r in roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert got == {**{f"w{i:02}": "w20" for i in range(20)}, "x": "w20", "y": "z"}
    assert roots(spark.createDataFrame([], "word string, form string")).count() == 0


def test_words_of_a_document():
    assert document_words(1, "Straße STRASSE abcd Éclair×÷x", 5, 10**9) == {"straße": 1, "strasse": 1, "Éclair×÷x": 1}
    got = document_words(1, "Hello hello world", 5, 1)  # every run loses a letter
    assert all(len(w) >= 5 for w in got) and not got
    assert document_words(None, None, 5, 97) == Counter()


def test_query_equals_its_twin(spark):
    name = "op13_spelling_variants"
    result = compare(spark, duck(SF01), name, queries()[name](spark, SF01), sql_twins()[name])
    assert result["columns_match"] and result["rows"][0] > 10_000
    assert result["values_match"], result["diff"]


def test_forms_ties_and_counts(docs_of):
    text = "colour " * 9 + "color " * 4 + "colors " * 3 + "colou " * 9 + "kolour " * 3 + "single " * 3 + "twice " * 2
    rows = {r.word: r for r in spelling_variants(docs_of([(1, text)]), slip=10**9).collect()}
    assert set(rows) == {"colour", "color", "colors", "colou", "kolour", "single"}
    assert (rows["color"].form, rows["color"].form_n, rows["color"].n_near) == ("colou", 9, 3), "ties: the smaller word"
    assert (rows["colors"].form, rows["colors"].root) == (None, "colors")
    assert (rows["kolour"].form, rows["kolour"].root) == ("colour", "colour")
    assert (rows["single"].form, rows["single"].root, rows["single"].n_near, rows["single"].form_n) == (None, "single", 0, None)


def test_odd_rows(docs_of):
    got = {r.word: r.n for r in spelling_variants(docs_of(ODD), min_count=1, slip=10**9).collect()}
    assert got == {"identifier": 1, "without": 1, "x" * 5000: 1}
    assert spelling_variants(docs_of([])).count() == 0
    assert spelling_variants(docs_of([(1, None), (2, "")])).count() == 0
