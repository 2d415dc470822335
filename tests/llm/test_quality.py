import math
import random
import re
import unicodedata
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_rows import ODD, SF01, docs_of  # noqa: F401

from clientele.llm.quality import base_measures, class_counts, js_distance, quality_rules
from clientele.llm.queries import queries


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(inside),
        len(words) < 10 or 100 * len(inside) > 20 * len(words),
    )


def test_base_measures():
    texts = ["", None, "a b c d e f a b c d e", "x\nx \nx\n\n \n|#<", "a " * 40, "é\x0bé\x0c\x1cé\x85", "a b a b a b a b a"]
    assert [base_measures(t) for t in texts] == [plain(t) for t in texts]


def test_distance():
    p, q = np.array([1.0, 0, 0]), np.array([[0.0, 2, 0], [3, 0, 0], [1, 1, 0]])
    assert js_distance(p, q) == pytest.approx([1.0, 0.0, np.sqrt(0.3112781)], abs=1e-6)


def test_classes_count_characters_not_bytes():
    assert class_counts("aZ9 \n.|@é👍").tolist() == [1, 1, 1, 1, 1, 1, 1, 1, 0, 2]


def test_query_base_columns(spark):
    rows = {r.doc_id: r for r in queries()["op10_quality_rules"](spark, SF01).collect()}
    docs = duckdb.sql(f"select doc_id, text from '{SF01}/documents.parquet'").fetchall()
    assert len(rows) == len(docs)
    for doc_id, text in docs:
        r = rows[doc_id]
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == plain(text) and not (r.base_failed and r.kept)
    labels = dict(duckdb.sql(f"select doc_id, quality from '{SF01}/labels.parquet'").fetchall())
    good = [rows[d] for d, quality in labels.items() if quality == 1 and not rows[d].base_failed]
    assert sum(r.kept for r in good) >= 0.99 * len(good), "clean documents stay"


def test_junk_is_far_from_every_language(docs_of):
    r = random.Random(4)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(1, 9))) for _ in range(300)]
    clean = [(i, " ".join(r.choice(words) + r.choice(["", "", "", ",", "."]) for _ in range(200))) for i in range(60)]
    junk = [(1000, " ".join(f"{'#|%$&@'[i % 6] * (i % 5)}{i * i}" for i in range(300)))]
    rows = {r.doc_id: r for r in quality_rules(docs_of(clean + junk)).collect()}
    assert all(rows[i].kept for i, _ in clean)
    assert not rows[1000].kept and not rows[1000].base_failed and rows[1000].class_distance > 0.3


def test_odd_rows(docs_of):
    rows = quality_rules(docs_of(ODD), carry=("doc_id", "n_words")).collect()
    assert len(rows) == len(ODD) and all(r.carried.n_words == 1 for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[1].n_words, by_id[1].base_failed, by_id[1].kept, by_id[1].class_distance) == (0, True, False, None)
    assert by_id[5].n_repeat_words == 30_000
    assert quality_rules(docs_of([])).count() == 0


def made_up(r, letters, n, n_words=200):
    words = ["".join(r.choice(letters) for _ in range(r.randrange(1, 9))) for _ in range(300)]
    return [" ".join(r.choice(words) for _ in range(n_words)) for _ in range(n)]


LATIN, CYRILLIC = "etaoinshrdlu", "оеаинтсрвлкм"


def junk_text(seed):
    return " ".join(f"{'#|%$&@'[i % 6] * (i % 5)}{i * i + seed}" for i in range(300))


def test_rare_and_unlabelled_languages_have_references(docs_of):
    r = random.Random(6)
    many = [(i, t, "en") for i, t in enumerate(made_up(r, LATIN, 60))]
    rare = [(100 + i, t, "ru") for i, t in enumerate(made_up(r, CYRILLIC, 15))]
    unlabelled = [(200 + i, t, None) for i, t in enumerate(made_up(r, CYRILLIC, 5))]
    rows = {r.doc_id: r for r in quality_rules(docs_of(many + rare + unlabelled)).collect()}
    assert all(r.kept for r in rows.values())
    assert all(r.class_distance < 0.2 and r.word_distance is not None for r in rows.values())


@pytest.mark.parametrize("n", [1, 19])
def test_verdicts_do_not_turn_on_how_many_documents_a_language_has(docs_of, n):
    r = random.Random(7)
    clean = [(i, t, "en") for i, t in enumerate(made_up(r, LATIN, 30))]
    clean += [(100 + i, t, "ru") for i, t in enumerate(made_up(r, CYRILLIC, n))]
    clean += [(200, made_up(r, "αβγδεζηθικλ", 1)[0], None)]
    junk = [(900, junk_text(0), "ru"), (901, junk_text(1), "en"), (902, junk_text(2), None), (903, junk_text(3), "xx")]
    rows = {r.doc_id: r for r in quality_rules(docs_of(clean + junk)).collect()}
    assert {d for d, r in rows.items() if not r.kept} == {900, 901, 902, 903}
    assert not any(rows[d].base_failed for d in (900, 901, 902, 903))


def plain_script(text):
    inked = [c for c in text if c not in " \t\n\r"]
    kinds = Counter(unicodedata.name(c).split()[0] for c in inked if unicodedata.category(c).startswith("L"))
    if 2 * sum(kinds.values()) <= len(inked):
        return None
    return sorted(kinds, key=lambda k: (-kinds[k], k))[0]


def plain_words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in text))


def one_case_counts(text):
    lower, upper, *rest = class_counts(text).tolist()
    return [lower + upper, 0, *rest]


def plain_distance(p, q):
    """Jensen-Shannon distance of two histograms, by the sum over their bins."""
    total = 0.0
    for a, b in zip([x / sum(p) for x in p], [x / sum(q) for x in q], strict=True):
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
    return math.sqrt(max(0.0, total / 2))


def plain_verdicts(rows, named=None):
    """(class distance, word distance, kept) of every document, references counted one document at a time."""
    classes, words = {}, {}

    def key_of(text, lang):
        return (lang if lang and (named is None or lang in named) else "", plain_script(text))

    for _, text, lang in rows:
        key = key_of(text, lang)
        if not plain(text)[-1] and key[1]:
            classes.setdefault(key, Counter()).update(dict(enumerate(one_case_counts(text))))
            words.setdefault(key, Counter()).update(plain_words_of(text))
    out = {}
    for doc_id, text, lang in rows:
        key = key_of(text, lang)
        near_class, near_word = [], []
        for other in classes:
            if not other[0] and other != key:
                continue
            near_class.append(plain_distance(one_case_counts(text), [classes[other][i] for i in range(10)]))
            top = sorted(words[other].items(), key=lambda x: (-x[1], x[0].encode()))[:50]
            mine = Counter(plain_words_of(text))
            p, q = [mine[w] for w, _ in top], [n for _, n in top]
            near_word.append(plain_distance(p + [mine.total() - sum(p)], q + [words[other].total() - sum(q)]))
        out[doc_id] = (min(near_class), min(near_word), not plain(text)[-1] and min(near_class) <= 0.3 and min(near_word) <= 0.5)
    return out


@pytest.mark.parametrize("named", [None, {"en"}])
def test_references_and_verdicts_equal_brute_force(docs_of, named):
    r = random.Random(9)
    rows = [(i, t, "en") for i, t in enumerate(made_up(r, LATIN + "é", 12))]
    rows += [(20 + i, t + f" Ende {i}.", "de") for i, t in enumerate(made_up(r, LATIN[::-1] + "öü", 5))]
    rows += [(40 + i, t, "ru") for i, t in enumerate(made_up(r, CYRILLIC, 3))]
    rows += [(50 + i, t, None) for i, t in enumerate(made_up(r, CYRILLIC, 2) + made_up(r, LATIN, 2))]
    rows += [(60, made_up(r, LATIN, 1)[0], "ru"), (61, "б" * 70 + " " + made_up(r, CYRILLIC, 1)[0], "ru")]
    rows += [(70, junk_text(0), "de"), (71, junk_text(1), None), (72, "#a 1 " * 60, "en")]
    want = plain_verdicts(rows, named)
    got = {r.doc_id: r for r in quality_rules(docs_of(rows), max_langs=1 if named else 10_000).collect()}
    assert {d for d, x in want.items() if not x[2]} >= {70, 71, 72} and sum(x[2] for x in want.values()) >= 20
    for d, (near_class, near_word, kept) in want.items():
        assert (got[d].class_distance, got[d].word_distance) == pytest.approx((near_class, near_word), abs=1e-9), d
        assert got[d].kept == kept
