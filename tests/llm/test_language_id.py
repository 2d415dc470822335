import math
import zlib
from collections import Counter

import duckdb
import pytest
from llm_rows import ODD, SF01, docs_of  # noqa: F401

from clientele.llm.language_id import ContextTrees, held_out, identify, language_id, train
from clientele.llm.queries import queries


def counts_of(texts, order):
    out = Counter()
    for t in texts:
        for n in range(1, order + 2):
            out.update(t[i : i + n] for i in range(len(t) - n + 1))
    return out


def plain_bits(counts, data, order):
    """Code length by walking the contexts one byte at a time."""
    total = 0.0
    for i in range(len(data)):
        for n in range(min(order, i), -2, -1):
            if n < 0:
                total += 8.0
                break
            context = data[i - n : i]
            after = {g[-1]: c for g, c in counts.items() if len(g) == n + 1 and g[:-1] == context}
            if not after:
                continue
            whole = sum(after.values()) + len(after)
            if data[i] in after:
                total += math.log2(whole / after[data[i]])
                break
            total += math.log2(whole / len(after))
    return total


@pytest.mark.parametrize("order", [0, 1, 2, 3])
def test_code_lengths_are_exact(order):
    texts = {"a": [b"the cat sat on the mat", b"that hat"], "b": [b"der hund und die katze", "schön".encode()]}
    counts = {k: counts_of(v, order) for k, v in texts.items()}
    trees = ContextTrees(counts, order)
    for data in (b"the hund", b"zzz", "schön the".encode(), b"t", b""):
        bits = trees.code_lengths(data)
        for k, lang in enumerate(trees.langs):
            assert bits[k] == pytest.approx(plain_bits(counts[lang], data, order), rel=1e-5)


def test_few_contexts_are_kept_whole():
    counts = {"a": counts_of([b"abracadabra" * 5], 3)}
    small = ContextTrees(counts, 3, max_cells=60)
    assert all(g[1:] in small.node for g in small.node if g)
    assert small.code_lengths(b"abra")[0] > 0


def test_long_texts_are_read_in_blocks_without_seams():
    trees = ContextTrees({"a": counts_of([b"abcabd" * 9], 3)}, 3)
    data = b"abcabdabx" * 40_000
    period = trees.code_lengths(data[:9000]) - trees.code_lengths(data[: 9000 - 900])
    assert trees.code_lengths(data)[0] == pytest.approx(float(period[0] * len(data) / 900), rel=1e-4)


def test_odd_rows(docs_of):
    english = [(100 + i, f"the little dog and the cat number {i} went home", "en") for i in range(30)]
    german = [(200 + i, f"der kleine hund und die katze nummer {i} gingen heim", "de") for i in range(30)]
    trees = train(docs_of(english + german + ODD))
    rows = identify(docs_of(ODD + [(9, "12345 !!", None), (10, "die katze und der hund", None)]), trees).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(ODD) + 2
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (1, 2, 3, 9))
    assert by_id[10].lang_pred == "de" and 0 < by_id[10].score <= 1
    assert all(r.held_out == held_out(r.doc_id) for r in rows)
    nothing = identify(docs_of(ODD), train(docs_of([])))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert language_id(docs_of([])).count() == 0


def test_held_out_accuracy(spark):
    rows = queries()["op9_language_id"](spark, SF01).collect()
    truth = dict(duckdb.sql(f"select doc_id, lang from '{SF01}/documents.parquet'").fetchall())
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == truth[r.doc_id] for r in held)
    assert len(held) > 150 and right >= 0.98 * len(held)
