import random
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from llm_rows import ODD, SF01, docs_of  # noqa: F401

from clientele.llm.pieces import PieceModel, decode_pieces, encode_pieces
from clientele.llm.queries import queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return PieceModel(PATH)


def all_scores(model, word):
    """Scores of all segmentations of a word, best first."""
    ends, _, _ = model.lattice(word)

    def below(j):
        return [0.0] if j == 0 else [s + edge for i, edge, _ in ends[j] for s in below(i)]

    return sorted(below(len(word)), reverse=True)


def test_n_best_equals_all_segmentations(model):
    r = random.Random(5)
    words = ["▁the", "▁nation", "ing.", "▁▁▁x", "é👍", "▁aaaaaaa", "日本"]
    words += ["".join(r.choice("▁theanionr.é") for _ in range(r.randrange(1, 9))) for _ in range(300)]
    for word in words:
        scores = all_scores(model, word)
        assert [s for s, _ in model.n_best(word, 6)] == pytest.approx(scores[:6])
        ids, best, behind = model.solve(word)
        assert best == pytest.approx(scores[0]) and ids == model.n_best(word, 1)[0][1]
        assert behind == pytest.approx(scores[0] - scores[1]) if len(scores) > 1 else behind == float("inf")


def test_words_together_equal_words_alone(model):
    r = random.Random(6)
    for n in (1, 2, 5, 9):
        words = ["".join(r.choice("▁theanionr.é👍") for _ in range(n)) for _ in range(200)]
        flat, counts, best, behind = model.solve_many(words)
        at = 0
        for k, word in enumerate(words):
            ids, score, gap = model.solve(word)
            assert flat[at : at + counts[k]].tolist() == list(ids)
            assert (best[k], behind[k]) == (score, gap)
            at += counts[k]


def test_text_n_best_equals_one_lattice_over_the_text(model):
    for text in ("a nation", "to the", "in on at", "x é"):
        lattice = "▁" + text.replace(" ", "▁")
        got = [b["score"] for b in model.encode(text, 5)[1]]
        assert got == pytest.approx(all_scores(model, lattice)[: len(got)])


def test_decoding_equals_the_library(model):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in ("", " ", "  Hello  world\n\tà ✓ ", "日本語 👍🏽", "<s>hi</s><0x0A>", "▁a"):
        ids = model.encode(text)[0]
        assert model.decode(ids) == sp.decode(ids)
        assert model.decode(sp.encode(text)) == sp.decode(sp.encode(text))


def test_kept_words_stay_solved():
    small, fresh = PieceModel(PATH, cache_words=40), PieceModel(PATH)
    r = random.Random(8)
    words = ["".join(r.choice("theanionr.é\n👍") for _ in range(r.randrange(1, 9))) for _ in range(60)]
    for _ in range(30):
        texts = [" ".join(r.choice(words) for _ in range(r.randrange(0, 12))) for _ in range(4)]
        got, want = small.encode_batch(texts, 3), fresh.encode_batch(texts, 3)
        assert got[2] == want[2]
        assert all(np.array_equal(got[i], want[i]) for i in (0, 1, 3, 4))


def test_odd_rows(docs_of):
    encoded = encode_pieces(docs_of(ODD), PATH)
    rows = encoded.collect()
    assert len(rows) == len(ODD) and all(r.round_trip for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].ids == [] and by_id[1].best[0].score == 0.0
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert all(by_id[d].library_ids == sp.encode(t or "") for d, t in ODD)
    back = {r.doc_id: r.text for r in decode_pieces(encoded, PATH).collect()}
    assert all(back[d] == (t or "") for d, t in ODD)
    assert not encode_pieces(docs_of([(1, "a ▁ b")]), PATH).first().round_trip
    assert encode_pieces(docs_of([]), PATH).count() == 0


def test_query_decodes_every_text(spark):
    rows = queries()["op5_encode_pieces"](spark, SF01).collect()
    texts = dict(duckdb.sql(f"select doc_id, text from '{SF01}/documents.parquet'").fetchall())
    assert len(rows) == len(texts)
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for r in rows:
        own = sp.encode(texts[r.doc_id])
        assert (r.n_library, r.library_crc32) == (len(own), zlib.crc32(np.array(own, "<i4").tobytes()))
        assert r.round_trip and r.n_bytes == len(texts[r.doc_id].encode())
        assert r.best_scores == sorted(r.best_scores, reverse=True) and r.best_pieces[0] == r.n_pieces


def test_a_large_batch_needs_little_memory(spark, monkeypatch):
    """A worker keeps its model, and so what its largest batch took: whole batches of words and places cost 16 bytes a byte and more."""
    from clientele.llm import pieces as module

    monkeypatch.setattr(module, "map_batches", lambda df, run, schema: run)
    run = module.encode_pieces(spark.createDataFrame([], "doc_id long, text string"), PATH)
    r = random.Random(3)
    words = ["".join(r.choice("thenatiorsé") for _ in range(r.randrange(2, 9))) for _ in range(500)]
    texts = ["", *(" ".join(r.choice(words) for _ in range(10_000)) for _ in range(30)), None, "é 日本"]
    small = [run([[i], [t]]) for i, t in enumerate(texts)]
    tracemalloc.start()
    try:
        large = run([list(range(len(texts))), texts])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    plain = [[x.to_pylist() if isinstance(x, pa.Array) else x for x in rows] for rows in (large, *small)]
    assert plain[0] == [[x for rows in plain[1:] for x in rows[k]] for k in range(10)]
    size = sum(len((t or "").encode()) for t in texts)
    assert peak < 16 * size, peak / size
