import random

import duckdb
import public_tokenizers
from llm_rows import ODD, SF01, docs_of  # noqa: F401
from tokenizers import Tokenizer

from clientele.llm.queries import queries
from clientele.llm.token_counts import PairMerger, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_counts_equal_the_library():
    library, mine = Tokenizer.from_file(PATH), PairMerger(PATH)
    texts = [t for (t,) in duckdb.sql(f"select text from '{SF01}/documents.parquet' limit 200").fetchall()]
    r = random.Random(7)
    alphabet = "aB'sΣςİſéǺẞ１２ \t\n\x1c\x85\xa0 ​﻿中文字🙂👍🏽!?.٣Ⅷ½'ll’re'D\x00ﬁǅ"
    for _ in range(3000):
        x = "".join(r.choice(alphabet) for _ in range(r.randrange(1, 14)))
        texts.append(x + r.choice(["", "", "<|startoftext|>", "<|endoftext|>" + x]))
    assert [mine.count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_a_full_cache_changes_nothing():
    small, large = PairMerger(PATH, cache_words=3), PairMerger(PATH)
    text = "the quick brown fox jumps over the lazy dog and the quick cat"
    assert small.count(text) == large.count(text)


def test_odd_rows(docs_of):
    rows = token_counts(docs_of(ODD), PATH).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[1].n_bytes, by_id[1].n_tokens, by_id[1].over_limit) == (0, 0, False)
    assert (by_id[5].n_tokens, by_id[5].over_limit) == (30_000, True)
    assert token_counts(docs_of([]), PATH).count() == 0


def test_query_equals_the_library(spark):
    library = Tokenizer.from_file(PATH)
    got = {r.doc_id: r for r in queries()["op6_token_counts"](spark, SF01).collect()}
    rows = duckdb.sql(f"select doc_id, text from '{SF01}/documents.parquet'").fetchall()
    assert len(rows) == len(got)
    for (doc_id, text), e in zip(rows, library.encode_batch([t for _, t in rows], add_special_tokens=False), strict=True):
        r = got[doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), len(e.ids), len(e.ids) > 2048)
