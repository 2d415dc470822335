"""Rows that every operator must handle: null, empty, blank and very long texts, repeated rows, a null identifier."""

import pytest

SF01 = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long"

ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "word " * 30_000), (6, "same text here for all"),
    (6, "same text here for all"), (None, "text without an identifier"), (7, "é✓👍 中文 \x00   end"), (8, "x" * 5000),
]


@pytest.fixture
def docs_of(spark):
    """A documents table, with a column that clashes with results, of (doc_id, text[, lang]) rows."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or ""), 1) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return make
