import corpus_pipeline
from llm_rows import SF01, docs_of  # noqa: F401

from clientele.llm.decontaminate import normal
from clientele.llm.queries import queries
from test_fuzzy_lines import brute_gone
from test_near_documents import brute_components

PROSE = [
    "A river runs below the old town and nobody remembers when the bridge was built",
    "Seven merchants carried salt over the northern pass before the first snow fell",
    "She kept the letters in a tin box under the stairs and never opened them again",
    "The harbour master wrote down every ship, its cargo and the weather of the day",
    "Small lamps were lit along the canal while the last boats went home in silence",
]


def test_stages_do_what_brute_force_does(spark, docs_of, tmp_path):
    """Each stage on its predecessor's output, over a table with every planted case."""
    item = "how many ships left the harbour in the spring of the third year of the war"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    long = " ".join(f"{a} {b}" for i in range(14) for a, b in zip(PROSE[0].split(), PROSE[1 + i % 4].split()[i // 4 :]))
    long = " ".join(dict.fromkeys(long.split())) + " " + " ".join(f"{w}{i}" for i, w in enumerate(PROSE[2].split() * 4))
    rows = [(i, f"{p}.\nNumber {i} stands alone here {i * 37} times with nothing like it.") for i, p in enumerate(PROSE)]
    rows += [(20, long), (21, long.replace(" salt ", " wool ", 1)), (22, "spam " * 50), (23, None), (24, ""), (25, "tiny")]
    rows += [(30, f"{PROSE[0]} and further words.\n{item.upper()}. What comes after it is another line of text.")]
    rows += [(40, rows[0][1]), (41, f"{rows[1][1]}\nAnd one more line that is not found anywhere else at all.")]
    docs = docs_of(rows).drop("n_words")
    texts = dict(rows)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == list(corpus_pipeline.DOCUMENT_COLUMNS), name
        out.write.parquet(f"{tmp_path}/stage-{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage-{k}")
        if k == 0:
            kept = {r.doc_id: r.text for r in docs.collect()}
            assert all(texts[d] == t for d, t in kept.items())
            assert kept.keys() == texts.keys() - {22, 23, 24, 25}
        elif k == 1:
            gone = brute_gone(sorted(texts.items()))
            want = {
                d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in texts.items()
            }
            kept = {r.doc_id: r.text for r in docs.collect()}
            assert kept == {d: t for d, t in want.items() if t.strip()} and gone
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        elif k == 2:
            want = {d: t for d, t in texts.items() if brute_components(texts, 5)[d][1] == d}
            kept = {r.doc_id: r.text for r in docs.collect()}
            assert kept == want
        elif k == 3:
            kept = {r.doc_id: r.text for r in docs.collect()}
            assert kept == {d: t for d, t in texts.items() if normal(item) not in normal(t)} and 30 not in kept
        else:
            last = docs.collect()
            assert {r.doc_id for r in last} == texts.keys() and all(r.round_trip and len(r.ids) for r in last)
            break
        texts = kept


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF01).select("doc_id", "n_pieces", "round_trip").collect()
    assert 700 < len(rows) < 900 and len({r.doc_id for r in rows}) == len(rows) and all(r.round_trip for r in rows)
    leaks = {r.doc_id for r in queries()["op4_benchmark_leaks"](spark, SF01).collect()}
    assert leaks


def test_five_stages_are_registered():
    import __spark_entry__

    assert len(corpus_pipeline.STAGES) == 5 and "pipeline" in __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in __spark_entry__.queries()) == 1
