"""Language identification by prediction by partial matching (operator 9).

Each language has a variable-order byte context tree with PPM-C escape
probabilities, frozen after training.  A text's code length under a language is
the sum, byte by byte, of the exact cost in that language's tree; the language
with the shortest code wins.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientele.llm.common import cut, map_batches, small_batches

_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: int | None, folds: int = 5) -> bool:
    """crc32 of the identifier's digits, by remainder 0; a null one counts as empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == 0


class ContextTrees:
    """Frozen per-language context trees, laid out as tables over shared nodes.

    A node is a context of 0 to ``order`` bytes that some language has seen.
    ``cost[node, symbol, language]`` is the code length in bits of the symbol
    after the context, with PPM-C escapes to shorter contexts and at last to
    256 equal bytes, without exclusions.  Bytes that no language has seen share
    one symbol, whose cost is that of any single such byte.
    """

    def __init__(self, counts: dict[str, dict[bytes, int]], order: int, max_cells: int = 1 << 24):
        """``counts``: per language, how often each string of 1 to order + 1 bytes was seen.

        The most frequent contexts are kept, as many as ``max_cells`` costs allow.
        """
        self.order, self.langs = order, sorted(counts)
        seen = sorted({g[0] for c in counts.values() for g in c if len(g) == 1})
        self.symbol_of = np.full(256, len(seen), np.int64)
        self.symbol_of[seen] = range(len(seen))
        width = len(seen) + 1
        uses: Counter[bytes] = Counter()
        for c in counts.values():
            for g, n in c.items():
                uses[g[:-1]] += n
        uses[b""] = max([0, *uses.values()]) + 1
        often = sorted(uses, key=lambda g: (-uses[g], len(g), g))
        often = set(often[: max(1, max_cells // (width * max(1, len(counts))))])
        contexts: dict[bytes, None] = {}
        for g in sorted(often, key=lambda g: (len(g), g)):
            if not g or g[1:] in contexts:  # a context's shorter contexts are there too
                contexts[g] = None
        self.node = {g: i for i, g in enumerate(contexts)}
        followers: dict[bytes, dict[int, dict[int, int]]] = {}
        for k, lang in enumerate(self.langs):
            for g, n in counts[lang].items():
                followers.setdefault(g[:-1], {}).setdefault(k, {})[g[-1]] = n
        cost = np.empty((len(contexts), width, len(self.langs)), np.float32)
        for g, i in self.node.items():
            cost[i] = cost[self.node[g[1:]]] if g else 8.0  # shorter contexts come first
            for k, after in followers.get(g, {}).items():
                total, kinds = sum(after.values()), len(after)
                cost[i, :, k] += np.log2((total + kinds) / kinds)
                for b, n in after.items():
                    cost[i, self.symbol_of[b], k] = np.log2((total + kinds) / n)
        self.cost = cost.reshape(len(contexts) * width, len(self.langs))
        # step[n][node of n - 1 bytes, symbol]: the node of the n bytes' longest seen suffix
        self.width = width
        symbols = np.append(np.array(seen, np.int64), -1)
        self.step = np.empty((len(contexts), width), np.int32)
        for g, i in self.node.items():
            for s, b in enumerate(symbols.tolist()):
                h = g + bytes([b]) if b >= 0 else b""
                while h not in self.node or len(h) > order:
                    h = h[1:]
                self.step[i, s] = self.node[h]
        self.step = self.step.reshape(-1)

    def code_lengths(self, data: bytes) -> np.ndarray:
        """Bits under each language."""
        total = np.zeros(len(self.langs))
        block = 1 << 18
        for at in range(0, len(data), block):  # a byte's cost needs only ``order`` bytes before it
            before = min(at, self.order)
            symbols = self.symbol_of[np.frombuffer(data[at - before : at + block], np.uint8)]
            # nodes[i]: longest seen suffix of the up to ``order`` symbols before i
            nodes = np.zeros(len(symbols), np.int64)
            for _ in range(self.order):
                nodes[1:] = self.step[nodes[:-1] * self.width + symbols[:-1]]
            total += self.cost[nodes * self.width + symbols][before:].sum(axis=0, dtype=np.float64)
        return total


def _grams(order: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, Counter] = {}
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode()
                counts = by_lang.setdefault(lang, Counter())
                for n in range(1, order + 2):
                    counts.update([data[i : i + n] for i in range(len(data) - n + 1)])
            rows = [(la, g, n) for la, c in by_lang.items() for g, n in c.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.int64())], names=["lang", "gram", "n"],
            )

    return count


def train(
    docs: DataFrame, order: int = 3, max_docs: int = 300, max_bytes: int = 20_000, max_langs: int = 100,
    max_grams: int = 40_000,
) -> ContextTrees:
    """Context trees from a bounded sample of the labelled rows.

    Bounds: the ``max_langs`` languages with most rows; of each, up to
    ``max_docs`` rows by a hash of the text, among those of 1 to ``max_bytes``
    bytes (or as short as the language's shortest); the ``max_grams`` most
    frequent strings of each length.  A share of the hash values, four times
    what is wanted, is taken in the scan, so no other text is shuffled.
    Counting runs in Spark; the counts, so bounded, make the trees on the
    driver.
    """
    spark = docs.sparkSession
    small_batches(spark)
    labelled = docs.where("lang is not null and text is not null and text <> ''").select(
        "lang", "text", F.xxhash64("text").alias("h"), F.octet_length("text").alias("size")
    )
    sizes = (
        labelled.groupBy("lang").agg(F.count("*").alias("n"), F.min("size").alias("least"), F.min("h").alias("h0"))
        .orderBy(F.desc("n"), "lang").limit(max_langs)
    )
    langs = [(r.lang, max(r.least, max_bytes), min(1.0, 4 * max_docs / r.n), r.h0) for r in sizes.collect()]
    if not langs:
        return ContextTrees({}, order)
    limits = spark.createDataFrame(langs, "lang string, most int, share double, h0 long")
    slices = 1 << 20
    rows = (
        labelled.join(F.broadcast(limits), "lang")  # max_langs rows
        .where((F.pmod("h", F.lit(slices)) < F.col("share") * slices) | (F.col("h") == F.col("h0")))
        .where("size <= most")
    )
    first = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(slices)), "h", "text")
    rows = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= max_docs)
    sample = rows.select("lang", "text").repartition(16)
    counts = cut(
        sample.mapInArrow(_grams(order), "lang string, gram binary, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    often = Window.partitionBy("lang", F.length("gram")).orderBy(F.desc("n"), "gram")
    kept = counts.withColumn("r", F.row_number().over(often)).where(F.col("r") <= max_grams)
    out: dict[str, dict[bytes, int]] = {lang: {} for lang, *_ in langs}
    for r in kept.collect():  # at most max_langs * (order + 1) * max_grams short strings
        out[r.lang][bytes(r.gram)] = r.n
    return ContextTrees({lang: c for lang, c in out.items() if c}, order)


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def identify(docs: DataFrame, trees: ContextTrees, folds: int = 5) -> DataFrame:
    """One row a document: predicted language, and its share of the likelihood.

    ``und`` with score 0 if the text is null, empty or without a letter, or if
    no language was learned.  ``score`` is the winner's share of the summed
    likelihoods 2^-bits, between 0 and 1; ties go to the first language in
    alphabetical order.  Only the text enters a prediction.  ``held_out`` is
    true where crc32 of the identifier's digits leaves remainder 0.
    """

    def predict(columns: list[list]) -> list[list]:
        langs, scores = [], []
        for text in columns[1]:
            if not trees.langs or not text or not _LETTER.search(text):
                langs.append("und")
                scores.append(0.0)
                continue
            bits = trees.code_lengths(text.encode())
            best = int(bits.argmin())
            langs.append(trees.langs[best])
            scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum()))
        return [columns[0], [held_out(d, folds) for d in columns[0]], langs, scores]

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), predict, SCHEMA)


def language_id(docs: DataFrame, folds: int = 5, **bounds: int) -> DataFrame:
    """Learn from the documents that aren't held out, predict for all."""
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(folds))
    return identify(docs, train(docs.where(fold != 0).select("lang", "text"), **bounds), folds)


__all__ = ["ContextTrees", "held_out", "identify", "language_id", "train"]
