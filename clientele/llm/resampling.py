"""Target-distribution importance resampling (operator 12).

Texts are hashed into feature buckets; a bucket's gain says how much commoner
it is in the target than in the corpus.  A document's score is the floored mean
of its features' gains plus Gumbel noise from its identifier, so that the
highest scores are a draw without replacement.  Exact ranks come from parallel
sorting by regular sampling: sorted runs, regular splitters, exchanged
segments, prefix counts.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import ALNUM_ONLY, cut, map_batches, small_batches

#: Features whose bucket or gain a task remembers.
REMEMBERED = 500_000


def features(text: str | None, max_run: int) -> tuple[int, list[bytes]]:
    """Number of words, and all runs of 1 to ``max_run`` of them; a null text has none."""
    words = (text or "").encode().translate(ALNUM_ONLY).split()
    found = list(words)
    for k in range(2, max_run + 1):
        found += [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    return len(words), found


def bucket_counts(texts: DataFrame, max_run: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket.

    A task sends at most ``buckets`` rows and the driver gets as many.
    """
    small_batches(texts.sparkSession)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            counts: Counter[bytes] = Counter()
            for text in batch.column(0).to_pylist():
                counts.update(features(text, max_run)[1])
                if len(counts) > REMEMBERED:
                    _add(total, counts)
                    counts.clear()
            _add(total, counts)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    sums = texts.mapInArrow(tally, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():
        out[r.bucket] = r.n
    return out


def _add(total: np.ndarray, counts: Counter[bytes]) -> None:
    if counts:
        at = np.fromiter((zlib.crc32(f) % len(total) for f in counts), np.int64, len(counts))
        np.add.at(total, at, np.fromiter(counts.values(), np.int64, len(counts)))


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln) of the smoothed share of a bucket in the target over that in the corpus, in doubles."""
    buckets = len(corpus)
    all_corpus, all_target = float(corpus.sum() + buckets), float(target.sum() + buckets)
    return [
        math.floor(1000 * math.log((t + 1) * all_corpus / ((s + 1) * all_target)))
        for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist(), strict=True)
    ]


class _Gains(dict):
    """Gain of each feature met so far."""

    def __init__(self, gains: list[int]):
        self.gains = gains

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[feature] = gain = self.gains[zlib.crc32(feature) % len(self.gains)]
        return gain


def noise(seed: int, doc_id: int | None) -> int:
    """Gumbel noise in thousandths from the first 32 bits of sha256; a null identifier counts as empty text."""
    name = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h = int.from_bytes(hashlib.sha256(name).digest()[:4], "big")
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORED = "doc_id long, n_features long, n_words long, weight long, score long"


def scored(docs: DataFrame, gains: list[int], max_run: int, seed: int) -> DataFrame:
    """Weight and score of every document: one pass over the texts, no shuffle."""

    def run(columns: list[list]) -> list[list]:
        known = _Gains(gains)
        out = []
        for doc_id, text in zip(*columns, strict=True):
            n_words, found = features(text, max_run)
            weight = sum(map(known.__getitem__, found)) // len(found) if found else 0
            out.append((len(found), n_words, weight, weight + noise(seed, doc_id)))
        return [columns[0], *([r[i] for r in out] for i in range(4))]

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, SCORED)


# -- parallel sorting by regular sampling ------------------------------------

NO_ID = -(1 << 63)


def _order() -> list:
    """Order of ranks: score down, identifier up (null first); rows equal in it differ in nothing else."""
    return [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("n_features")]


class _Run:
    """One task's sorted rows as arrays, and the total order over rows of all runs."""

    def __init__(self, batches: Iterator[pa.RecordBatch], schema: pa.Schema):
        batches = list(batches)
        self.table = pa.Table.from_batches(batches) if batches else schema.empty_table()
        self.number = TaskContext.get().partitionId()
        self.score, self.doc_id, self.n_features = (
            self.table[c].fill_null(NO_ID).to_numpy() for c in ("score", "doc_id", "n_features")
        )

    def __len__(self) -> int:
        return self.table.num_rows

    def key(self, i: int) -> tuple[int, ...]:
        return (-int(self.score[i]), int(self.doc_id[i]), int(self.n_features[i]), self.number, i)


def _arrow_schema() -> pa.Schema:
    return pa.schema([(c.split()[0], pa.int64()) for c in SCORED.split(", ")])


SAMPLE = "a long, b long, c long, d long, e long, n long"


def regular_samples(runs: DataFrame, each: int) -> DataFrame:
    """From every sorted run up to ``each`` evenly spaced keys, with the number of rows each stands for."""
    schema = _arrow_schema()

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _Run(batches, schema)
        if len(run):
            at = sorted({len(run) * i // each for i in range(each)})
            sizes = np.diff([*at, len(run)]).tolist()
            rows = [(*run.key(i), n) for i, n in zip(at, sizes, strict=True)]
            yield pa.RecordBatch.from_pydict({c: [r[i] for r in rows] for i, c in enumerate("abcden")})

    return runs.mapInArrow(sample, SAMPLE)


def splitters(samples: list[tuple[int, ...]], segments: int) -> list[tuple[int, ...]]:
    """Keys that cut the samples, weighed by their rows, into ``segments`` near-equal parts."""
    samples = sorted(samples)
    total, before, out = sum(s[-1] for s in samples), 0, []
    for s in samples:
        if before * segments >= total * (len(out) + 1) and len(out) < segments - 1:
            out.append(s[:-1])
        before += s[-1]
    return out


def into_segments(runs: DataFrame, cuts: list[tuple[int, ...]]) -> DataFrame:
    """Every sorted run cut at the splitters: its rows with the number of their segment."""
    schema = _arrow_schema()
    names = [*schema.names, "segment"]

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _Run(batches, schema)
        ends = [bisect_left(range(len(run)), c, key=run.key) for c in cuts]
        sizes = np.diff([0, *ends, len(run)])
        segment = pa.array(np.repeat(np.arange(len(sizes), dtype=np.int64), sizes))
        yield from run.table.append_column("segment", segment).select(names).to_batches(max_chunksize=100_000)

    return runs.mapInArrow(tag, f"{SCORED}, segment long")


def first_ranks(runs: DataFrame, percent: int, max_samples: int = 1 << 20) -> DataFrame:
    """``runs`` with ``rank``: 1, 2, 3 ... for the first ``percent`` percent (floored) in that order, else null.

    ``runs`` holds stored rows, sorted within each partition.  Only keys reach
    the driver: about ``max_samples`` over all runs (one a run at least) and one
    count a segment.  Segments, as many as ``spark.sql.shuffle.partitions``,
    differ in size by at most the rows between two samples of each run; a row's
    place in its run is part of its key, so even equal rows are spread.
    Segments that lie behind the last rank stay where they are.
    """
    spark = runs.sparkSession
    segments = int(spark.conf.get("spark.sql.shuffle.partitions"))
    each = max(1, min(4 * segments, max_samples // max(1, runs.rdd.getNumPartitions())))
    samples = [tuple(r) for r in regular_samples(runs, each).collect()]
    drawn = percent * sum(s[-1] for s in samples) // 100
    tagged = into_segments(runs, splitters(samples, segments))
    counts = {r.segment: r["count"] for r in tagged.groupBy("segment").count().collect()}
    offsets, before = [], 0
    for k in range(segments):
        offsets.append(before)
        before += counts.get(k, 0)
    used = max(1, sum(o < drawn for o in offsets))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place = -1, 0
        for batch in batches:
            ranks = []
            for segment in batch.column("segment").to_pylist():
                last, place = segment, place + 1 if segment == last else 1
                rank = offsets[segment] + place
                ranks.append(rank if rank <= drawn else None)
            columns = [*batch.columns[:-1], pa.array(ranks, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "rank"])

    merged = (
        tagged.where(F.col("segment") < used).repartitionById(used, F.col("segment").cast("int"))
        .sortWithinPartitions("segment", *_order())
    )
    rest = tagged.where(F.col("segment") >= used).drop("segment").withColumn("rank", F.lit(None).cast("long"))
    return merged.mapInArrow(number, f"{SCORED}, rank long").union(rest)


def importance_resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, max_run: int = 1,
    buckets: int = 10_000, seed: int = 2024,
) -> DataFrame:
    """One row a document: n_features, n_words, weight, score, and its rank if it is drawn.

    ``docs`` has doc_id and text, ``target`` has text; other columns are ignored.
    Of the N documents with ``min_words`` words or more, floor(percent * N / 100)
    are drawn.  Null and empty texts have no features and weight 0; with an empty
    target or corpus the smoothed shares are equal and every gain is that of the
    totals.  A null doc_id draws its noise from empty text and comes before the
    other identifiers in a tie; rows of one doc_id are drawn apart.
    """
    corpus = bucket_counts(docs.select("text"), max_run, buckets)
    wanted = bucket_counts(target.select("text"), max_run, buckets)
    rows = scored(docs, bucket_gains(corpus, wanted), max_run, seed)
    rows = cut(rows.sortWithinPartitions(*_order()))
    short = rows.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return first_ranks(rows.where(F.col("n_words") >= min_words), percent).union(short)
