"""The corpus pipeline: documents through five stages, each written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.common import shared_dir
from clientele.llm.decontaminate import decontaminated
from clientele.llm.fuzzy_lines import fuzzy_line_dedup
from clientele.llm.near_documents import near_documents
from clientele.llm.pieces import encode_pieces
from clientele.llm.quality import quality_rules

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of ``documents`` only; others are dropped before they can clash."""
    return docs.select(*DOCUMENT_COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, unchanged; null and empty texts go."""
    return quality_rules(_documents(docs), carry=DOCUMENT_COLUMNS).where("kept").select("carried.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that have a like earlier in the table.

    ``n_chars`` follows the text.  A document goes if lines were removed and no
    other line with a word is left; all others stay, also empty ones.
    """
    deduped = fuzzy_line_dedup(_documents(docs), carry=DOCUMENT_COLUMNS)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("carried.n_chars"))
    return deduped.where(~F.coalesce(emptied, F.lit(False))).select(
        "carried.doc_id", "text", "carried.lang", "carried.source", n_chars.alias("n_chars")
    )


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, Jaccard 0.8 or more.

    The smallest doc_id stays.  Rows with a null doc_id are in no group and
    stay; rows of one doc_id stay or go together.
    """
    docs = _documents(docs)
    gone = near_documents(docs, width=5, percent=80).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*DOCUMENT_COLUMNS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, unchanged."""
    return decontaminated(_documents(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, its best segmentations and whether it decodes to itself."""
    import public_tokenizers

    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("piece encoding", piece_stage),
]

#: The stages can't be expressed in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as Parquet and read as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
