"""Registered queries of the text operators, over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.decontaminate import benchmark_leaks
from clientele.llm.fuzzy_lines import fuzzy_line_dedup
from clientele.llm.language_id import language_id
from clientele.llm.licenses import license_scan
from clientele.llm.long_repeats import remove_repeats
from clientele.llm.main_text import main_text
from clientele.llm.near_documents import near_documents
from clientele.llm.pieces import encode_pieces
from clientele.llm.quality import quality_rules
from clientele.llm.resampling import importance_resample
from clientele.llm.sharding import pack_shards
from clientele.llm.spelling import spelling_variants
from clientele.llm.token_counts import token_counts
from clientele.llm.twins import sql_twins

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(_table(spark, sf_dir, "documents"))
    return found.drop("spans")


def op2_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = fuzzy_line_dedup(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_pack_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_shards(_table(spark, sf_dir, "documents"))


def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_encode_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_pieces(_table(spark, sf_dir, "documents"), model, with_ids=False)
    return encoded.select(
        "doc_id", "n_bytes", "n_pieces", "ids_crc32", F.col("best.score").alias("best_scores"),
        F.col("best.n_pieces").alias("best_pieces"), "round_trip", "n_library", "library_crc32",
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_fuzzy_lines": op2_fuzzy_lines,
        "op3_pack_shards": op3_pack_shards,
        "op4_benchmark_leaks": op4_benchmark_leaks,
        "op5_encode_pieces": op5_encode_pieces,
        "op6_token_counts": op6_token_counts,
        "op7_long_repeats": op7_long_repeats,
        "op8_near_documents": op8_near_documents,
        "op9_language_id": op9_language_id,
        "op10_quality_rules": op10_quality_rules,
        "op11_main_text": op11_main_text,
        "op12_importance_resampling": op12_importance_resampling,
        "op13_spelling_variants": op13_spelling_variants,
    }


__all__ = ["queries", "sql_twins"]
