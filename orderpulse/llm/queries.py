"""The registered queries of the operators in this folder, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderpulse.llm import (
    bpe, decontam, divergence, importance, langid, pieces, quality_rules, secrets, sharding, simhash, warc, wavelet, whitening,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_digest(_table(spark, folder, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_copy_digest(_table(spark, folder, "documents"))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(_table(spark, folder, "documents"))


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_digest(_table(spark, folder, "pages"))


def op5_token_wavelet(spark: SparkSession, folder: str) -> DataFrame:
    return wavelet.token_digest(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharding_digest(_table(spark, folder, "documents"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_digest(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return importance.quality_digest(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_documents(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contamination_digest(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op11_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    encoded = pieces.encode_documents(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(_table(spark, folder, "embeddings"))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.source_divergences(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scans": op1_secret_scans,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_language_id": op3_language_id,
    "op4_warc": op4_warc,
    "op5_token_wavelet": op5_token_wavelet,
    "op6_sharding": op6_sharding,
    "op7_quality_rules": op7_quality_rules,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_byte_level_bpe": op9_byte_level_bpe,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_source_divergence": op13_source_divergence,
}

SQL: dict[str, str] = {
    "op1_secret_scans": secrets.secret_sql(),
    "op4_warc": warc.archive_sql(),
    "op10_benchmark_decontamination": decontam.DECONTAMINATION_SQL,
    "op13_source_divergence": divergence.DIVERGENCE_SQL,
}
