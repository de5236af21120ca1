"""The corpus operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm import licenses, neardup, sharding, substrings
from adtally.llm.alignment import align_tokens
from adtally.llm.bytebpe import encode_decode
from adtally.llm.decontaminate import contaminated
from adtally.llm.licenses import scan_licenses
from adtally.llm.neardup import near_duplicates
from adtally.llm.neighbours import nearest
from adtally.llm.pii import scan_pii
from adtally.llm.quality import quality_scores
from adtally.llm.secrets import scan_secrets
from adtally.llm.sharding import shard_by_key
from adtally.llm.ship import ship
from adtally.llm.substrings import buckets_for, remove_repeats
from adtally.llm.tokencount import token_counts
from adtally.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_key(_table(spark, sf_dir, "documents"), 8)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op3_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = remove_repeats(docs, buckets_for(spark, f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), size=2)


def op11_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


def op12_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_pii(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op13_fragment_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jump_sharding": op1_jump_sharding,
    "op2_license_scan": op2_license_scan,
    "op3_inverted_multi_index": op3_inverted_multi_index,
    "op4_secret_scan": op4_secret_scan,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_compression_quality": op7_compression_quality,
    "op8_token_counts": op8_token_counts,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_lanczos_whitening": op11_lanczos_whitening,
    "op12_pii_anchors": op12_pii_anchors,
    "op13_fragment_alignment": op13_fragment_alignment,
}
#: SQL for the same rows, where SQL can express them.
ORACLE: dict[str, str] = {
    "op1_jump_sharding": sharding.SQL, "op2_license_scan": licenses.SQL, "op6_substring_dedup": substrings.SQL,
    "op10_minhash_near_dedup": neardup.SQL}
