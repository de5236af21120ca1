"""A pipeline that cleans a text corpus and turns it into token ids, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from adtally.llm.bytebpe import encode_decode
from adtally.llm.decontaminate import without_contaminated
from adtally.llm.neardup import first_of_each_group
from adtally.llm.quality import good_rows
from adtally.llm.secrets import redact
from adtally.llm.ship import ship
from adtally.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    ship(spark)
    return good_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return first_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    ship(spark)
    return redact(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and what they decode to: doc_id, n_tokens, ids, decoded."""
    ship(spark)
    return encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("byte-level BPE", byte_bpe),
]

#: A trained classifier and a tokenizer are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(spark, step(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
