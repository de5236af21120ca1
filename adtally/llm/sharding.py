"""Shards by jump consistent hashing (Lamping and Veach, 2014).

A stable key jumps from shard to shard, each time to a later one, until the
next jump would leave the range. No ring table is kept, and with one shard
more a key either stays or goes to the new shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.text import U64, mix
from adtally.session import stage

_MULTIPLIER = U64(2862933555777941757)  # fixed value of the published algorithm


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key."""
    keys = keys.astype(U64)
    shard = np.zeros(len(keys), np.int64)
    going = np.arange(len(keys))
    at = np.zeros(len(keys), np.int64)
    while len(going):
        shard[going] = at[going]
        keys[going] = keys[going] * _MULTIPLIER + U64(1)
        step = ((keys[going] >> U64(33)) + U64(1)).astype(np.float64)
        at[going] = ((shard[going] + 1) * (2.0**31 / step)).astype(np.int64)
        going = going[at[going] < shards]
    return shard


def _place(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(shards, np.int64)
        for b in batches:
            ids = b.column("doc_id")
            known = np.array(ids.is_valid())
            number = np.array(ids.fill_null(0)).astype(np.int64)
            keys = np.where(known, mix(number.view(U64) + U64(1)), U64(0))
            shard, grown = jump(keys, shards), jump(keys, shards + 1)
            rank = np.empty(len(shard), np.int64)
            for s in range(shards):
                own = np.flatnonzero(shard == s)
                rank[own] = seen[s] + np.arange(len(own))
                seen[s] += len(own)
            yield pa.RecordBatch.from_arrays(
                [*b.select(["doc_id", "size", "text_crc32", "part"]).columns, pa.array(shard.astype(np.int32)),
                 pa.array(rank), pa.array(grown.astype(np.int32))],
                ["doc_id", "size", "text_crc32", "part", "shard", "rank", "grown_shard"])

    return run


def shard_by_key(docs: DataFrame, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    doc_id and the number of shards alone decide the shard, so equal texts may
    lie apart; rows without doc_id all go to shard 0. Slots number the rows of
    a shard from 0 in the order of doc_id (nulls first), size and checksum, so
    they do not depend on how the input is split. Rows equal in all three take
    neighbouring slots. A null text has size 1 and the checksum of no bytes. An empty
    table gives an empty result.

    Rows are sorted by range, counted within each range, and each range begins
    where those before it end. The position in the input is the last sort key,
    so even rows that are all equal are dealt to many tasks.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("tie"))
    order = ["doc_id", "size", "text_crc32", "tie"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    placed = stage(spark, ranged.mapInArrow(
        _place(shards), "doc_id bigint, size bigint, text_crc32 bigint, part int, shard int, rank bigint, "
                        "grown_shard int"), "shards")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begin = placed.groupBy("shard", "part").agg(F.count("*").alias("n")).select(
        "shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    return placed.join(begin, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("begin") + F.col("rank")).alias("slot"), "grown_shard")


def _product(value: str, factor: int) -> str:
    return f"(({value})::UHUGEINT * {factor}::UHUGEINT % {2**64}::UHUGEINT)"


#: The same for a database. A key jumps once more in every round of ``jumps``, for 8 shards and for 9;
#: 0xEDB88320 is the polynomial of the checksum.
SQL = f"""
WITH RECURSIVE steps(byte, n, value) AS (
  SELECT byte, 0, byte FROM (SELECT unnest(range(256))::BIGINT AS byte)
  UNION ALL
  SELECT byte, n + 1, xor(value >> 1, (value & 1) * {0xEDB88320}) FROM steps WHERE n < 8),
checks AS (SELECT list(value ORDER BY byte) AS checks FROM steps WHERE n = 8),
texts AS MATERIALIZED (SELECT row_number() OVER () AS n, doc_id, encode(coalesce(text, '')) AS data FROM documents),
summed AS (
  SELECT n, doc_id, octet_length(data) + 1 AS size,
         xor({2**32 - 1}, list_reduce(
           list_transform(regexp_extract_all(hex(data), '..'), lambda h: ('0x' || h)::BIGINT),
           lambda sum, byte: xor(sum >> 8, checks[xor(sum & 255, byte) + 1]), {2**32 - 1}::BIGINT)) AS text_crc32
  FROM texts, checks),
first AS (SELECT n, ((doc_id::HUGEINT + {2**64} + 1) % {2**64})::UBIGINT AS x FROM texts),
second AS (SELECT n, {_product("xor(x, x >> 32)", 0x9E3779B97F4A7C15)}::UBIGINT AS x FROM first),
third AS (SELECT n, {_product("xor(x, x >> 29)", 0xC2B2AE3D27D4EB4F)}::UBIGINT AS x FROM second),
jumps(n, shards, shard, ahead, x) AS (
  SELECT n, shards, 0::BIGINT, 0::BIGINT, coalesce(xor(x, x >> 32), 0)::UBIGINT FROM third, (VALUES (8), (9)) s(shards)
  UNION ALL
  SELECT n, shards, ahead, trunc((ahead + 1) * (2147483648.0::DOUBLE / ((x >> 33) + 1)::DOUBLE))::BIGINT, x
  FROM (SELECT n, shards, ahead, (({_product("x", int(_MULTIPLIER))} + 1::UHUGEINT) % {2**64}::UHUGEINT)::UBIGINT AS x
        FROM jumps WHERE ahead < shards)),
dealt AS (
  SELECT n, max(shard) FILTER (shards = 8) AS shard, max(shard) FILTER (shards = 9) AS grown FROM jumps GROUP BY n)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law,
       CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
       CAST(grown AS INTEGER) AS grown_shard
FROM summed JOIN dealt USING (n)
"""
