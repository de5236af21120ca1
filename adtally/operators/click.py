"""Click summaries: gross clicks and unique visitors per grain and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally import grains
from adtally.functions.identity import sketch_key, visitor
from adtally.operators.rollup import SCOPE, by_scope, scope_keys, sum_of, with_days

IDS = ["ip", "ua", "gaid", "idfa", "adid"]


def project(log: DataFrame) -> DataFrame:
    """Days in both scopes, dimensions and the visitor of every click."""
    return with_days(log, "clk_timestamp").select(
        "timezone", "dated_adx", "dated_gmt", *grains.CLICK, visitor(*IDS).alias("visitor"))


def visits(projected: DataFrame) -> DataFrame:
    """Clicks per visitor at the finest grain of both scopes.

    All four click summaries follow from this frame. Worth keeping where
    visitors click often; otherwise ``daily_by_scope`` moves less data.
    """
    return projected.groupBy("timezone", "dated_adx", "dated_gmt", *grains.CLICK, "visitor").agg(
        F.count("*").alias("clicks"))


def daily(projected: DataFrame, scope: str) -> DataFrame:
    """Gross and unique count per grain.

    The distinct count makes Spark aggregate by grain and visitor before it
    aggregates by grain, so a grain holding much of the data is split by
    visitor and never lands in one task as raw rows.
    """
    out = projected.groupBy(*scope_keys(scope, grains.CLICK)).agg(
        F.count("*").alias("gross_cnt"), F.count_distinct("visitor").alias("uniq_cnt"))
    return grains.with_row_key(out, scope, grains.CLICK)


def daily_from_visits(visit_counts: DataFrame, scope: str) -> DataFrame:
    out = visit_counts.groupBy(*scope_keys(scope, grains.CLICK)).agg(
        sum_of("clicks", "gross_cnt"), F.count_distinct("visitor").alias("uniq_cnt"))
    return grains.with_row_key(out, scope, grains.CLICK)


def daily_two_step(log: DataFrame, scope: str) -> DataFrame:
    """Unique visitors as distinct id tuples.

    ``daily`` compares the ids put together, where "ab" + "c" equals
    "a" + "bc"; here they stay apart.
    """
    keys = grains.keys(scope, grains.CLICK)
    per_visitor = with_days(log, "clk_timestamp").groupBy(*scope_keys(scope, grains.CLICK), *IDS).agg(
        F.count("*").alias("clicks"))
    out = per_visitor.groupBy(*keys).agg(sum_of("clicks", "gross_cnt"), F.count("*").alias("uniq_cnt"))
    return grains.with_row_key(out, scope, grains.CLICK)


def summary(fine: DataFrame, scope: str) -> DataFrame:
    """Coarse summary. Unique counts of the fine grains are added up on purpose."""
    out = fine.groupBy(*grains.keys(scope, grains.SUMMARY)).agg(
        sum_of("gross_cnt", "gross_clk_cnt"), sum_of("uniq_cnt", "uniq_clk_cnt"))
    return grains.with_row_key(out, scope, grains.SUMMARY)


def approx_daily(projected: DataFrame, scope: str, log2_registers: int = 12) -> DataFrame:
    """``daily`` with a mergeable sketch in place of the exact distinct count."""
    out = projected.groupBy(*scope_keys(scope, grains.CLICK)).agg(
        F.count("*").alias("gross_cnt"),
        F.hll_sketch_agg(sketch_key("visitor"), F.lit(log2_registers)).alias("visitors"))
    return out.withColumn("uniq_cnt", F.hll_sketch_estimate("visitors"))


def merge_sketches(sketched: DataFrame, keys: list[str]) -> DataFrame:
    """Unique counts of a coarser grain from the sketches of a finer one."""
    return sketched.groupBy(*keys).agg(
        sum_of("gross_cnt"),
        F.hll_sketch_estimate(F.hll_union_agg("visitors")).alias("uniq_cnt"))


def counts_by_scope(log: DataFrame) -> DataFrame:
    """Gross clicks of both scopes in one pass."""
    return by_scope(log, "clk_timestamp").groupBy(*SCOPE, *grains.CLICK).agg(F.count("*").alias("gross_cnt"))


def daily_by_scope(log: DataFrame, by_tuple: bool = False) -> DataFrame:
    """Gross and unique count of both scopes in one pass over the log."""
    who = F.struct(*IDS) if by_tuple else visitor(*IDS)
    rows = by_scope(log.withColumn("visitor", who), "clk_timestamp")
    return rows.groupBy(*SCOPE, *grains.CLICK).agg(
        F.count("*").alias("gross_cnt"), F.count_distinct("visitor").alias("uniq_cnt"))
