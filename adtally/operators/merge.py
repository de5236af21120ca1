"""Merging new summary rows into what is there."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally import grains, schemas
from adtally.functions.measures import money_units
from adtally.operators.rollup import money_sum, sum_of


def replace(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows win over old rows of the same key."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def increment(old: DataFrame, new: DataFrame, keys: list[str], counts: list[str],
              amounts: list[str] | None = None) -> DataFrame:
    """Measures of the same key add up."""
    return old.unionByName(new).groupBy(*keys).agg(
        *[sum_of(c) for c in counts], *[money_sum(a) for a in amounts or []])


def greatest(old: DataFrame, new: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """The larger measure of the same key stays."""
    return old.unionByName(new).groupBy(*keys).agg(*[F.max(m).alias(m) for m in measures])


def stack(parts: list[DataFrame], keys: list[str], counts: list[str], amounts: list[str] | None = None) -> DataFrame:
    """One row per key from parts that each fill only some of the measures."""
    amounts = amounts or []

    def padded(df: DataFrame) -> DataFrame:
        return df.select(
            *keys,
            *[F.col(c) if c in df.columns else F.lit(0).cast("long").alias(c) for c in counts],
            *[money_units(a if a in df.columns else F.lit(0)).alias(a) for a in amounts],
        )

    stacked = reduce(DataFrame.unionByName, [padded(p) for p in parts])
    return stacked.groupBy(*keys).agg(*[sum_of(c) for c in counts], *[money_sum(a) for a in amounts])


def wide_summary(parts: list[DataFrame], scope: str) -> DataFrame:
    """The wide summary from the click, conversion and KPI summaries."""
    out = stack(parts, grains.keys(scope, grains.SUMMARY), schemas.WIDE_COUNTS, schemas.WIDE_MONEY)
    return grains.with_row_key(out, scope, grains.SUMMARY)
