"""Conversion summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally import grains
from adtally.functions import time as tm
from adtally.functions.measures import money, money_units
from adtally.operators.rollup import SCOPE, by_scope, money_sum, scope_keys, sum_of, with_days


def is_valid() -> Column:
    return F.col("invalid_type") == ""


def is_notified() -> Column:
    """1 marks a conversion the affiliate was notified of."""
    return F.col("forwarded") == 1


# The earliest record of a click wins; the remaining columns settle ties, so
# the winner never depends on the order rows arrive in.
FIRST_BY = [
    "conv_timestamp", "timezone", "campaign_id", "group_id", "aff_id", "aff_pub", "income", "income_currency",
    "payout", "payout_currency", "algorithm", "invalid_type", "forwarded", "net_profit", "tac",
]


def dedup(log: DataFrame, within: list[str] | None = None) -> DataFrame:
    """One record per ``click_id``; all blank ids together count as one.

    First the earliest second of each click: two numbers a record, so hash
    aggregation applies and the log itself is not sorted. Joined with that,
    only records of that second are left, for most clicks one; these are
    compared by all columns. The log is a filled one, without nulls.

    The join is by click and second, so a click_id that holds much of the log
    is spread over the partitions, and what does not match ends there.
    """
    keys = ["click_id", *(within or [])]
    earliest = log.groupBy(*keys).agg(F.min("conv_timestamp").alias("conv_timestamp"))
    left = log.join(earliest, [*keys, "conv_timestamp"])
    first = left.groupBy(*keys).agg(F.min(F.struct(*FIRST_BY)).alias("first"))
    return first.select(*keys, "first.*")


def per_target_day(log: DataFrame, days: list[dt.date]) -> DataFrame:
    """Every record once for each wanted day whose three-day file window holds it.

    A click_id is unique within the window of a day, so a backfill of many
    days in one pass keeps the windows apart.
    """
    file_day = F.col("file_day") if "file_day" in log.columns else tm.utc_day("conv_timestamp")
    near = F.array(*[F.date_add(file_day, k) for k in (-1, 0, 1)])
    return log.withColumn("target_day", F.explode(near)).where(F.col("target_day").isin(list(days)))


def counts_of_days(log: DataFrame, days: list[dt.date]) -> DataFrame:
    """``counts_by_reason`` of the wanted local and UTC days, a click once within the file window of each day."""
    unique = dedup(per_target_day(log, days), ["target_day"])
    return counts_by_reason(unique).where("dated = target_day").drop("target_day")


def project(records: DataFrame) -> DataFrame:
    return with_days(records, "conv_timestamp")


def daily(records: DataFrame, scope: str) -> DataFrame:
    out = records.groupBy(*scope_keys(scope, grains.CONVERSION)).agg(
        F.count("*").alias("gross_cnt"),
        F.count_if(is_valid()).alias("valid_cnt"),
        F.count_if(is_notified()).alias("notify_cnt"),
        money_sum("net_profit"),
        money_sum("tac"),
    )
    return grains.with_row_key(out, scope, grains.CONVERSION)


def invalid_daily(records: DataFrame, scope: str = "adx") -> DataFrame:
    """Invalid conversions by reason."""
    out = records.where(~is_valid()).groupBy(*scope_keys(scope, grains.INVALID_CONVERSION)).agg(
        F.count("*").alias("invalid_cnt"))
    return grains.with_row_key(out, scope, grains.INVALID_CONVERSION)


def summary(fine: DataFrame, scope: str) -> DataFrame:
    out = fine.groupBy(*grains.keys(scope, grains.SUMMARY)).agg(
        sum_of("gross_cnt", "gross_conv_cnt"),
        sum_of("valid_cnt", "valid_conv_cnt"),
        sum_of("notify_cnt", "notify_conv_cnt"),
        money_sum("net_profit"),
        money_sum("tac"),
    )
    return grains.with_row_key(out, scope, grains.SUMMARY)


def daily_once_per_click(log: DataFrame, scope: str) -> DataFrame:
    """The same measures without a prior dedup: each grain counts a click once.

    Grouping by grain and click first keeps every distinct count a plain sum
    and spreads a large grain over its clicks.
    """
    keys = grains.keys(scope, grains.CONVERSION)
    per_click = project(log).groupBy(*scope_keys(scope, grains.CONVERSION), "click_id").agg(
        F.max(is_valid().cast("int")).alias("valid"),
        F.max(is_notified().cast("int")).alias("notified"),
        F.min(F.struct("conv_timestamp", "net_profit", "tac")).alias("first"),
    )
    out = per_click.groupBy(*keys).agg(
        F.count("*").alias("gross_cnt"),
        sum_of("valid", "valid_cnt"),
        sum_of("notified", "notify_cnt"),
        money(F.sum(money_units("first.net_profit"))).alias("net_profit"),
        money(F.sum(money_units("first.tac"))).alias("tac"),
    )
    return grains.with_row_key(out, scope, grains.CONVERSION)


COUNTS = ["gross_cnt", "valid_cnt", "notify_cnt"]


def counts_by_reason(records: DataFrame) -> DataFrame:
    """Both scopes in one pass, split by reason; every conversion summary adds up from it."""
    keep = ["target_day"] if "target_day" in records.columns else []
    return by_scope(records, "conv_timestamp").groupBy(*keep, *SCOPE, *grains.CONVERSION, "invalid_type").agg(
        F.count("*").alias("gross_cnt"),
        F.count_if(is_valid()).alias("valid_cnt"),
        F.count_if(is_notified()).alias("notify_cnt"),
        money_sum("net_profit"),
        money_sum("tac"),
    )


def over_reasons(counts: DataFrame, dims: list[str]) -> DataFrame:
    return counts.groupBy(*SCOPE, *dims).agg(
        *[sum_of(c) for c in COUNTS], money_sum("net_profit"), money_sum("tac"))


def invalid_by_reason(counts: DataFrame) -> DataFrame:
    return counts.where("scope = 'adx' and invalid_type != ''").groupBy(
        *SCOPE, *grains.INVALID_CONVERSION).agg(sum_of("gross_cnt", "invalid_cnt"))
