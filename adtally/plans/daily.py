"""Daily jobs.

Each job reads its log once for all wanted days, keeps the fine counts as a
staged table and writes every summary from that. Running a day again replaces
what the earlier run wrote.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adtally import grains, schemas
from adtally.functions import time as tm
from adtally.operators import click, conversion, demand, event, impression, merge
from adtally.operators.rollup import of_scope
from adtally.session import stage
from adtally.sinks import files, tables
from adtally.sources import logs

Days = list[dt.date]


def _publish(df: DataFrame, out: str, name: str, days: Days | None) -> None:
    tables.replace_days(tables.to_layout(df, schemas.SUMMARY_TABLES[name]), f"{out}/{name}", days)


def _publish_part(df: DataFrame, out: str, name: str, days: Days) -> None:
    tables.replace_days(df, f"{out}/{name}", days)


def with_quarantine(spark: SparkSession, job: Callable, log: DataFrame, out: str, days: Days, name: str, **options) -> None:
    """Run a job over ``logs.day_files`` and keep the lines that do not fit beside its tables, by file day.

    Such lines are counted while the job reads the log; only if there are any
    the log is read for them.
    """
    if logs.CORRUPT not in log.columns:
        job(spark, log, out, days, **options)
        return
    lines = Observation(f"lines of {name}")
    job(spark, logs.watch_bad_lines(log, lines), out, days, **options)
    bad = logs.bad_lines(log).withColumnRenamed("file_day", "dated")
    if not lines.get["bad"]:
        bad = bad.limit(0)
    window = sorted({d + dt.timedelta(days=k) for d in days for k in (-1, 0, 1)})
    tables.replace_days(bad, f"{out}/{name}_malformed", window)


def clicks(spark: SparkSession, log: DataFrame, out: str, days: Days, by_tuple: bool = False) -> None:
    """``by_tuple`` counts visitors as distinct id tuples, not as ids put together."""
    near = logs.filled(logs.near_days(log, days, "clk_timestamp"), schemas.CLICK)
    fine = stage(spark, logs.on_days(click.daily_by_scope(near, by_tuple), days), "click-fine")
    for scope in grains.SCOPES:
        detail = of_scope(fine, scope, grains.CLICK)
        _publish(detail, out, f"{scope}_clk_daily_summary", days)
        _publish_part(click.summary(detail, scope), out, f"{scope}_daily_clicks", days)


def conversions(spark: SparkSession, log: DataFrame, out: str, days: Days) -> None:
    # The dedup window is the three files of a day, wider than the day itself.
    low, high = min(days) - dt.timedelta(days=1), max(days) + dt.timedelta(days=1)
    if "file_day" in log.columns:
        near = logs.in_file_window(log, days)
    else:
        near = log.where(tm.utc_day("conv_timestamp").between(F.lit(low), F.lit(high)))
        near = logs.near_days(near, [low, high], "conv_timestamp")
    near = logs.filled(near, schemas.CONVERSION)
    fine = stage(spark, conversion.counts_of_days(near, days), "conversion-fine")
    by_grain = conversion.over_reasons(fine, grains.CONVERSION)
    for scope in grains.SCOPES:
        detail = of_scope(by_grain, scope, grains.CONVERSION)
        _publish(detail, out, f"{scope}_conv_daily_summary", days)
        _publish_part(conversion.summary(detail, scope), out, f"{scope}_daily_conversions", days)
    invalid = of_scope(conversion.invalid_by_reason(fine), "adx", grains.INVALID_CONVERSION)
    _publish(invalid, out, "adx_invalid_conv_daily_summary", days)


def events(spark: SparkSession, log: DataFrame, out: str, days: Days) -> None:
    """Event counts replace their day. Retention and KPIs count on earlier days
    too; they are kept as one batch per event day and added up when read."""
    near = logs.filled(logs.near_days(log, days, "event_timestamp"), schemas.EVENT)
    both = stage(spark, logs.on_days(event.fine_by_scope(near), days), "event-fine")
    for scope in grains.SCOPES:
        fine = both.where(F.col("scope") == scope).withColumnRenamed("dated", "event_day")
        _publish_part(event.daily(fine, scope), out, f"{scope}_event_counts", days)
        batches = fine.withColumn(tables.BATCH, F.col("event_day"))
        tables.add_batches(event.retention(batches, scope, [tables.BATCH]), f"{out}/{scope}_event_retention", days)
        tables.add_batches(event.kpi(batches, scope, [tables.BATCH]), f"{out}/{scope}_daily_kpi", days)


def impressions(spark: SparkSession, log: DataFrame, out: str, days: Days, kind: str = "imp") -> None:
    flat = impression.flatten(logs.near_days(log, days, "request_unix"))
    both = stage(spark, logs.on_days(impression.daily_by_scope(flat, kind), days), f"impression-{kind}")
    for scope in grains.SCOPES:
        _publish_part(of_scope(both, scope, grains.IMPRESSION), out, f"{scope}_impression_{kind}", days)


def demands(spark: SparkSession, log: DataFrame, out: str, days: Days) -> None:
    flat = demand.flatten(logs.near_days(log, days, "clickts"))
    both = stage(spark, logs.on_days(demand.daily_by_scope(flat), days), "demand-fine")
    for scope in grains.SCOPES:
        _publish(of_scope(both, scope, grains.DEMAND), out, f"{scope}_demand_daily_summary", days)
    supply = demand.supply_daily(logs.on_days(flat, days, "dated_gmt"))
    _publish(supply, out, "gmt_supply_daily_summary", days)


def register(spark: SparkSession, out: str, database: str, days: Days | None = None) -> list[str]:
    """Make the tables below ``out`` known in a database, and the wanted days their partitions; their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    known = []
    for name in files.names(spark, out):
        if any(f.startswith("dated=") for f in files.names(spark, f"{out}/{name}")):
            tables.register(spark, f"{database}.{name}", f"{out}/{name}", days)
            known.append(name)
    return known


def _parts(spark: SparkSession, out: str, names: list[str], days: Days | None, database: str | None) -> list[DataFrame]:
    found = []
    for name in names:
        if database and spark.catalog.tableExists(f"{database}.{name}"):
            found.append(logs.on_days(spark.table(f"{database}.{name}"), days))
        elif files.exists(spark, f"{out}/{name}"):
            found.append(logs.on_days(spark.read.parquet(f"{out}/{name}"), days))
    return found


def wide_summaries(spark: SparkSession, out: str, days: Days | None = None, database: str | None = None) -> None:
    """Combine what the click, conversion and event jobs have written so far, tables of a database by their name."""
    for scope in grains.SCOPES:
        parts = _parts(spark, out, [f"{scope}_daily_{p}" for p in ("clicks", "conversions", "kpi")], days, database)
        if parts:
            _publish(merge.wide_summary(parts, scope), out, f"{scope}_daily_summary", days)
        parts = _parts(spark, out, [f"{scope}_event_counts", f"{scope}_event_retention"], days, database)
        if parts:
            keys = grains.keys(scope, grains.EVENT)
            both = merge.stack(parts, keys, ["gross_cnt", "uniq_cnt", *event.RETENTION], ["total_amount"])
            _publish(grains.with_row_key(both, scope, grains.EVENT), out, f"{scope}_event_daily_summary", days)
        parts = _parts(spark, out, [f"{scope}_impression_imp", f"{scope}_impression_clk"], days, database)
        if parts:
            keys = grains.keys(scope, grains.IMPRESSION)
            both = merge.stack(parts, keys, ["gross_imp_cnt", "uniq_imp_cnt", "gross_clk_cnt", "uniq_clk_cnt"])
            _publish(grains.with_row_key(both, scope, grains.IMPRESSION), out,
                     f"{scope}_impression_daily_summary", days)
