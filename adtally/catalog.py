"""Every operator as a query over the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally import grains, schemas
from adtally.functions import identity, measures, sqlnames, text
from adtally.functions import time as tm
from adtally.operators import (click, conversion, demand, event, fraud, impression, lists, merge, reconcile,
                               records)
from adtally.operators.rollup import SCOPE
from adtally.plans import audit, daily, streams
from adtally.session import configure, stage, total_bytes, work_dir
from adtally.sinks import tables
from adtally.sinks.ledger import Ledger, Merge
from adtally.sinks.reports import append_report, write_hours
from adtally.sources import logs, sample
from adtally.sources.messages import file_messages
from adtally.streaming import rollups, runner
from adtally.streaming.filters import click_watch, filtered, once_per_click, start_list_filter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered query with its days as text and its numbers as bigint or double."""
    df = QUERIES[name](configure(spark), sf_dir)
    shown = {T.DateType(): "string", T.IntegerType(): "bigint", T.FloatType(): "double"}
    casts = {f.name: F.col(f.name).cast(shown[f.dataType]) for f in df.schema.fields if f.dataType in shown}
    casts |= {f.name: F.round(f.name, 4).cast("double") for f in df.schema.fields
              if isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 10}
    return df.withColumns(casts) if casts else df


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def per_scope(fn: Callable[[SparkSession, str, str], DataFrame]) -> None:
    for scope in grains.SCOPES:
        QUERIES[f"{fn.__name__}_{scope}"] = lambda spark, sf, scope=scope: fn(spark, sf, scope)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return sample.table(spark, sf, "events")


def _clicks(spark: SparkSession, sf: str) -> DataFrame:
    return logs.filled(sample.click_log(_events(spark, sf)), schemas.CLICK)


def _conversions(spark: SparkSession, sf: str) -> DataFrame:
    return logs.filled(sample.conversion_log(_events(spark, sf)), schemas.CONVERSION)


def _event_log(spark: SparkSession, sf: str) -> DataFrame:
    return logs.filled(sample.event_log(_events(spark, sf)), schemas.EVENT_WITH_IDS)


def _unique_conversions(spark: SparkSession, sf: str) -> DataFrame:
    return conversion.project(conversion.dedup(_conversions(spark, sf)))


def _fine_events(spark: SparkSession, sf: str, scope: str) -> DataFrame:
    return event.fine(event.project(_event_log(spark, sf)), scope)


def _impressions(spark: SparkSession, sf: str) -> DataFrame:
    return sample.impression_log(_events(spark, sf))


def _demand(spark: SparkSession, sf: str) -> DataFrame:
    return sample.demand_log(*[sample.table(spark, sf, t) for t in ("lineitem", "supplier", "part")])


#: Bytes of the line items whose groups a task holds in memory; some 170,000 rows of the given tables.
DEMAND_BYTES = 2 * 1024 * 1024


def _demand_parts(spark: SparkSession, sf: str) -> int:
    return max(spark.sparkContext.defaultParallelism,
               -(-total_bytes(spark, [f"{sf}/lineitem.parquet"]) // DEMAND_BYTES))


# ------------------------------------------------------------------- clicks

@per_scope
def click_daily(spark, sf, scope):
    return click.daily(click.project(_clicks(spark, sf)), scope)


@per_scope
def click_daily_from_visits(spark, sf, scope):
    return click.daily_from_visits(click.visits(click.project(_clicks(spark, sf))), scope)


@per_scope
def click_summary(spark, sf, scope):
    return click.summary(click.daily(click.project(_clicks(spark, sf)), scope), scope)


@per_scope
def click_uniq_two_step(spark, sf, scope):
    return click.daily_two_step(_clicks(spark, sf), scope)


@query
def click_daily_by_scope(spark, sf):
    """Both scopes from one pass over the log."""
    return _zoned(click.daily_by_scope(_clicks(spark, sf)))


@query
def uniq_approx(spark, sf):
    """Sketched unique counts per campaign and day beside the exact ones.

    Sketches are built at the fine grain and merged.
    """
    projected = click.project(_clicks(spark, sf))
    sketched = click.merge_sketches(click.approx_daily(projected, "gmt"), ["dated", "campaign_id"])
    exact = projected.groupBy(F.col("dated_gmt").alias("dated"), "campaign_id").agg(
        F.count_distinct("visitor").alias("exact_uniq_cnt"))
    error = F.abs(F.col("uniq_cnt") - F.col("exact_uniq_cnt"))
    return sketched.join(exact, ["dated", "campaign_id"]).select(
        "dated", "campaign_id", "gross_cnt", "exact_uniq_cnt",
        (error <= F.greatest(F.lit(1.0), F.col("exact_uniq_cnt") * 0.049)).cast("int").alias("within_bound"))


@query
def click_daily_from_files(spark, sf):
    """The daily job's rollup over JSON files of one UTC day each, with broken lines among them."""
    base = work_dir(spark, "click_files")
    clicks = sample.click_log(_events(spark, sf))
    line = F.to_json(F.struct(*clicks.columns))
    broken = F.when(F.col("clk_timestamp") % 7 == 0, F.substring(line, 1, 30))
    (clicks.select(F.explode(F.array_compact(F.array(line, broken))).alias("value"),
                   F.date_format(tm.utc_day("clk_timestamp"), "yyyyMMdd").alias("day"))
     .write.partitionBy("day").text(base))
    first, last = clicks.agg(*[f(tm.utc_day("clk_timestamp")) for f in (F.min, F.max)]).first()
    days = tm.day_range(first - dt.timedelta(days=1), last + dt.timedelta(days=1))
    paths = logs.present(spark, logs.window_paths(f"{base}/day={{day}}", days))
    near = logs.filled(logs.near_days(logs.read_json(spark, paths, schemas.CLICK), days, "clk_timestamp"),
                       schemas.CLICK)
    return _zoned(logs.on_days(click.daily_by_scope(near), days))


def _write_lines(log: DataFrame, base: str, day, line=None) -> None:
    """A log as text files, a folder for each ``yyyyMMdd``."""
    line = F.to_json(F.struct(*log.columns)) if line is None else line
    log.select(line.alias("value"), F.date_format(day, "yyyyMMdd").alias("day")).write.partitionBy("day").text(base)


def _days_of(log: DataFrame, epoch: str, around: int) -> list[dt.date]:
    first, last = log.agg(*[f(tm.utc_day(epoch)) for f in (F.min, F.max)]).first()
    return tm.day_range(first - dt.timedelta(days=around), last + dt.timedelta(days=around))


@query
def conv_daily_from_files(spark, sf):
    """Conversions by the three files around each day; some lines lie in the file of a later day.

    A click counts once within the files of a day, and a line two files late
    is beyond them.
    """
    base = work_dir(spark, "conversion_files")
    log = sample.conversion_log(_events(spark, sf))
    at = F.col("conv_timestamp")
    late = F.when(at % 9 == 0, 1).when(at % 31 == 0, 2).otherwise(0)
    _write_lines(log, base, F.date_add(tm.utc_day("conv_timestamp"), late))
    days = _days_of(log, "conv_timestamp", 1)
    files = logs.in_file_window(logs.day_files(spark, f"{base}/day={{day}}", days, schemas.CONVERSION), days)
    counts = conversion.counts_of_days(logs.filled(files, schemas.CONVERSION), days)
    return _zoned(conversion.over_reasons(counts, grains.CONVERSION))


@query
def daily_quarantine(spark, sf):
    """Lines that the click job kept aside and records it counted, by file day.

    Some lines are cut off, some hold text in place of a number. The job runs
    twice; the second run replaces what the first kept.
    """
    base = work_dir(spark, "quarantine")
    log = sample.click_log(_events(spark, sf))
    line = F.to_json(F.struct(*log.columns))
    at = F.col("clk_timestamp")
    broken = F.when(at % 7 == 0, F.substring(line, 1, 30)).when(
        at % 11 == 0, F.regexp_replace(line, '"algorithm":', '"algorithm":"x","other":')).otherwise(line)
    _write_lines(log, f"{base}/files", tm.utc_day("clk_timestamp"), broken)
    days = _days_of(log, "clk_timestamp", 1)
    for _ in range(2):
        files = logs.day_files(spark, f"{base}/files/day={{day}}", days, schemas.CLICK, keep_bad=True)
        daily.with_quarantine(spark, daily.clicks, files, f"{base}/out", days, "click")
    bad = spark.read.parquet(f"{base}/out/click_malformed").groupBy("dated").agg(
        F.count("*").alias("bad_cnt"), F.count("record.clk_timestamp").alias("dated_bad_cnt"))
    counted = spark.read.parquet(f"{base}/out/gmt_clk_daily_summary").groupBy("dated").agg(
        F.sum("gross_cnt").alias("counted_cnt"))
    return counted.join(bad, "dated", "full").select(
        "dated", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("counted_cnt", "bad_cnt", "dated_bad_cnt")])


@query
def uniq_reach(spark, sf):
    """Visitors of an affiliate over all days, exact and as the daily sketches estimate them."""
    projected = click.project(_clicks(spark, sf))
    sketched = click.merge_sketches(click.approx_daily(projected, "gmt"), ["aff_id"])
    exact = projected.groupBy("aff_id").agg(F.count_distinct("visitor").alias("exact_uniq_cnt"))
    return sketched.join(exact, "aff_id").select("aff_id", "gross_cnt", "exact_uniq_cnt", "uniq_cnt")


@query
def uniq_reach_bound(spark, sf):
    """``uniq_reach`` with the estimate held against three standard errors of its sketch."""
    error = F.abs(F.col("uniq_cnt") - F.col("exact_uniq_cnt"))
    return uniq_reach(spark, sf).select(
        "aff_id", "gross_cnt", "exact_uniq_cnt",
        (error <= F.greatest(F.lit(1.0), F.col("exact_uniq_cnt") * 0.049)).cast("int").alias("within_bound"))


@query
def local_day_three_file_window(spark, sf):
    """Which UTC file day the records of each local day lie in."""
    days = _clicks(spark, sf).select(
        "timezone", tm.local_day("clk_timestamp", "timezone").alias("dated"),
        tm.utc_day("clk_timestamp").alias("file_day"))
    apart = F.date_diff("file_day", "dated")
    return days.groupBy("timezone", "dated").agg(
        F.count("*").alias("gross_cnt"),
        F.count_if(apart == -1).alias("day_before_cnt"),
        F.count_if(apart == 0).alias("same_day_cnt"),
        F.count_if(apart == 1).alias("day_after_cnt"))


@query
def group_list_filter(spark, sf):
    listed = sample.group_list(sample.table(spark, sf, "supplier"))
    kept = lists.keep_listed(_clicks(spark, sf), listed)
    return kept.select("group_id", "clk_timestamp", "campaign_id", "ip", "ua")


# -------------------------------------------------------------- conversions

@query
def conv_dedup(spark, sf):
    return conversion.dedup(_conversions(spark, sf))


@per_scope
def conv_once_counts(spark, sf, scope):
    return conversion.daily_once_per_click(_conversions(spark, sf), scope)


@per_scope
def conv_daily(spark, sf, scope):
    return conversion.daily(_unique_conversions(spark, sf), scope)


@query
def conv_invalid_adx(spark, sf):
    return conversion.invalid_daily(_unique_conversions(spark, sf), "adx")


@per_scope
def conv_summary(spark, sf, scope):
    return conversion.summary(conversion.daily(_unique_conversions(spark, sf), scope), scope)


@query
def conv_daily_by_scope(spark, sf):
    counts = conversion.counts_by_reason(conversion.dedup(_conversions(spark, sf)))
    return _zoned(conversion.over_reasons(counts, grains.CONVERSION))


@query
def click_result_records(spark, sf):
    return records.scoped_records(click.counts_by_scope(_clicks(spark, sf)), grains.CLICK, ["gross_cnt"], tag="click")


@query
def conv_result_records(spark, sf):
    return records.conversion_records(conversion.counts_by_reason(_conversions(spark, sf)))


@query
def click_unique_result_records(spark, sf):
    return records.scoped_records(click.daily_by_scope(_clicks(spark, sf)), grains.CLICK, ["gross_cnt", "uniq_cnt"])


@query
def impression_result_records(spark, sf):
    return streams.RECORDS["impression"](rollups.impressions(_impressions(spark, sf)))


@query
def demand_unique_result_records(spark, sf):
    topic = F.when(F.col("demand") == "R", F.lit("x_imps")).otherwise(F.lit("x_clks"))
    totals = rollups.demand_totals(_demand(spark, sf).withColumn("topic", topic), _demand_parts(spark, sf))
    return streams.RECORDS["demand"](rollups.MERGES["demand"].totals(totals))


@query
def demand_result_records(spark, sf):
    topic = F.when(F.col("demand") == "R", F.lit("x_imps")).otherwise(F.lit("x_clks"))
    return records.scoped_records(
        records.supply_growth(rollups.supply(_demand(spark, sf).withColumn("topic", topic))), grains.SUPPLY,
        records.SUPPLY_MEASURES, lead="kind")


@query
def conv_detail_records(spark, sf):
    return records.conversion_detail(sample.conversion_log(_events(spark, sf)))


# ------------------------------------------------------------------- events

@per_scope
def event_pvuv(spark, sf, scope):
    return event.daily(_fine_events(spark, sf, scope), scope)


@per_scope
def event_retention(spark, sf, scope):
    return event.retention(_fine_events(spark, sf, scope), scope)


@per_scope
def event_kpi(spark, sf, scope):
    return event.kpi(_fine_events(spark, sf, scope), scope)


@per_scope
def event_kpi_extended(spark, sf, scope):
    return event.kpi_extended(_fine_events(spark, sf, scope), scope)


@per_scope
def event_records(spark, sf, scope):
    return records.event_records(_fine_events(spark, sf, scope), scope)


@query
def event_fine_by_scope(spark, sf):
    return _zoned(event.fine_by_scope(_event_log(spark, sf)))


# ------------------------------------------------- impressions, demand, supply

@query
def impression_daily_by_scope(spark, sf):
    return _zoned(impression.daily_by_scope(impression.flatten(_impressions(spark, sf))))


@query
def demand_daily_by_scope(spark, sf):
    return _zoned(demand.daily_by_scope(demand.flatten(_demand(spark, sf)), _demand_parts(spark, sf)))


@per_scope
def impression_daily(spark, sf, scope):
    return impression.daily(impression.flatten(_impressions(spark, sf)), scope)


@per_scope
def impression_click_daily(spark, sf, scope):
    return impression.daily(impression.flatten(_impressions(spark, sf)), scope, kind="clk")


@per_scope
def demand_daily(spark, sf, scope):
    return demand.daily(demand.flatten(_demand(spark, sf)), scope, _demand_parts(spark, sf))


@query
def supply_daily_gmt(spark, sf):
    return demand.supply_daily(demand.flatten(_demand(spark, sf)))


# ------------------------------------------------------- merging and checking

def _summaries(spark, sf, scope):
    return [
        click.summary(click.daily(click.project(_clicks(spark, sf)), scope), scope),
        conversion.summary(conversion.daily(_unique_conversions(spark, sf), scope), scope),
        event.kpi(_fine_events(spark, sf, scope), scope),
    ]


@per_scope
def wide_daily_summary(spark, sf, scope):
    return merge.wide_summary(_summaries(spark, sf, scope), scope)


KEYS = grains.keys("gmt", grains.SUMMARY)


def _two_runs(spark, sf):
    """A summary as written from half of the hours, and the full one."""
    projected = _clicks(spark, sf)
    early = projected.where(F.pmod(tm.hour_index("clk_timestamp"), F.lit(24)) < 12)

    def total(log):
        return click.summary(click.daily(click.project(log), "gmt"), "gmt").drop("unionk")

    return total(early), total(projected)


@query
def upsert_replace(spark, sf):
    """Keys of the first half of a day stay where the second half has none."""
    projected = _clicks(spark, sf)
    early = F.pmod(tm.hour_index("clk_timestamp"), F.lit(24)) < 12
    old, new = (click.summary(click.daily(click.project(projected.where(part)), "gmt"), "gmt").drop("unionk")
                for part in (early, ~early))
    return merge.replace(old, new, KEYS)


@query
def upsert_increment(spark, sf):
    old, new = _two_runs(spark, sf)
    return merge.increment(old, new, KEYS, ["gross_clk_cnt", "uniq_clk_cnt"])


@query
def upsert_greatest(spark, sf):
    old, new = _two_runs(spark, sf)
    return merge.greatest(old, new, KEYS, ["gross_clk_cnt", "uniq_clk_cnt"])


@query
def rerun_replaces_days(spark, sf):
    """A run at noon, then the full run twice, each written over the days before."""
    path = work_dir(spark, "rerun")
    for part in (0, 1, 1):
        rows = _two_runs(spark, sf)[part]
        tables.replace_days(grains.with_row_key(rows, "gmt", grains.SUMMARY), path)
    return spark.read.parquet(path).drop("unionk")


@query
def registered_rerun(spark, sf):
    """A table by its name: after a run at noon, the full run, and the removal of its last day."""
    base, name = work_dir(spark, "registered"), f"clicks_{uuid.uuid4().hex}"
    log = sample.click_log(_events(spark, sf))
    days = _days_of(log, "clk_timestamp", 1)
    for part in (F.pmod(tm.hour_index("clk_timestamp"), F.lit(24)) < 12, F.lit(True)):
        daily.clicks(spark, log.where(part), base, days)
        tables.register(spark, name, f"{base}/gmt_daily_clicks", days)
    tables.drop_days(spark, name, [max(days) - dt.timedelta(days=1)])
    return spark.table(name).drop("unionk")


@query
def replayed_batch_adds_once(spark, sf):
    """Two batches of increments, the second one delivered twice."""
    path = work_dir(spark, "replay")
    for batch_id in (0, 1, 1):
        tables.add_batch(_two_runs(spark, sf)[batch_id], path, batch_id)
    return tables.read_increments(spark, path, KEYS, ["gross_clk_cnt", "uniq_clk_cnt"])


@per_scope
def reconcile_click(spark, sf, scope):
    detail = click.daily(click.project(_clicks(spark, sf)), scope)
    return reconcile.check(detail, wide_frame(spark, sf, scope), reconcile.CLICK, scope)


def wide_frame(spark, sf, scope):
    """The wide summary as a stored table, damaged on every seventh day of the month."""
    wide = stage(spark, merge.wide_summary(_summaries(spark, sf, scope), scope), f"wide-{scope}")
    wrong = (F.day("dated") % 7 == 0).cast("int")
    return wide.withColumns({c: F.col(c) + wrong for c in ("gross_clk_cnt", "valid_conv_cnt", "kpi_event_cnt")})


@per_scope
def reconcile_conv(spark, sf, scope):
    detail = conversion.daily(_unique_conversions(spark, sf), scope)
    return reconcile.check(detail, wide_frame(spark, sf, scope), reconcile.CONVERSION, scope)


@query
def reconcile_click_missing_days(spark, sf):
    """KPI rows put install days into the wide summary that have no click at all."""
    detail = click.daily(click.project(_clicks(spark, sf)), "gmt")
    return reconcile.check(detail, wide_frame(spark, sf, "gmt"), reconcile.CLICK, "gmt", missing_days=True)


@per_scope
def reconcile_event(spark, sf, scope):
    detail = event.kpi(_fine_events(spark, sf, scope), scope)
    return reconcile.check(detail, wide_frame(spark, sf, scope), reconcile.KPI, scope)


# -------------------------------------------------------------------- fraud

HOT = 5


@query
def fraud_hourly_click_ip(spark, sf):
    return fraud.hourly_counts(_clicks(spark, sf), ["ip"], more_than=HOT)


@query
def fraud_hourly_click_adid(spark, sf):
    return fraud.hourly_counts(_clicks(spark, sf), ["gaid", "idfa"], more_than=HOT)


@query
def fraud_hourly_click_aff(spark, sf):
    return fraud.hourly_counts(_clicks(spark, sf), ["aff_id", "aff_pub"], more_than=HOT)


def _event_records(spark, sf):
    return _event_log(spark, sf).withColumnRenamed("event_timestamp", "clk_timestamp")


@query
def fraud_hourly_event_ip(spark, sf):
    return fraud.hourly_counts(_event_records(spark, sf), ["ip", "event_value"])


@query
def fraud_hourly_event_adid(spark, sf):
    return fraud.hourly_counts(_event_records(spark, sf), ["gaid", "idfa", "event_value"])


@query
def fraud_hourly_event_aff(spark, sf):
    return fraud.hourly_counts(_event_records(spark, sf), ["aff_id", "aff_pub", "event_value"])


@query
def fraud_hourly_click_kinds(spark, sf):
    return fraud.hourly_counts_by_kind(_clicks(spark, sf)).where(F.col("cnt") > HOT)


@query
def fraud_reports_csv(spark, sf):
    """The fraud job's files of click hot spots, read back."""
    base = work_dir(spark, "fraud_reports")
    clicks = sample.click_log(_events(spark, sf))
    audit.hourly_fraud(spark, clicks, sample.event_log(_events(spark, sf)).withColumnRenamed(
        "event_timestamp", "clk_timestamp"), base, HOT)
    found = None
    for kind, names in fraud.HOT_KEYS.items():
        layout = ", ".join(f"{c} string" for c in ("hour", "key_1", "key_2")[:len(names) + 1]) + ", cnt bigint"
        rows = spark.read.schema(layout).option("emptyValue", "").csv(f"{base}/click_analysis_{kind}")
        rows = rows.withColumn("key_2", F.col("key_2") if len(names) > 1 else F.lit(""))
        rows = rows.select("hour", F.lit(kind).alias("kind"), *[F.coalesce(k, F.lit("")).alias(k) for k in ("key_1", "key_2")], "cnt")
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def reconcile_report(spark, sf):
    """Lines of the report that a check adds to, for both scopes."""
    path = work_dir(spark, "report")
    for scope in grains.SCOPES:
        append_report(QUERIES[f"reconcile_click_{scope}"](spark, sf), path, f"{scope}_click")
    return spark.read.text(path)


@query
def fraud_hourly_event_kinds(spark, sf):
    return fraud.hourly_counts_by_kind(_event_records(spark, sf), ["event_value"])


@query
def fraud_hourly_click_files(spark, sf):
    """Hot spots by the hour folders of some days in which clicks were written, now and then an hour late."""
    base = work_dir(spark, "hour_files")
    log = sample.click_log(_events(spark, sf))
    filed = tm.utc_hour(F.col("clk_timestamp") + F.when(F.col("clk_timestamp") % 5 == 0, 3600).otherwise(0))
    log.select(F.to_json(F.struct(*log.columns)).alias("value"), filed.alias("hour")).write.partitionBy("hour").text(base)
    days = _days_of(log, "clk_timestamp", 0)[1:]
    files = logs.filled(logs.hour_folders(spark, base, days, schemas.CLICK), schemas.CLICK)
    return fraud.hourly_counts_by_kind(files).where(F.col("cnt") > HOT)


@query
def fraud_ip_profile(spark, sf):
    return fraud.ip_profile(_conversions(spark, sf))


@query
def fraud_ip_click_times(spark, sf):
    return fraud.repeated_click_times(_conversions(spark, sf))


@query
def fraud_click_radius(spark, sf):
    return fraud.clicks_around_invalid(_conversions(spark, sf), _clicks(spark, sf))


@query
def fraud_sliding_window(spark, sf):
    return click_watch(_clicks(spark, sf))


# ------------------------------------------------------------------ scalars

@query
def scalar_helpers(spark, sf):
    """The small functions over every click."""
    c = _clicks(spark, sf)
    conv = F.col("clk_timestamp") + 40 * 3600
    return c.select(
        "clk_timestamp", "timezone", "ip", "ua", "gaid", "idfa",
        tm.utc_hour("clk_timestamp").alias("hour"),
        text.text_mod("ip", 7).alias("ip_mod"), text.int_mod("clk_timestamp", 10).alias("ts_mod"),
        text.lacks("gaid", "{").cast("int").alias("plain_gaid"),
        text.blank_to_empty(F.when(F.col("gaid") == "{gaid}", "NULL").otherwise(F.col("gaid"))).alias("gaid_text"),
        text.last_or_zero(F.split("ip", r"\.")).alias("ip_last"),
        text.first_as_int(F.split("ip", r"\.")).alias("ip_first"),
        identity.first_filled("gaid", "idfa").alias("any_id"),
        identity.advertising_id("gaid", "idfa").alias("ad_id"),
        identity.device_key(["gaid"], ["ip", "ua"]).alias("device"),
        measures.retained_within(conv, "clk_timestamp", 1).alias("in1"),
        measures.retained_within(conv, "clk_timestamp", 2).alias("in2"),
        measures.retention_days("clk_timestamp", conv).alias("days_before"),
        tm.parse_timestamp(F.concat(tm.utc_day("clk_timestamp").cast("string"), F.lit(" 01:02:03"))).alias("parsed"),
        tm.zone_name("timezone").alias("zone"),
        tm.millis_left_in_day(F.col("clk_timestamp") * 1000, "timezone").alias("millis_left"),
        tm.seconds_left_in_day("clk_timestamp", "timezone").alias("seconds_left"),
    )


@query
def sql_functions(spark, sf):
    """The helpers by their SQL names over every click."""
    sqlnames.register(spark)
    return _clicks(spark, sf).selectExpr(
        "getFormatDate(clk_timestamp + timezone * 3600) AS local_day", "getFormatDateToHour(clk_timestamp) AS hour",
        "uvGenerator(ip, ua, gaid, idfa, adid) AS visitor",
        "retentDays(CAST(clk_timestamp AS INT), CAST(clk_timestamp + 200000 AS INT)) AS days",
        "getLast(split(ip, '[.]')) AS ip_last", "domainSelect(gaid, idfa) AS domain",
        "getMod(CAST(clk_timestamp % 1000 AS INT), 7) AS modulus",
        "CAST(hasNotChar(gaid, '{') AS INT) AS plain_gaid")


@query
def malformed_quarantine(spark, sf):
    """Good and bad lines of a log in which signups lost their closing brace and purchases hold text for a number."""
    events = _events(spark, sf)
    line = F.to_json(F.struct("event_id", "user_id", "event_type"))
    broken = F.when(F.col("event_type") == "signup", F.concat(F.lit("{\"event_id\": oops"), line)).when(
        F.col("event_type") == "purchase", F.regexp_replace(line, '"user_id":', '"user_id":"x","other":')
    ).otherwise(line)
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, event_type string")
    parsed = logs.parse_messages(events.select(broken.alias("value")), schema)
    return parsed.groupBy("malformed", "event_type").agg(F.count("*").alias("cnt")).select(
        F.col("malformed").cast("int").alias("malformed"), F.coalesce("event_type", F.lit("")).alias("event_type"),
        "cnt")


# ------------------------------------------------------------------ streams

#: Micro-batches of the streams.
PARTS = 4


def _deliver(rows: DataFrame, path: str, files: int, key: str) -> None:
    """More files in a folder that a stream reads."""
    rows.repartition(files, key).write.mode("append").parquet(path)


def _staged_stream(spark, sf, name, schema, key) -> DataFrame:
    """Columns of a table as a stream of files, as many in each of ``PARTS`` micro-batches as there are cores."""
    path, files = work_dir(spark, f"{name}-files"), spark.sparkContext.defaultParallelism
    rows, named = sample.table(spark, sf, name), T.StructType.fromDDL(schema).names
    _deliver(rows.select(*[c for c in rows.columns if c in named]), path, PARTS * files, key)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def _event_stream(spark, sf):
    return _staged_stream(spark, sf, "events", sample.EVENTS_SCHEMA, "event_id")


def _parsed(log: DataFrame, schema: T.StructType, topic=None, keep_missing=(), typed_first=False) -> DataFrame:
    """Through JSON messages and back, as a stream consumer sees the log."""
    messages = sample.as_messages(log, topic)
    keep = ["topic"] if topic is not None else None
    return logs.good(logs.parse_messages(messages, schema, keep=keep, typed_first=typed_first), schema, keep_missing)


def _streamed(spark, job, log, name, mode="append") -> Ledger:
    """The table of a job after it has read all there is."""
    base = work_dir(spark, name)
    ledger = streams.table(job, f"{base}/table")
    streams.begin(job, log, ledger, f"{base}/checkpoint", runner.WHAT_IS_THERE, mode=mode).awaitTermination()
    return ledger


def _zoned(df: DataFrame) -> DataFrame:
    return df.withColumn("timezone", F.coalesce("timezone", F.lit(0.0)))


@query
def stream_click(spark, sf):
    log = _parsed(sample.click_log(_event_stream(spark, sf)), schemas.CLICK)
    return _zoned(_streamed(spark, "click", log, "stream_click").totals(spark))


class _Lost(Exception):
    """Stands for whatever may end a job after it has written."""


@query
def stream_click_restarted(spark, sf):
    """Stopped after two batches, started again over four, ended by an error behind a write, started once more."""
    base = work_dir(spark, "stream_click_restarted")
    ledger, files = streams.table("click", f"{base}/table", every=2), spark.sparkContext.defaultParallelism
    parts = sample.table(spark, sf, "events").withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(PARTS)))
    for first in (True, False):
        some = parts.where(F.col("part") < 2 if first else F.col("part") >= 2)
        _deliver(some.drop("part"), f"{base}/files", PARTS // 2 * files, "event_id")
        for fails in (False,) if first else (True, False):
            source = spark.readStream.schema(sample.EVENTS_SCHEMA).option(
                "maxFilesPerTrigger", files).parquet(f"{base}/files")
            log = _parsed(sample.click_log(source), schemas.CLICK)

            def emit(grown, batch_id, fails=fails):
                if fails and batch_id >= 2:
                    raise _Lost

            job = runner.start_table(log, rollups.clicks, ledger, f"{base}/checkpoint", runner.WHAT_IS_THERE, emit)
            try:
                job.awaitTermination()
            except StreamingQueryException:
                if not fails:
                    raise
    return _zoned(ledger.totals(spark))


@query
def stream_click_uniq(spark, sf):
    log = _parsed(sample.click_log(_event_stream(spark, sf)), schemas.CLICK)
    return _zoned(_streamed(spark, "click-unique", log, "stream_click_uniq").totals(spark))


def _conversion_increments(spark, sf):
    log = _parsed(sample.conversion_log(_event_stream(spark, sf)), schemas.CONVERSION)
    return _streamed(spark, "conversion", log, "stream_conv").totals(spark)


@query
def stream_conv(spark, sf):
    return _zoned(conversion.over_reasons(_conversion_increments(spark, sf), grains.CONVERSION))


@query
def stream_conv_once(spark, sf):
    """Every conversion is delivered twice, in different micro-batches; each click id counts once."""
    base, files = work_dir(spark, "stream_conv_once"), spark.sparkContext.defaultParallelism
    for _ in range(2):
        _deliver(_events(spark, sf), f"{base}/files", files, "event_id")
    source = spark.readStream.schema(sample.EVENTS_SCHEMA).option("maxFilesPerTrigger", files).parquet(f"{base}/files")
    log = _parsed(sample.conversion_log(source), schemas.CONVERSION)
    ledger = Ledger(f"{base}/table", Merge(["click_id"], ["gross_cnt"]))
    runner.start_table(once_per_click(log, "400 days"), lambda batch: batch.groupBy("click_id").agg(
        F.count("*").alias("gross_cnt")), ledger, f"{base}/checkpoint", runner.WHAT_IS_THERE).awaitTermination()
    return ledger.totals(spark)


@query
def stream_list_filter(spark, sf):
    """Clicks of even and of odd seconds in two micro-batches; in between the list of groups changes."""
    base = work_dir(spark, "stream_list_filter")
    messages = sample.as_messages(sample.click_log(_events(spark, sf)), F.col("clk_timestamp") % 2)
    even = sample.group_list(sample.table(spark, sf, "supplier"))
    for part, listed in enumerate((even, even.select((F.col("group_id") + 1).cast("bigint").cast("string")))):
        listed.write.mode("overwrite").text(f"{base}/list")
        messages.where(F.col("topic") == part).select("value").coalesce(1).write.mode("append").text(f"{base}/in")
        start_list_filter(file_messages(spark, f"{base}/in"), f"{base}/list", f"{base}/table", f"{base}/checkpoint",
                          runner.WHAT_IS_THERE, max_age=0).awaitTermination()
    kept = filtered(f"{base}/table").rows(spark)
    write_hours(kept, f"{base}/hours")
    group = F.get_json_object("value", "$.group_id").cast("bigint")
    return spark.read.text(f"{base}/hours").groupBy(group.alias("group_id")).agg(F.count("*").alias("cnt"))


@query
def stream_conv_summary(spark, sf):
    return _zoned(conversion.over_reasons(_conversion_increments(spark, sf), grains.SUMMARY))


@query
def stream_conv_invalid(spark, sf):
    return conversion.invalid_by_reason(_conversion_increments(spark, sf))


@query
def stream_event(spark, sf):
    log = _parsed(sample.event_log(_event_stream(spark, sf)), schemas.EVENT)
    return _zoned(_streamed(spark, "event", log, "stream_event").totals(spark))


def _event_id_totals(spark, sf, name):
    log = _parsed(sample.event_log(_event_stream(spark, sf)), schemas.EVENT_WITH_IDS)
    return rollups.with_latest_code(_streamed(spark, "event-ids", log, name).totals(spark))


@query
def event_id_result_records(spark, sf):
    """Messages of the earlier event form, all counted as one batch."""
    sent = records.event_id_records(_event_id_totals(spark, sf, "event_id_result_records"))
    return sent.groupBy("value").agg(F.count("*").alias("cnt"))


@query
def stream_event_old(spark, sf):
    out = rollups.event_id_records(_event_id_totals(spark, sf, "stream_event_old")).groupBy(*SCOPE, *grains.EVENT).agg(
        *[F.sum(c).alias(c) for c in ("gross_cnt", "uniq_cnt", "kpi_event_cnt", *event.RETENTION)],
        measures.money(F.sum(measures.money_units("total_amount"))).alias("total_amount"))
    return _zoned(out)


def _impression_stream(spark, sf, kind):
    log = _parsed(sample.impression_log(_event_stream(spark, sf)), schemas.IMPRESSION)
    job = "impression" if kind == "imp" else "impression-click"
    return _zoned(_streamed(spark, job, log, f"stream_{job}").totals(spark))


@query
def stream_impression(spark, sf):
    return _impression_stream(spark, sf, "imp")


@query
def stream_imp_click(spark, sf):
    return _impression_stream(spark, sf, "clk")


def _demand_stream(spark, sf):
    lines = _staged_stream(spark, sf, "lineitem", sample.LINEITEM_SCHEMA, "l_orderkey")
    log = sample.demand_log(lines, sample.table(spark, sf, "supplier"), sample.table(spark, sf, "part"))
    topic = F.when(F.col("demand") == "R", F.lit("x_imps")).otherwise(F.lit("x_clks"))
    return _parsed(log, schemas.DEMAND, topic, typed_first=True)


@query
def stream_demand(spark, sf):
    return _zoned(_streamed(spark, "demand", _demand_stream(spark, sf), "stream_demand").totals(spark))


@query
def stream_growth(spark, sf):
    """What the micro-batches of a stream of unique clicks publish, added up.

    The third batch is delivered twice: the job ends after it has published,
    and starts again from its checkpoint. A consumer keeps one delivery.
    """
    base = work_dir(spark, "stream_growth")
    ledger = streams.table("click-unique", f"{base}/table", every=2)
    log = _parsed(sample.click_log(_event_stream(spark, sf)), schemas.CLICK)
    for delivered in (1, 2):
        def publish(grown, batch_id, delivered=delivered):
            grown.write.mode("overwrite").parquet(f"{base}/published/batch={batch_id}")
            if batch_id == 2 and delivered == 1:
                raise _Lost

        job = runner.start_table(log, rollups.click_totals, ledger, f"{base}/checkpoint", runner.WHAT_IS_THERE, publish)
        try:
            job.awaitTermination()
        except StreamingQueryException:
            if delivered == 2:
                raise
    return spark.read.parquet(f"{base}/published").where("scope = 'gmt'").groupBy(
        *grains.keys("gmt", grains.CLICK)).agg(*[F.sum(c).alias(c) for c in ("gross_cnt", "uniq_cnt")])


@query
def stream_supply(spark, sf):
    return _streamed(spark, "supply", _demand_stream(spark, sf), "stream_supply").totals(spark)


@query
def stream_conv_detail(spark, sf):
    log = _parsed(sample.conversion_log(_event_stream(spark, sf)), schemas.CONVERSION,
                  keep_missing=streams.MAY_BE_MISSING["conversion-detail"])
    detail = _streamed(spark, "conversion-detail", log, "stream_conv_detail").rows(spark)
    return detail.groupBy("value").agg(F.count("*").alias("cnt"))


@query
def stream_sliding_window(spark, sf):
    """The sliding window as a stream; equals ``fraud_sliding_window``."""
    source = sample.table_stream(spark, sf, "events", sample.EVENTS_SCHEMA)  # by time, as in the table
    log = _parsed(sample.click_log(source), schemas.CLICK)
    return _streamed(spark, "click-watch", click_watch(log), "stream_sliding_window", "update").totals(spark)
