"""Fraud reports and the check of detail against summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally import grains, schemas
from adtally.operators import fraud, reconcile
from adtally.session import stage
from adtally.sinks.reports import append_report, write_csv
from adtally.sources import logs

def hourly_fraud(spark: SparkSession, clicks: DataFrame, events: DataFrame, out: str, more_than: int = 5) -> None:
    """Hourly hot spots of clicks above a threshold, and all hourly event counts."""
    click_counts = fraud.hourly_counts_by_kind(logs.filled(clicks, schemas.CLICK_FRAUD))
    click_counts = stage(spark, click_counts.where(F.col("cnt") > more_than), "click-hours")
    event_counts = fraud.hourly_counts_by_kind(logs.filled(events, schemas.EVENT_FRAUD), ["event_value"])
    event_counts = stage(spark, event_counts, "event-hours")
    for kind, keys in fraud.HOT_KEYS.items():
        columns = ["hour", *["key_1", "key_2"][:len(keys)]]
        of_kind = F.col("kind") == kind
        write_csv(click_counts.where(of_kind).select(*columns, "cnt"), f"{out}/click_analysis_{kind}")
        write_csv(event_counts.where(of_kind).select(*columns, "event_value", "cnt"), f"{out}/event_analysis_{kind}")


def conversion_fraud(spark: SparkSession, conversions: DataFrame, clicks: DataFrame, out: str,
                     radius_minutes: int = 10) -> None:
    conversions = logs.filled(conversions, schemas.CONVERSION_FRAUD).select("ip", "invalid_type", "clk_timestamp")
    conversions = stage(spark, conversions, "invalid-conversions")
    clicks = logs.filled(clicks, schemas.CLICK_FRAUD)
    write_csv(fraud.ip_profile(conversions), f"{out}/conv_analysis_ip")
    write_csv(fraud.repeated_click_times(conversions), f"{out}/conv_analysis_ip_clk_time")
    write_csv(fraud.clicks_around_invalid(conversions, clicks, radius_minutes), f"{out}/conv_analysis_ip_clk_count")


CHECKS = (
    ("click", "{}_clk_daily_summary", reconcile.CLICK),
    ("conv", "{}_conv_daily_summary", reconcile.CONVERSION),
    ("kpi", "{}_daily_kpi", reconcile.KPI),
)


def _append_checks(spark: SparkSession, out: str, report: str, scope: str, days: list[dt.date],
                   zone: float | None = None, missing_days: bool = False) -> None:
    wide = logs.read_summary(spark, f"{out}/{scope}_daily_summary", days, zone)
    for name, detail, pairs in CHECKS:
        rows = logs.read_summary(spark, f"{out}/{detail.format(scope)}", days, zone)
        append_report(reconcile.check(rows, wide, pairs, scope, missing_days), report, f"{scope}_{name}_check")


def reconciliation(spark: SparkSession, out: str, report: str, days: list[dt.date],
                   missing_days: bool = False) -> None:
    """Append the equality flags of ``days`` to the running report."""
    for scope in grains.SCOPES:
        _append_checks(spark, out, report, scope, days, missing_days=missing_days)


# The offsets whose summaries are checked (fixed values).
CHECKED_OFFSETS = [0.0, 5.5, 5.0, -4.0, -5.0, 8.0, -7.0, -8.0, 3.0, 1.0]


def rolled_over(now: int, before: int, offsets: list[float] | None = None) -> dict[float, dt.date]:
    """Offsets whose local day has changed between two times, with the day that has ended.

    A scheduler calls the check with these whenever it wakes up, so each local
    day is checked once, after its end.
    """
    def day(epoch: int, offset: float) -> dt.date:
        return dt.datetime.fromtimestamp(epoch + offset * 3600, dt.timezone.utc).date()

    changed = {}
    for offset in CHECKED_OFFSETS if offsets is None else offsets:
        if day(now, offset) != day(before, offset):
            changed[offset] = day(before, offset)
    return changed


def check_finished_days(spark: SparkSession, out: str, report: str, finished: dict[float, dt.date]) -> None:
    """Check the ended local day of each offset; offset 0 also stands for the UTC day."""
    for offset, day in finished.items():
        for scope in grains.SCOPES if offset == 0 else ("adx",):
            zone = offset if scope == "adx" else None
            _append_checks(spark, out, report, scope, [day], zone)
