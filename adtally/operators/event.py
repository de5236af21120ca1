"""In-app event summaries: counts, retention and KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally import grains
from adtally.functions import measures as ms
from adtally.functions import time as tm
from adtally.functions.text import currency_code
from adtally.operators.rollup import SCOPE, by_scope, money_sum, sum_of, with_days

RETENTION = [ms.retention_name(n) for n in ms.RETENTION_DAYS]


def project(log: DataFrame) -> DataFrame:
    df = with_days(log, "event_timestamp", prefix="event_day")
    df = with_days(df, "install_timestamp", prefix="install_day")
    return df.withColumns({
        "retent_days": ms.retention_days("event_timestamp", "install_timestamp"),
        "currency": currency_code("order_currency"),
    })


def _fine_keys(scope: str) -> list[str]:
    zone = ["timezone"] if scope == "adx" else []
    return ["retent_days", "kpi", *zone, "install_day", "event_day", *grains.EVENT]


def fine(projected: DataFrame, scope: str) -> DataFrame:
    """Counts by event day, install day, retention day and KPI code.

    Every event summary of the scope follows from this frame.
    """
    keys = [
        F.col(f"{k}_{scope}").alias(k) if k in ("install_day", "event_day") else F.col(k) for k in _fine_keys(scope)
    ]
    return projected.groupBy(*keys).agg(
        F.count("*").alias("gross_cnt"),
        F.count_distinct("click_id").alias("uniq_cnt"),
        money_sum("order_amount", "total_amount"),
    )


FINE = ["retent_days", "kpi", "install_day", *grains.EVENT]


def rows_by_scope(log: DataFrame) -> DataFrame:
    """Every event once per scope, on its event day, with the columns the fine grain needs."""
    rows = by_scope(log.withColumns({
        "retent_days": ms.retention_days("event_timestamp", "install_timestamp"),
        "currency": currency_code("order_currency"),
    }), "event_timestamp", keep_epoch=True)
    return rows.withColumn("install_day", tm.local_day("install_timestamp", F.coalesce("timezone", F.lit(0.0))))


def fine_by_scope(log: DataFrame) -> DataFrame:
    """``fine`` of both scopes in one pass over the log; ``dated`` is the event day."""
    return rows_by_scope(log).groupBy(*SCOPE, *FINE).agg(
        F.count("*").alias("gross_cnt"),
        F.count_distinct("click_id").alias("uniq_cnt"),
        money_sum("order_amount", "total_amount"),
    )


def daily(fine_counts: DataFrame, scope: str) -> DataFrame:
    """Counts on the day of the event; unique counts of the fine rows add up."""
    out = fine_counts.withColumnRenamed("event_day", "dated").groupBy(*grains.keys(scope, grains.EVENT)).agg(
        sum_of("gross_cnt"), sum_of("uniq_cnt"), money_sum("total_amount"))
    return grains.with_row_key(out, scope, grains.EVENT)


def retention(fine_counts: DataFrame, scope: str, within: list[str] | None = None) -> DataFrame:
    """Retention counts on the install day, as long as the row is within 30 days.

    ``within`` keeps further columns apart, for instance the event day.
    """
    keys = [*(within or []), *grains.keys(scope, grains.EVENT)]
    rows = fine_counts.withColumnRenamed("install_day", "dated").select(
        *keys, *ms.retention_counts("retent_days", "uniq_cnt"))
    out = rows.where(F.col(RETENTION[-1]) != 0).groupBy(*keys).agg(
        *[sum_of(r) for r in RETENTION])
    return grains.with_row_key(out, scope, grains.EVENT)


def with_kpi_day(fine_counts: DataFrame) -> DataFrame:
    return fine_counts.withColumn("dated", ms.kpi_day(F.col("kpi"), F.col("event_day"), F.col("install_day")))


def kpi(fine_counts: DataFrame, scope: str, within: list[str] | None = None) -> DataFrame:
    """KPI events on the event or install day, depending on the code."""
    value = ms.kpi_count(F.col("kpi"), F.col("retent_days"), F.col("gross_cnt"), F.col("uniq_cnt"))
    rows = with_kpi_day(fine_counts).withColumn("kpi_event_cnt", value)
    out = rows.where((F.col("kpi_event_cnt") != 0) & F.col("dated").isNotNull()).groupBy(
        *(within or []), *grains.keys(scope, grains.SUMMARY)).agg(sum_of("kpi_event_cnt"))
    return grains.with_row_key(out, scope, grains.SUMMARY)


def kpi_units() -> Column:
    return ms.kpi_amount_units(F.col("kpi"), F.col("retent_days"), F.col("gross_cnt"), F.col("uniq_cnt"),
                               ms.money_units("total_amount"))


def kpi_extended(fine_counts: DataFrame, scope: str) -> DataFrame:
    """KPIs with signed codes, order amounts and single-day retention."""
    rows = with_kpi_day(fine_counts).withColumn("units", kpi_units())
    out = rows.where((F.col("units") != 0) & F.col("dated").isNotNull()).groupBy(
        *grains.keys(scope, grains.SUMMARY)).agg(ms.money(F.sum("units")).alias("kpi_value"))
    return grains.with_row_key(out, scope, grains.SUMMARY)


# The earlier record form: visitors by identifiers, retention flag per event.

def flagged(log: DataFrame) -> DataFrame:
    """Per-event retention flags and the visitor of the earlier record form."""
    flags = {
        ms.retention_name(n): ms.retained_within("event_timestamp", "install_timestamp", n) for n in ms.RETENTION_DAYS
    }
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("ip", "gaid", "idfa", "adid", "adid")]
    return log.withColumns({
        **flags,
        "currency": currency_code("order_currency"),
        "visitor": F.concat_ws("_", *parts),
    })


def by_day_role(df: DataFrame) -> DataFrame:
    """Every event once for its own day and once for its install day, in both scopes.

    ``scope_epoch`` is the event time within the scope, ``role_epoch`` the time
    whose day the row counts on.
    """
    def entry(scope: str, role: str, epoch: str):
        zone = F.col("timezone").cast("double") if scope == "adx" else F.lit(None).cast("double")
        shift = F.col("timezone") * 3600 if scope == "adx" else F.lit(0)
        return F.struct(F.lit(scope).alias("scope"), F.lit(role).alias("role"), zone.alias("timezone"),
                        (F.col("event_timestamp") + shift).cast("long").alias("scope_epoch"),
                        (F.col(epoch) + shift).cast("long").alias("role_epoch"))

    entries = F.array(*[
        entry(scope, role, epoch)
        for scope in grains.SCOPES
        for role, epoch in (("event", "event_timestamp"), ("conv", "install_timestamp"))
    ])
    rest = [c for c in df.columns if c != "timezone"]
    return df.select(*rest, F.explode(entries).alias("_e")).select(*rest, "_e.*")


def with_code_kpi(counts: DataFrame) -> DataFrame:
    """The KPI that the code of a row stands for, from the counts of that row."""
    code = F.col("kpi_code")
    value = F.when(code == ms.KPI_GROSS, F.col("gross_cnt")).when(
        code == ms.KPI_UNIQUE, F.least("uniq_cnt", "gross_cnt"))
    for kpi, span in ms.KPI_RETENTION.items():
        value = value.when(code == kpi, F.col(ms.retention_name(span)))
    return counts.withColumn("kpi_event_cnt", F.coalesce(value, F.lit(0).cast("long")))
