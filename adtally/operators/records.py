"""Result messages: columns joined by ``<;>`` in the layout consumers expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally import grains
from adtally.functions import measures as ms
from adtally.operators import conversion
from adtally.operators.event import RETENTION, kpi_units, with_code_kpi

MARK = "<;>"

FORMATS = {**ms.KEY_FORMATS, **{m: "%.4f" for m in (
    "net_profit", "tac", "total_amount", "cost", "revenue", "kpi_value")}}


def _text(name: str) -> Column:
    value = F.col(name)
    if name in FORMATS:
        value = F.format_string(FORMATS[name], value.cast("double"))
    return F.coalesce(value.cast("string"), F.lit(""))


def joined(names: list[str]) -> Column:
    # concat_ws would skip nulls and shift the fields, so none may be left.
    return F.concat_ws(MARK, *[_text(n) for n in names])


def summary_records(df: DataFrame, scope: str, dims: list[str], measures: list[str],
                    tag: str | None = None) -> DataFrame:
    """One message per summary row, with an optional leading tag."""
    body = joined([*grains.keys(scope, dims), *measures])
    return df.select((F.concat_ws(MARK, F.lit(tag), body) if tag else body).alias("value"))


def scoped_records(df: DataFrame, dims: list[str], measures: list[str], tag: str | None = None,
                   lead: str | None = None) -> DataFrame:
    """Messages of a ``by_scope`` rollup.

    ``adx`` messages start with the offset, ``gmt`` messages with the day.
    ``lead`` names a column to put before either.
    """
    head = [F.lit(tag)] if tag else []
    if lead:
        head.append(_text(lead))
    if "timezone" in df.columns:
        # The only part that may be null, and concat_ws is to skip it then.
        head.append(F.when(F.col("scope") == "adx", F.format_string("%.1f", F.col("timezone").cast("double"))))
    return df.select(F.concat_ws(MARK, *head, joined(["dated", *dims, *measures])).alias("value"))


#: Supply messages have the layout of demand messages; nothing unique is counted.
SUPPLY_MEASURES = ["gross_cnt", "uniq_cnt", "revenue"]


def supply_growth(counts: DataFrame) -> DataFrame:
    return counts.withColumn("uniq_cnt", F.lit(0))


def conversion_records(by_reason: DataFrame) -> DataFrame:
    """Messages of the three conversion grains, each with five measures.

    Only the summary grain carries amounts.
    """
    measures = [*conversion.COUNTS, "net_profit", "tac"]
    none = ms.money(F.lit(0))
    fine = conversion.over_reasons(by_reason, grains.CONVERSION).withColumns({"net_profit": none, "tac": none})
    coarse = conversion.over_reasons(by_reason, grains.SUMMARY)
    invalid = conversion.invalid_by_reason(by_reason).withColumnRenamed("invalid_cnt", "gross_cnt").withColumns(
        {"valid_cnt": F.lit(0), "notify_cnt": F.lit(0), "net_profit": none, "tac": none})
    return (
        scoped_records(fine, grains.CONVERSION, measures)
        .unionByName(scoped_records(coarse, grains.SUMMARY, measures))
        .unionByName(scoped_records(invalid, grains.INVALID_CONVERSION, measures)))


CONVERSION_DETAIL = [
    "click_id", "group_id", "campaign_id", "aff_id", "aff_pub", "invalid_type", "income", "income_currency",
    "payout", "payout_currency", "forwarded", "ip", "gaid", "idfa", "carrier", "clk_timestamp", "conv_timestamp",
]
# Missing values in a detail message (fixed values).
DETAIL_DEFAULTS = {
    "click_id": "", "group_id": "0", "campaign_id": "0", "aff_id": "0", "aff_pub": "0", "invalid_type": "",
    "income": "0.0", "income_currency": "", "payout": "0.0", "payout_currency": "", "forwarded": "0", "ip": "",
    "gaid": "", "idfa": "", "carrier": "", "clk_timestamp": "0", "conv_timestamp": "0",
}


def conversion_detail(log: DataFrame) -> DataFrame:
    """Every conversion as a 17 field message."""
    parts = [
        F.coalesce(F.col(c).cast("string"), F.lit(DETAIL_DEFAULTS[c])) for c in CONVERSION_DETAIL
    ]
    return log.select(F.concat_ws(MARK, *parts).alias("value"))


def event_records(fine_counts: DataFrame, scope: str) -> DataFrame:
    """Up to three messages per fine event row.

    ``counts`` goes to the event day, ``kpi`` to the event or install day and
    ``retention`` to the install day; the last two only when they are not 0.
    """
    zone = ["timezone"] if scope == "adx" else []
    rows = fine_counts.select(
        "*", *ms.retention_counts("retent_days", "uniq_cnt"), ms.money(kpi_units()).alias("kpi_value"),
        ms.kpi_day(F.col("kpi"), F.col("event_day"), F.col("install_day")).alias("kpi_day"))

    def message(kind: str, wanted: Column, day: str, tail: list[str]) -> Column:
        body = joined([*zone, day, *grains.EVENT, *tail])
        return F.when(wanted, F.struct(F.lit(kind).alias("record_type"), body.alias("value")))

    messages = F.array_compact(F.array(
        message("counts", F.lit(True), "event_day", ["gross_cnt", "uniq_cnt", "total_amount"]),
        message("kpi", (F.col("kpi_value") != 0) & F.col("kpi_day").isNotNull(), "kpi_day", ["kpi_value"]),
        message("retention", F.col(RETENTION[-1]) != 0, "install_day", RETENTION),
    ))
    return rows.select(F.explode(messages).alias("m")).select("m.*")


def event_growth_records(growth: DataFrame) -> DataFrame:
    """``event_records`` for rows of both scopes, as the event stream grows."""
    rows = growth.withColumn("event_day", F.col("dated"))
    adx = event_records(rows.where("scope = 'adx'"), "adx")
    return adx.unionByName(event_records(rows.where("scope = 'gmt'"), "gmt"))


def event_id_records(growth: DataFrame) -> DataFrame:
    """Messages of the earlier event form, up to two per row.

    A row of the event day sends its counts and an early KPI, a row of the
    install day its retention and a late KPI; what is 0 is not sent. The KPI
    follows the latest code and the counts that were added.
    """
    is_event = F.col("role") == "event"
    early = F.col("kpi_code") < ms.KPI_INSTALL_CODE
    late = F.col("kpi_code") > ms.KPI_INSTALL_CODE
    zone = F.when(F.col("scope") == "adx", F.format_string("%.1f", F.col("timezone").cast("double")))

    def message(wanted: Column, tail: list[str]) -> Column:
        return F.when(wanted, F.concat_ws(MARK, zone, joined(["role_day", *grains.EVENT, *tail])))

    messages = F.array_compact(F.array(
        message(((is_event & early) | (~is_event & late)) & (F.col("kpi_event_cnt") != 0), ["kpi_event_cnt"]),
        message(is_event & (F.col("gross_cnt") != 0), ["gross_cnt", "uniq_cnt", "total_amount"]),
        message(~is_event & (F.col(RETENTION[-1]) != 0), RETENTION)))
    return with_code_kpi(growth).select(F.explode(messages).alias("value"))
