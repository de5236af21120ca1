"""What the streams count in a micro-batch, and how micro-batches add up.

No function keeps state. Unique counts are kept as visitor sketches, which the
table of a stream merges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally import grains
from adtally.functions import measures as ms
from adtally.functions import time as tm
from adtally.functions.identity import sketch_key
from adtally.operators import click, conversion, demand, event, impression
from adtally.operators.rollup import SCOPE, add_up, by_hash, by_scope, by_scope_once, gathered, money_sum, sum_of
from adtally.sinks.ledger import Merge

LOG2_REGISTERS = 12
# Local time of the latest zone, and a day for clocks that are wrong.
AHEAD_HOURS = 38
_VISITORS = {"visitors": "uniq_cnt"}

#: Job -> how its micro-batches add up.
MERGES: dict[str, Merge] = {
    "click": Merge([*SCOPE, *grains.CLICK], ["gross_cnt"]),
    "conversion": Merge([*SCOPE, *grains.CONVERSION, "invalid_type"], conversion.COUNTS, ["net_profit", "tac"]),
    "impression": Merge([*SCOPE, *grains.IMPRESSION], ["gross_imp_cnt"]),
    "impression-click": Merge([*SCOPE, *grains.IMPRESSION], ["gross_clk_cnt"]),
    "supply": Merge(["kind", "dated", *grains.SUPPLY], ["gross_cnt"], ["revenue"]),
    "conversion-detail": Merge([]),
    "click-unique": Merge([*SCOPE, *grains.CLICK], ["gross_cnt"], [], _VISITORS),
    "event": Merge([*SCOPE, *event.FINE], ["gross_cnt"], ["total_amount"], _VISITORS),
    "event-ids": Merge([*SCOPE, "role", "role_day", *grains.EVENT], ["gross_cnt", *event.RETENTION], ["total_amount"],
                       _VISITORS, ["last_code"]),
    "demand": Merge([*SCOPE, "kind", *grains.DEMAND], ["gross_cnt"], ["cost"], _VISITORS,
                    together=["kind", *grains.DEMAND]),
    "click-watch": Merge(["window_start", "kind", "key"], latest=["cnt"]),
}


def _sketch(key: str) -> Column:
    return F.hll_sketch_agg(sketch_key(key), F.lit(LOG2_REGISTERS)).alias("visitors")


def _credible(rows: DataFrame) -> DataFrame:
    """Without records from more than ``AHEAD_HOURS`` after now, which cannot be true."""
    return rows.where(F.col("scope_epoch") <= _latest())


def _latest() -> Column:
    return F.unix_seconds(F.current_timestamp()) + AHEAD_HOURS * 3600


def clicks(log: DataFrame) -> DataFrame:
    return click.counts_by_scope(log)


def conversions(log: DataFrame) -> DataFrame:
    """Increments by reason; the published grains add up from them.

    The stream counts every record. Repeated click ids are removed by the
    daily job only.
    """
    return conversion.counts_by_reason(log)


def impressions(log: DataFrame, kind: str = "imp") -> DataFrame:
    flat = impression.flatten_stream(log)
    return by_scope(flat, "request_unix").groupBy(*SCOPE, *grains.IMPRESSION).agg(
        F.count("*").alias(f"gross_{kind}_cnt"))


def supply_fields(log: DataFrame) -> DataFrame:
    """What ``supply_counts`` needs of a record."""
    return demand.supply_rows(demand.flatten_stream(log)).select("kind", "epoch", *grains.SUPPLY, "revenue")


def supply_counts(fields: DataFrame) -> DataFrame:
    return fields.withColumn("dated", tm.utc_day("epoch")).groupBy("kind", "dated", *grains.SUPPLY).agg(
        F.count("*").alias("gross_cnt"), money_sum("revenue"))


def supply(log: DataFrame) -> DataFrame:
    return supply_counts(supply_fields(log))


def click_totals(log: DataFrame) -> DataFrame:
    """Gross clicks and sketches of visitors, in both scopes alike."""
    rows = by_scope(log.withColumn("visitor", _joined("ip", "gaid", "idfa", "adid", "ua")), "clk_timestamp",
                    keep_epoch=True)
    return _credible(rows).groupBy(*by_hash(*MERGES["click-unique"].keys)).agg(
        F.count("*").alias("gross_cnt"), _sketch("visitor")).drop("_hash")


def _joined(*ids: str) -> Column:
    return F.concat_ws("_", *[F.coalesce(F.col(i), F.lit("")) for i in ids])


def event_totals(log: DataFrame) -> DataFrame:
    """The fine event rows: by event day, install day, retention day and KPI code."""
    return _credible(event.rows_by_scope(log)).groupBy(*MERGES["event"].keys).agg(
        F.count("*").alias("gross_cnt"), _sketch("click_id"), money_sum("order_amount", "total_amount"))


def event_id_totals(log: DataFrame) -> DataFrame:
    """The earlier event form.

    Rows count on the event day and on the install day (``role_day``). Each
    carries the latest code seen for its key.
    """
    rows = _credible(event.by_day_role(event.flagged(log))).withColumns(
        {"dated": tm.utc_day("scope_epoch"), "role_day": tm.utc_day("role_epoch")})
    return rows.groupBy(*MERGES["event-ids"].keys).agg(
        F.count("*").alias("gross_cnt"), _sketch("visitor"), money_sum("order_amount", "total_amount"),
        F.max(F.struct("event_timestamp", "kpi")).alias("last_code"), *[sum_of(r) for r in event.RETENTION])


def with_latest_code(rows: DataFrame) -> DataFrame:
    """The KPI that the latest code of each row stands for."""
    return event.with_code_kpi(rows.withColumn("kpi_code", F.col("last_code.kpi")))


def event_id_records(totals: DataFrame) -> DataFrame:
    """The columns each kind of row publishes: counts and early KPIs on the event day,
    retention and late KPIs on the install day."""
    is_event = F.col("role") == "event"
    early = F.col("kpi_code") < ms.KPI_INSTALL_CODE
    late = F.col("kpi_code") > ms.KPI_INSTALL_CODE
    shown_kpi = (is_event & early) | (~is_event & late)
    kept = totals.select(
        "scope", "timezone", F.col("role_day").alias("dated"), "role", *grains.EVENT,
        *[F.when(is_event, F.col(c)).otherwise(0).alias(c) for c in ("gross_cnt", "uniq_cnt", "total_amount")],
        F.when(shown_kpi, F.col("kpi_event_cnt")).otherwise(0).alias("kpi_event_cnt"),
        *[F.when(is_event, 0).otherwise(F.col(r)).alias(r) for r in event.RETENTION],
    )
    nothing = (F.col("gross_cnt") == 0) & (F.col("kpi_event_cnt") == 0) & (F.col(event.RETENTION[-1]) == 0)
    return kept.where(~nothing)


def demand_fields(log: DataFrame) -> DataFrame:
    """What ``demand_counts`` needs of a record."""
    return demand.demand_rows(demand.flatten_stream(log)).select(
        "timezone", "epoch", "kind", *grains.DEMAND, "uv", "cost")


def demand_totals(log: DataFrame, parts: int | None = None) -> DataFrame:
    return demand_counts(demand_fields(log), parts)


def demand_part(fields: DataFrame) -> DataFrame:
    """``demand_counts`` as a table keeps them: records that have one day in both scopes count in one row."""
    dims = MERGES["demand"].together
    rows = by_scope_once(gathered(fields, dims), "epoch", _latest())
    return add_up(rows, dims, F.count("*").alias("gross_cnt"), _sketch("uv"), money_sum("cost"), by_day=True)


def demand_counts(fields: DataFrame, parts: int | None = None) -> DataFrame:
    rows = by_scope(demand.together(fields, "kind", parts=parts), "epoch", keep_epoch=True)
    return _credible(rows).groupBy(*by_hash(*MERGES["demand"].keys)).agg(
        F.count("*").alias("gross_cnt"), _sketch("uv"), money_sum("cost")).drop("_hash")
