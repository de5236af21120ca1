"""Starting the streaming jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adtally import grains, schemas
from adtally.operators import records
from adtally.sinks.ledger import Ledger
from adtally.sources import logs
from adtally.streaming import filters, rollups, runner

# job -> (layout of the messages, rollup of one micro-batch, of its ``FIELDS`` if it has any)
JOBS: dict[str, tuple] = {
    "click": (schemas.CLICK, rollups.clicks),
    "conversion": (schemas.CONVERSION, rollups.conversions),
    "impression": (schemas.IMPRESSION, rollups.impressions),
    "impression-click": (schemas.IMPRESSION, lambda log: rollups.impressions(log, "clk")),
    "supply": (schemas.DEMAND, rollups.supply_counts),
    "conversion-detail": (schemas.CONVERSION, records.conversion_detail),
    "click-unique": (schemas.CLICK, rollups.click_totals),
    "event": (schemas.EVENT, rollups.event_totals),
    "event-ids": (schemas.EVENT_WITH_IDS, rollups.event_id_totals),
    "demand": (schemas.DEMAND, rollups.demand_part),
    "click-watch": (schemas.CLICK, lambda counts: counts),
}
# job -> what the stream itself computes before it is cut into micro-batches
BEFORE: dict[str, Callable[[DataFrame], DataFrame]] = {"click-watch": filters.click_watch}
# job -> what its rollup needs of a record. A micro-batch is handed over as finished rows, so what is left out
# only there has been built and copied for nothing.
FIELDS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "supply": rollups.supply_fields, "demand": rollups.demand_fields}
WITH_TOPIC = {"supply", "demand"}
#: Fields whose absence means something else than an empty text.
MAY_BE_MISSING = {"click-watch": ("gaid", "idfa"), "conversion-detail": tuple(records.CONVERSION_DETAIL)}

# job -> result messages of what a micro-batch added
RECORDS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "click": lambda df: records.scoped_records(df, grains.CLICK, ["gross_cnt"], tag="click"),
    "click-unique": lambda df: records.scoped_records(df, grains.CLICK, ["gross_cnt", "uniq_cnt"]),
    "conversion": records.conversion_records,
    "impression": lambda df: records.scoped_records(df, grains.IMPRESSION, ["gross_imp_cnt"], tag="impress"),
    "impression-click": lambda df: records.scoped_records(df, grains.IMPRESSION, ["gross_clk_cnt"], tag="click"),
    "event": records.event_growth_records,
    "event-ids": lambda df: records.event_id_records(df.withColumn("kpi_code", F.col("last_code.kpi"))),
    "demand": lambda df: records.scoped_records(
        df, grains.DEMAND, ["gross_cnt", "uniq_cnt", "cost"], lead="kind"),
    "supply": lambda df: records.scoped_records(
        records.supply_growth(df), grains.SUPPLY, records.SUPPLY_MEASURES, lead="kind"),
    "conversion-detail": lambda df: df.select("value"),
}


def table(job: str, path: str, **options) -> Ledger:
    """The table of a job."""
    return Ledger(path, rollups.MERGES[job], **options)


def publisher(job: str, send: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """An ``emit`` that turns what each micro-batch changed into messages and sends them.

    A job without result messages is refused here, before anything has started.
    """
    if job not in RECORDS:
        raise ValueError(f"{job} has no result messages; jobs that have: {', '.join(sorted(RECORDS))}")
    return lambda grown, batch_id: send(RECORDS[job](grown))


def begin(job: str, log: DataFrame, ledger: Ledger, checkpoint: str, trigger: dict | None = None,
          emit: Callable[[DataFrame, int], None] | None = None, mode: str = "append") -> StreamingQuery:
    """Add the rollups of parsed records to a table."""
    if job not in FIELDS:
        return runner.start_table(log, JOBS[job][1], ledger, checkpoint, trigger, emit, mode)
    with runner.small_methods(log.sparkSession):
        return runner.start_table(FIELDS[job](log), JOBS[job][1], ledger, checkpoint, trigger, emit, mode)


def start(job: str, messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
          emit: Callable[[DataFrame, int], None] | None = None, quarantine: str | None = None,
          once_within: str | None = None) -> list[StreamingQuery]:
    """Run one job over ``messages`` (``value`` and, for demand, ``topic``).

    With ``quarantine`` the messages that could not be read are kept there.
    With ``once_within`` the conversion job counts a click id once in that time.
    """
    if once_within and job != "conversion":
        raise ValueError("only conversions have click ids to count once")
    schema = JOBS[job][0]
    keep = ["topic"] if job in WITH_TOPIC else None
    parsed = logs.parse_messages(messages, schema, keep=keep, typed_first=job in FIELDS)
    log = logs.good(parsed, schema, MAY_BE_MISSING.get(job, ()))
    mode = "append"
    if once_within:
        log = filters.once_per_click(log, once_within)
    if job in BEFORE:
        log, mode = BEFORE[job](log), "update"
    queries = [begin(job, log, table(job, path), f"{checkpoint}/main", trigger, emit, mode)]
    if quarantine:
        queries.append(runner.start_quarantine(parsed, quarantine, f"{checkpoint}/bad", trigger))
    return queries
