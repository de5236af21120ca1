"""Command line: ``python -m adtally click --log PATH --out DIR --start-date D --end-date D``."""

from __future__ import annotations

import argparse
import datetime as dt
import time

from adtally import schemas
from adtally.functions.time import day_range
from adtally.plans import audit, daily, streams
from adtally.session import build, size_shuffles, total_bytes
from adtally.sinks import reports
from adtally.sources import logs, messages
from adtally.streaming import filters

DAILY = {
    "click": (schemas.CLICK, daily.clicks),
    "conversion": (schemas.CONVERSION, daily.conversions),
    "event": (schemas.EVENT, daily.events),
    "impression": (schemas.IMPRESSION, daily.impressions),
    "demand": (schemas.DEMAND, daily.demands),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="adtally")
    jobs = p.add_subparsers(dest="job", required=True)
    for name in (*DAILY, "summary", "check"):
        job = jobs.add_parser(name)
        job.add_argument("--out", required=True, help="folder of the summary tables")
        job.add_argument("--start-date", type=dt.date.fromisoformat, required=True)
        job.add_argument("--end-date", type=dt.date.fromisoformat, required=True)
        if name in DAILY:
            job.add_argument("--log", required=True, help="file pattern with a {day} place, or a Parquet folder")
        if name == "click":
            job.add_argument("--by-tuple", action="store_true", help="unique visitors as distinct id tuples")
        if name != "check":
            job.add_argument("--database", help="make the tables known there; the summary reads them by name")
        if name == "check":
            job.add_argument("--report", required=True)
    fraud = jobs.add_parser("fraud")
    for arg in ("--clicks", "--events", "--conversions", "--out"):
        fraud.add_argument(arg, required=True)
    for arg in ("--start-date", "--end-date"):
        fraud.add_argument(arg, type=dt.date.fromisoformat, help="clicks and events are in hour folders; read these days")
    fraud.add_argument("--more-than", type=int, default=5)
    fraud.add_argument("--click-radius", type=int, default=10, help="minutes")
    ended = jobs.add_parser("check-ended", help="check the local days that ended since an earlier time")
    ended.add_argument("--since", type=int, required=True, help="epoch seconds of the call before")
    for arg in ("--out", "--report"):
        ended.add_argument(arg, required=True)
    stream = jobs.add_parser("stream")
    stream.add_argument("name", choices=sorted(streams.JOBS))
    stream.add_argument("--result-topic", help="send result messages there")
    stream.add_argument("--once-within", help="count a click id once in this time, as in '3 days'; for conversion")
    listed = jobs.add_parser("list-filter", help="keep the messages whose group is on a list")
    listed.add_argument("--list", required=True, help="text file with one group id per line")
    listed.add_argument("--list-minutes", type=int, default=60, help="how old a reading of the list may be")
    for job in (stream, listed):
        for arg in ("--servers", "--out", "--checkpoint"):
            job.add_argument(arg, required=True)
        job.add_argument("--topics", required=True, help="comma separated")
        job.add_argument("--seconds", type=int, default=20)
        job.add_argument("--max-offsets", type=int)
    return p


def read_log(spark, where: str, schema, days):
    """The log files of the days, or a Parquet log; shuffles are sized for what is read."""
    if "{day}" in where:
        size_shuffles(spark, total_bytes(spark, logs.present(spark, logs.window_paths(where, days))))
        return logs.day_files(spark, where, days, schema, keep_bad=True)
    size_shuffles(spark, total_bytes(spark, [where]))
    return spark.read.parquet(where)


def fraud_log(spark, where: str, schema, args):
    """JSON files, or with dates the hour folders of these days."""
    if args.start_date:
        return logs.hour_folders(spark, where, day_range(args.start_date, args.end_date or args.start_date), schema)
    return logs.read_json(spark, where, schema)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build(f"adtally {args.job}")
    if args.job in ("stream", "list-filter"):
        source = messages.kafka_messages(spark, args.servers, args.topics.split(","), args.max_offsets)
        trigger = {"processingTime": f"{args.seconds} seconds"}
    if args.job == "list-filter":
        filters.start_list_filter(source, args.list, args.out, args.checkpoint, trigger,
                                  max_age=args.list_minutes * 60).awaitTermination()
    elif args.job == "check-ended":
        audit.check_finished_days(spark, args.out, args.report, audit.rolled_over(int(time.time()), args.since))
    elif args.job == "stream":
        emit = None
        if args.result_topic:
            emit = streams.publisher(
                args.name, lambda df: reports.send_batch(df, args.servers, args.result_topic))
        streams.start(args.name, source, args.out, args.checkpoint, trigger, emit, f"{args.out}_malformed",
                      args.once_within)
        spark.streams.awaitAnyTermination()
    elif args.job == "fraud":
        clicks = fraud_log(spark, args.clicks, schemas.CLICK_FRAUD, args)
        events = fraud_log(spark, args.events, schemas.EVENT_FRAUD, args)
        conversions = logs.read_json(spark, args.conversions, schemas.CONVERSION_FRAUD)
        audit.hourly_fraud(spark, clicks, events, args.out, args.more_than)
        audit.conversion_fraud(spark, conversions, clicks, args.out, args.click_radius)
    else:
        days = day_range(args.start_date, args.end_date)
        if args.job == "summary":
            if args.database:
                daily.register(spark, args.out, args.database, days)
            daily.wide_summaries(spark, args.out, days, args.database)
        elif args.job == "check":
            audit.reconciliation(spark, args.out, args.report, days)
        else:
            schema, job = DAILY[args.job]
            options = {"by_tuple": True} if getattr(args, "by_tuple", False) else {}
            log = read_log(spark, args.log, schema, days)
            daily.with_quarantine(spark, job, log, args.out, days, args.job, **options)
        if getattr(args, "database", None):
            daily.register(spark, args.out, args.database, days)


if __name__ == "__main__":
    main()
