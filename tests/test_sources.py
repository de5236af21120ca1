import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from adtally import schemas
from adtally.functions import time as tm
from adtally.sources import logs, messages
from tests.conftest import values

DAY = dt.date(2024, 1, 10)


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def test_json_scan_drops_unknown_and_fills_absent(spark, tmp_path):
    write_lines(tmp_path / "log.json", [json.dumps({"campaign_id": 3, "surprise": 1}), json.dumps({"aff_pub": "x"})])
    df = logs.read_json(spark, str(tmp_path / "log.json"), schemas.CLICK)
    assert "surprise" not in df.columns
    filled = logs.filled(df, schemas.CLICK)
    assert values(filled, "campaign_id", "aff_pub", "timezone", "ip") == [(0, "x", 0.0, ""), (3, "", 0.0, "")]


def test_every_flat_field_has_a_default(spark):
    for schema in (schemas.CLICK, schemas.CONVERSION, schemas.EVENT, schemas.EVENT_WITH_IDS):
        empty = spark.createDataFrame([tuple([None] * len(schema))], schema)
        assert None not in logs.filled(empty, schema).first()


def test_window_paths():
    paths = logs.window_paths("/logs/click-{day}", [DAY, DAY + dt.timedelta(days=1)])
    assert paths == [f"/logs/click-202401{d:02d}*" for d in (9, 10, 11, 12)]


def test_day_files_know_the_day_of_their_name(spark, tmp_path):
    for day, line in (("20240108", 1), ("20240109", 2), ("20240110-part2", 3), ("20240111", 4), ("20240112", 5)):
        write_lines(tmp_path / f"click-{day}.json", [json.dumps({"campaign_id": line}), "{broken"])
    log = logs.day_files(spark, f"{tmp_path}/click-{{day}}", [DAY], schemas.CLICK, keep_bad=True)
    assert values(log.where("campaign_id > 0"), "file_day", "campaign_id") == [
        (DAY - dt.timedelta(days=1), 2), (DAY, 3), (DAY + dt.timedelta(days=1), 4)]
    assert values(logs.bad_lines(log), "record.clk_timestamp", "value") == [(None, "{broken")] * 3
    with pytest.raises(FileNotFoundError):
        logs.day_files(spark, f"{tmp_path}/click-{{day}}", [dt.date(2020, 1, 1)], schemas.CLICK)


def test_only_wanted_hours_are_opened(spark, tmp_path):
    for hour in (2024010923, 2024011000, 2024011023, 2024011100):
        write_lines(tmp_path / f"hour={hour}" / "x.json", [json.dumps({"campaign_id": hour % 100})])
    log = logs.hour_folders(spark, str(tmp_path), [DAY], schemas.CLICK)
    assert values(log, "hour", "campaign_id") == [(2024011000, 0), (2024011023, 23)]
    assert {f.split("hour=")[1][:10] for f in log.inputFiles()} >= {"2024011000"}
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    opened = log.select("_metadata.file_path").distinct()
    assert opened.count() == 2


def test_day_bounds_reach_the_parquet_scan(spark, tmp_path):
    origin = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    df = spark.range(0, 30 * 24).select((F.col("id") * 3600 + origin).cast("int").alias("clk_timestamp"),
                                        F.lit(5.5).cast("float").alias("timezone"))
    df = df.withColumn("file_day", tm.utc_day("clk_timestamp"))
    df.write.partitionBy("file_day").parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    exact = log.where(tm.local_day("clk_timestamp", "timezone") == F.lit(DAY))
    windowed = logs.near_days(logs.in_file_window(log, [DAY]), [DAY], "clk_timestamp").where(
        tm.local_day("clk_timestamp", "timezone") == F.lit(DAY))
    assert windowed.count() == exact.count() == 24
    plan = windowed._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters: ["):]
    assert "GreaterThanOrEqual(clk_timestamp" in pushed and "LessThan" in pushed.replace("Les...", "LessThan")
    assert "PartitionFilters: [isnotnull(file_day" in plan


LINES = [
    '{"campaign_id": 1, "clk_timestamp": 5}',
    '{"campaign_id": "2", "clk_timestamp": "7", "timezone": "5.5"}',
    '{"campaign_id": "x"}',
    '{"campaign_id": 4',
    'hello',
    '[1, 2]',
    '',
    '{}',
]


def test_messages_with_quoted_numbers_are_read(spark, frame):
    parsed = logs.parse_messages(frame([(x,) for x in LINES], "value string"), schemas.CLICK)
    good = logs.good(parsed, schemas.CLICK)
    assert values(good, "campaign_id", "clk_timestamp", "timezone") == [(0, 0, 0.0), (1, 5, 0.0), (2, 7, 5.5)]
    assert values(logs.quarantined(parsed)) == sorted((x,) for x in LINES[2:7])


def test_a_message_is_parsed_once(spark, frame):
    good = logs.good(logs.parse_messages(frame([(x,) for x in LINES], "value string"), schemas.CLICK), schemas.CLICK)
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


DEMAND_LINES = [
    '{"tz": 5.5, "cid": "a", "clickts": 7, "dcost": 0.1, "geo": {"cc": "x", "pgeonid": 3}, "app": {"bundle": "q"}}',
    '{"tz": "5.5", "cid": 1, "clickts": "7", "geo": {"pgeonid": "3"}}',
    '{"tz": null, "clickts": null, "site": null, "device": {"connectiontype": null, "ua": {"a": [1, 2.50]}}}',
    '{"dcost": 12345678901234567890, "tz": -0.0, "pixelts": -0}', '{"dcost": 5e-324, "tz": 1.0000000000000002}',
    '{"dcost": 1e400}', '{"dcost": NaN}', '{"dcost": "NaN"}', '{"dcost": Infinity}', '{"dcost": ""}',
    '{"clickts": 1.0}', '{"clickts": "1.0"}', '{"clickts": 1e3}', '{"clickts": 9223372036854775808}',
    '{"geo": {"pgeonid": 2147483648}}', '{"geo": {"pgeonid": "z"}, "cid": "c"}', '{"geo": 5}', '{"geo": [1]}',
    '{"site": {"publisher": "p"}}', '{"tz": true}', '{"tz": {"a": 1}}', '{"tz": "x", "tz": 1}', '{"tz": 1, "tz": "x"}',
    '{"clickts": " 7 "}', '{"cid": "\\u00e9\\n"}', '{"cid": tru}', '{"cid": "a"', '{"cid": "a"} x', '[{"cid": "a"}]', '[]',
    '7', 'x', '', ' ', ' {"cid": "b"}', '{}', 'null', None,
]


def test_messages_read_with_their_types_are_those_read_as_text(spark, frame):
    lines = frame([(x,) for x in DEMAND_LINES], "value string")
    usual, typed = [logs.parse_messages(lines, schemas.DEMAND, typed_first=t) for t in (False, True)]
    assert typed.dtypes == usual.dtypes
    assert [str(r) for r in typed.collect()] == [str(r) for r in usual.collect()]
    for part in (lambda p: logs.good(p, schemas.DEMAND), logs.quarantined):
        assert [str(r) for r in part(typed).collect()] == [str(r) for r in part(usual).collect()]
    assert 0 < logs.quarantined(typed).count() < len(DEMAND_LINES)


def test_nested_messages(spark, frame):
    text = json.dumps({"request_unix": "9", "option": {"region_ids": [1, "b"], "stdplcmts": {"1": 2}, "os": "x"}})
    good = logs.good(logs.parse_messages(frame([(text,)], "value string"), schemas.IMPRESSION), schemas.IMPRESSION)
    row = good.first()
    assert row.request_unix == 9 and row.option.region_ids == ["1", "b"] and row.option.stdplcmts == {"1": 2}
    empty = logs.good(logs.parse_messages(frame([("{}",)], "value string"), schemas.IMPRESSION), schemas.IMPRESSION)
    assert empty.first().option is None


def test_id_list(spark, tmp_path):
    write_lines(tmp_path / "list", ["3", " 5 ", "", "3"])
    assert values(logs.read_id_list(spark, str(tmp_path / "list"))) == [("3",), ("3",), ("5",)]


def test_read_summary(spark, tmp_path):
    df = spark.createDataFrame([(DAY, 5.5, 1), (DAY, 0.0, 2), (dt.date(2024, 1, 11), 5.5, 3)],
                               "dated date, timezone double, n int")
    df.write.partitionBy("dated").parquet(str(tmp_path / "t"))
    assert values(logs.read_summary(spark, str(tmp_path / "t"), [DAY], 5.5), "n") == [(1,)]
    assert logs.read_summary(spark, str(tmp_path / "t")).count() == 3


def test_kafka_options():
    options = messages.kafka_options("host:1", ["a", "b"], 10)
    assert options["subscribe"] == "a,b" and options["startingOffsets"] == "latest"
    assert options["maxOffsetsPerTrigger"] == "10"
