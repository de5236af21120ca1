import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from adtally import grains, schemas
from adtally.operators import click, event
from adtally.plans import streams
from adtally.sinks import reports
from adtally.sinks.ledger import Ledger, Merge
from adtally.sources import logs, messages
from adtally.streaming import filters, rollups, runner
from tests.conftest import values

MIDNIGHT = int(dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc).timestamp())
NOW = runner.WHAT_IS_THERE


class Feed:
    """A folder of message files, one file per micro-batch."""

    def __init__(self, spark, base):
        self.spark, self.base, self.n = spark, base, 0
        (base / "in").mkdir()

    def send(self, *records):
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        path = self.base / "in" / f"{self.n:03d}.txt"
        path.write_text("\n".join(lines) + "\n")
        # The source orders files by time; make it differ.
        os.utime(path, (1_700_000_000 + self.n, 1_700_000_000 + self.n))
        self.n += 1

    def messages(self):
        return messages.file_messages(self.spark, str(self.base / "in"), files_per_batch=1)

    def log(self, schema):
        return logs.good(logs.parse_messages(self.messages(), schema), schema)

    def path(self, name):
        return str(self.base / name)


@pytest.fixture()
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def click_record(ip="a", at=MIDNIGHT, zone=-8.0, **more):
    return {"ip": ip, "clk_timestamp": at, "timezone": zone, **more}


def run(feed, job, **kwargs):
    for query in streams.start(job, feed.messages(), feed.path("out"), feed.path("checkpoint"), NOW, **kwargs):
        query.awaitTermination()


def totals(spark, feed, job, path="out"):
    return streams.table(job, feed.path(path)).totals(spark)


def test_counts_without_state_add_up_over_batches(spark, feed):
    feed.send(click_record(), click_record("b"))
    feed.send(click_record(), "not json", click_record(at="x"))
    run(feed, "click", quarantine=feed.path("bad"))
    table = streams.table("click", feed.path("out"))
    assert [p.name[-1] for p in table.parts(spark)] == ["0", "1"]
    total = table.rows(spark).groupBy("scope", "dated").agg(F.sum("gross_cnt"))
    assert values(total) == [("adx", dt.date(2024, 1, 9), 3), ("gmt", dt.date(2024, 1, 10), 3)]
    bad = Ledger(feed.path("bad"), Merge([])).rows(spark)
    assert values(bad, "value") == [("not json",), (json.dumps(click_record(at="x")),)]


def test_a_restart_goes_on_where_it_stopped(spark, feed):
    feed.send(click_record())
    run(feed, "click")
    feed.send(click_record(), click_record())
    run(feed, "click")
    run(feed, "click")
    total = totals(spark, feed, "click").where("scope = 'gmt'").agg(F.sum("gross_cnt")).first()[0]
    assert total == 3


def test_unique_totals_and_their_growth(spark, feed):
    feed.send(click_record("a"), click_record("a"), click_record("b"))
    feed.send(click_record("a"), click_record("c"))
    feed.send(click_record("c"))
    feed.send(click_record("d"), click_record("d"))
    grown = []

    def publish(growth, batch_id):
        grown.append(values(growth.where("scope = 'gmt'"), "gross_cnt", "uniq_cnt"))

    run(feed, "click-unique", emit=publish)
    assert values(totals(spark, feed, "click-unique"), "scope", "gross_cnt", "uniq_cnt") == [("adx", 8, 4), ("gmt", 8, 4)]
    assert grown == [[(3, 2)], [(2, 1)], [(1, 0)], [(2, 1)]]


def test_records_from_the_future_end_no_day(spark, feed):
    feed.send(click_record("a"))
    feed.send(click_record("a", at=4_000_000_000), click_record("b"))
    feed.send(click_record("c"))
    run(feed, "click-unique")
    last = totals(spark, feed, "click-unique")
    assert values(last, "scope", "gross_cnt", "uniq_cnt") == [("adx", 3, 3), ("gmt", 3, 3)]


@pytest.mark.parametrize("record, key", [
    ({"idfa": "i"}, "i"), ({"gaid": "", "idfa": "i"}, ""), ({"gaid": "{gaid}", "idfa": "i"}, "i"),
    ({"gaid": "g", "idfa": "i"}, "g"), ({"gaid": "{x}", "idfa": "{y}"}, ""), ({}, "")])
def test_watched_advertising_id(spark, feed, record, key):
    feed.send({"clk_timestamp": MIDNIGHT, "ip": "1.1.1.1", **record})
    run(feed, "click-watch")
    seen = totals(spark, feed, "click-watch").where("kind = '10002'").select("key").distinct()
    assert values(seen) == [(key,)]


def test_a_stream_without_messages_is_refused_at_once():
    with pytest.raises(ValueError):
        streams.publisher("click-watch", lambda df: None)


def test_messages_of_the_earlier_event_form(spark, feed):
    """The second batch publishes what it added, with the KPI of its own code."""
    record = {"ip": "a", "event_timestamp": MIDNIGHT + 3600, "install_timestamp": MIDNIGHT - 40 * 86400, "kpi": 1,
              "timezone": 0, "order_amount": 1.5, "order_currency": "USD"}
    sent = []

    def send():
        emit = streams.publisher("event-ids", lambda df: sent.append(values(df)))
        run(feed, "event-ids", emit=emit)

    feed.send(record)
    send()
    feed.send({**record, "event_timestamp": MIDNIGHT + 7200, "kpi": 2, "ip": "b"},
              {**record, "aff_id": 7, "kpi": 915, "install_timestamp": MIDNIGHT - 86400})
    send()
    first, second = ({m for (m,) in batch if not m.startswith("0.0")} for batch in [sent[0], sum(sent[1:], [])])
    keys = "2024-01-10<;>0<;>0<;>{}<;><;>0<;>USD<;>0<;>"
    assert first == {keys.format(0) + "1", keys.format(0) + "1<;>1<;>1.5000"}
    late = keys.format(7).replace("01-10", "01-09")
    assert second == {keys.format(0) + "1", keys.format(0) + "1<;>1<;>1.5000", keys.format(7) + "1<;>1<;>1.5000",
                      late + "1", late + "0<;>1<;>1<;>1<;>1"}


def test_an_absent_publisher_is_0_in_the_detail(spark, feed):
    feed.send({"click_id": "c"})
    run(feed, "conversion-detail")
    assert values(streams.table("conversion-detail", feed.path("out")).rows(spark), "value")[0][0].startswith("c<;>0<;>0<;>0<;>0<;><;>0.0")


@pytest.mark.parametrize("every", [2, 50])
def test_a_late_record_adds_to_its_day_however_long_ago(spark, feed, every):
    """Neither the number of batches since nor their times matter: nothing is forgotten."""
    feed.send(click_record("a"))
    for i in range(5):
        feed.send(click_record("a", at=MIDNIGHT + (10 + i) * 86400))
    feed.send(click_record("late"), click_record("a"))
    grown = []
    ledger = streams.table("click-unique", feed.path("out"), every=every)
    log = feed.log(schemas.CLICK)
    runner.start_table(log, rollups.click_totals, ledger, feed.path("ck"), NOW, lambda df, i: grown.append(
        values(df.where("scope = 'gmt'"), "dated", "gross_cnt", "uniq_cnt"))).awaitTermination()
    assert grown[-1] == [(dt.date(2024, 1, 10), 2, 1)]
    last = ledger.totals(spark, [dt.date(2024, 1, 10)]).where("scope = 'gmt'")
    assert values(last, "gross_cnt", "uniq_cnt") == [(3, 2)]


def test_unique_totals_match_the_batch_count(spark, sf, feed):
    rows = [click_record(f"ip{i % 700}", MIDNIGHT + i % 1000) for i in range(3000)]
    for part in range(3):
        feed.send(*rows[part::3])
    run(feed, "click-unique")
    last = totals(spark, feed, "click-unique")
    got = last.where("scope = 'gmt'").first()
    assert got.gross_cnt == 3000 and abs(got.uniq_cnt - 700) <= 0.049 * 700


def test_event_stream_keeps_the_fine_grain(spark, feed):
    record = {"click_id": "c", "event_timestamp": MIDNIGHT + 3600, "install_timestamp": MIDNIGHT - 86400, "kpi": 92,
              "timezone": 0, "order_amount": 1.25, "order_currency": "USDX"}
    feed.send(record, record)
    feed.send({**record, "click_id": ""}, {**record, "kpi": 1})
    run(feed, "event")
    last = totals(spark, feed, "event")
    d9, d10 = dt.date(2024, 1, 9), dt.date(2024, 1, 10)
    gmt = last.where("scope = 'gmt'")
    assert values(gmt, "dated", "install_day", "retent_days", "kpi", "gross_cnt", "uniq_cnt", "total_amount") == [
        (d10, d9, 1, 1, 1, 1, 1.25), (d10, d9, 1, 92, 3, 2, 3.75)]
    fine = gmt.withColumn("event_day", F.col("dated")).drop("dated")
    assert values(event.kpi(fine, "gmt"), "dated", "kpi_event_cnt") == [(d9, 2), (d10, 1)]


def test_earlier_event_form(spark, feed):
    record = {"ip": "a", "event_timestamp": MIDNIGHT + 3600, "install_timestamp": MIDNIGHT - 40 * 86400, "kpi": 1,
              "timezone": 0, "order_amount": 1.0, "order_currency": "USD"}
    feed.send(record, {**record, "event_timestamp": MIDNIGHT + 7200, "kpi": 2, "ip": "b"},
              {**record, "aff_id": 7, "kpi": 915, "install_timestamp": MIDNIGHT - 86400})
    run(feed, "event-ids")
    last = rollups.with_latest_code(totals(spark, feed, "event-ids")).where("scope = 'gmt'")
    shown = rollups.event_id_records(last)
    got = values(shown, "aff_id", "role", "dated", "gross_cnt", "uniq_cnt", "kpi_event_cnt", "in30_retention_cnt")
    assert got == [
        (0, "event", dt.date(2024, 1, 10), 2, 2, 2, 0),
        (7, "conv", dt.date(2024, 1, 9), 0, 0, 1, 1),
        (7, "event", dt.date(2024, 1, 10), 1, 1, 0, 0),
    ]


def test_impressions_without_option_do_not_count(spark, feed):
    feed.send({"request_unix": MIDNIGHT, "option": {"region_ids": ["3", "x"]}}, {"request_unix": MIDNIGHT})
    run(feed, "impression")
    table = totals(spark, feed, "impression").where("scope = 'gmt'")
    assert values(table, "province_geoname_id", "city_geoname_id", "gross_imp_cnt") == [(3, 0, 1)]


def test_demand_streams_use_the_topic(spark, feed):
    feed.send({"clickts": MIDNIGHT, "pixelts": 5, "dcost": 2.5, "srevenue": "1.5", "tz": 0},
              {"clickts": MIDNIGHT, "pixelts": MIDNIGHT + 5, "dcost": 1, "srevenue": "x", "tz": 0, "demand": "i"})
    topic = F.when(F.col("value").contains('"demand"'), "x_imps").otherwise("x_clks")
    source = feed.messages().withColumn("topic", topic)
    for job in ("demand", "supply"):
        for q in streams.start(job, source, feed.path(job), feed.path(f"ck-{job}"), NOW):
            q.awaitTermination()
    last = totals(spark, feed, "demand", "demand")
    assert values(last.where("scope = 'gmt'"), "kind", "dated", "gross_cnt", "cost") == [
        ("clks", dt.date(2024, 1, 10), 1, 2.5), ("imps", dt.date(2024, 1, 10), 1, 1.0)]
    supply = totals(spark, feed, "supply", "supply")
    assert values(supply, "kind", "gross_cnt", "revenue") == [("clks", 1, 1.5), ("imps", 1, 0.0)]


def demand_record(ip="a", at=MIDNIGHT + 43200, tz=8.0, **more):
    return {"clickts": at, "tz": tz, "dcost": 0.5, "cid": "b", "device": {"ip": ip}, **more}


def test_demand_table_keeps_one_row_for_both_scopes(spark, feed):
    """Days and merges are those of a row for each scope; the local day of the last record is the next."""
    feed.send(demand_record(), demand_record("b"), demand_record(tz=-0.0), demand_record(at=MIDNIGHT + 70000))
    feed.send(demand_record(tz=0.0), demand_record("c", at=MIDNIGHT + 80000, tz=-4.0), demand_record(cid="b\x1f"),
              demand_record(at=MIDNIGHT * 10))
    feed.send(demand_record("b"), demand_record("b", tz=-4.0, cid="\x1fb"))
    source = feed.messages().withColumn("topic", F.lit("x_clks"))
    for every in (2, 16):
        out = f"out-{every}"
        table = streams.table("demand", feed.path(out), every=every)
        parsed = logs.parse_messages(source, schemas.DEMAND, keep=["topic"], typed_first=True)
        streams.begin("demand", logs.good(parsed, schemas.DEMAND), table, feed.path(f"ck-{every}"),
                      NOW).awaitTermination()
        wanted = [("adx", -4.0, 10, "\x1fb", 1, 1), ("adx", -4.0, 10, "b", 1, 1), ("adx", 0.0, 10, "b", 2, 1),
                  ("adx", 8.0, 10, "b", 3, 2), ("adx", 8.0, 10, "b\x1f", 1, 1), ("adx", 8.0, 11, "b", 1, 1),
                  ("gmt", None, 10, "\x1fb", 1, 1), ("gmt", None, 10, "b", 7, 3), ("gmt", None, 10, "b\x1f", 1, 1)]

        def found(days=None):
            return sorted((r.scope, r.timezone, r.dated.day, r.campaign_id, r.gross_cnt, r.uniq_cnt)
                          for r in table.totals(spark, days).collect())

        assert found() == wanted
        assert found([dt.date(2024, 1, 11)]) == [w for w in wanted if w[2] == 11]
        rows = table.rows(spark)
        assert values(rows.groupBy("scope").agg(F.sum("gross_cnt"), F.sum("cost").cast("double"))) == [
            ("adx", 9, 4.5), ("gmt", 9, 4.5)]
        stored = spark.read.parquet(f"{feed.path(out)}/data")
        assert values(stored.where("part not like 'b%2'").groupBy("scope").agg(F.sum("gross_cnt"))) == (
            [("adx", 1), ("both", 6), ("gmt", 1)] if every == 16 else [("adx", 2), ("both", 12), ("gmt", 2)])


def test_conversion_stream_counts_every_record(spark, feed):
    record = {"click_id": "c", "conv_timestamp": MIDNIGHT, "forwarded": 1, "net_profit": 0.5, "timezone": 0}
    feed.send(record, record, {**record, "invalid_type": "E001"})
    run(feed, "conversion")
    table = totals(spark, feed, "conversion").where("scope = 'gmt'")
    assert values(table, "invalid_type", "gross_cnt", "valid_cnt", "notify_cnt", "net_profit") == [
        ("", 2, 2, 2, 1.0), ("E001", 1, 0, 1, 0.5)]


def test_list_filter_rereads_the_list(spark, feed, tmp_path):
    """A reading of the list holds for an hour, a repeated batch sees what it saw before."""
    listed, clock = tmp_path / "groups", [1_700_000_000]

    def write(groups, at):
        listed.write_text(groups)
        os.utime(listed, (at, at))

    def once():
        filters.start_list_filter(feed.messages(), str(listed), feed.path("kept"), feed.path("ck"), NOW,
                                  clock=lambda: clock[0]).awaitTermination()
        return values(filters.filtered(feed.path("kept")).rows(spark), "value")

    write("1\n", 1000)
    feed.send({"group_id": 1, "n": 1}, {"group_id": 2, "n": 1})
    assert once() == [('{"group_id": 1, "n": 1}',)]
    write("2\n", 2000)
    clock[0] += 3599
    feed.send({"group_id": 1, "n": 2}, {"group_id": "2", "n": 2})
    assert len(once()) == 2  # still the list of before
    clock[0] += 3600
    feed.send({"group_id": 1, "n": 3}, {"group_id": "2", "n": 3})
    kept = once()
    assert [json.loads(v)["n"] for (v,) in kept if '"2"' in v] == [3] and len(kept) == 3
    versions = filters.VersionedList(str(listed), feed.path("ck") + "/list", clock=lambda: clock[0])
    listed.unlink()
    assert values(spark.read.text(versions.at(spark, 1))) == [("1",)]
    assert values(spark.read.text(versions.at(spark, 2))) == [("2",)]
    rows = filters.filtered(feed.path("kept")).rows(spark)
    assert rows.select("hour").distinct().count() == 3
    for _ in range(2):
        reports.write_hours(rows, feed.path("hours"))
    assert values(spark.read.text(feed.path("hours")), "value") == kept


def test_conversions_counted_once_over_micro_batches(spark, feed):
    record = {"click_id": "c", "conv_timestamp": MIDNIGHT, "forwarded": 1, "timezone": 0}
    feed.send(record, record, {**record, "click_id": "d"})
    feed.send(record, {**record, "click_id": ""}, {**record, "click_id": ""})
    run(feed, "conversion", once_within="1 day")
    feed.send({**record, "click_id": "d"}, {**record, "click_id": "e"})
    run(feed, "conversion", once_within="1 day")
    assert values(totals(spark, feed, "conversion").where("scope = 'gmt'"), "gross_cnt") == [(4,)]
    # Long after its time a click id counts again.
    feed.send({**record, "conv_timestamp": MIDNIGHT + 9 * 86400})
    feed.send({**record, "conv_timestamp": MIDNIGHT + 9 * 86400 + 1, "click_id": "z"})
    feed.send({**record, "conv_timestamp": MIDNIGHT + 9 * 86400 + 2})
    run(feed, "conversion", once_within="1 day")
    assert totals(spark, feed, "conversion").where("scope = 'gmt'").agg(F.sum("gross_cnt")).first()[0] == 6
    with pytest.raises(ValueError):
        streams.start("click", feed.messages(), feed.path("x"), feed.path("y"), once_within="1 day")


def test_sliding_window_stream_equals_the_batch(spark, feed):
    rows = [click_record(ip, MIDNIGHT + s, 0.0, gaid="{gaid}", idfa="i") for ip, s in
            (("a", 0), ("a", 19), ("a", 20), ("b", 59), ("a", 61))]
    feed.send(*rows[:3])
    feed.send(*rows[3:])
    run(feed, "click-watch")
    keys = ["window_start", "kind", "key"]
    last = totals(spark, feed, "click-watch")
    batch = filters.click_watch(logs.filled(spark.createDataFrame(
        [tuple(r.get(n) for n in schemas.CLICK.fieldNames()) for r in rows], schemas.CLICK), schemas.CLICK))
    assert values(last, *keys, "cnt") == values(batch, *keys, "cnt")


def test_stream_and_batch_share_results(spark, feed):
    rows = [click_record(f"ip{i % 5}", MIDNIGHT + i * 60, [0.0, 5.5][i % 2], aff_id=i % 3) for i in range(90)]
    feed.send(*rows)
    run(feed, "click-unique")
    last = totals(spark, feed, "click-unique")
    batch = click.daily_by_scope(logs.filled(spark.createDataFrame(
        [tuple(r.get(n) for n in schemas.CLICK.fieldNames()) for r in rows], schemas.CLICK), schemas.CLICK))
    columns = ["scope", "dated", "aff_id", "gross_cnt", "uniq_cnt"]
    assert values(last, *columns) == values(batch, *columns)


def published(feed, job):
    sent = []
    emit = streams.publisher(job, lambda df: sent.append([r[0] for r in values(df, "value")]))
    run(feed, job, emit=emit)
    return [messages_ for messages_ in sent if messages_]


def test_click_messages(spark, feed):
    feed.send(click_record(campaign_id=4), click_record(campaign_id=4))
    feed.send(click_record(campaign_id=4))
    tail = "4<;>0<;>0<;><;><;>0<;>0<;><;><;><;><;>0<;>"
    assert published(feed, "click") == [
        [f"click<;>-8.0<;>2024-01-09<;>{tail}{n}", f"click<;>2024-01-10<;>{tail}{n}"] for n in (2, 1)]


def test_event_messages_carry_the_growth(spark, feed):
    record = {"click_id": "c", "event_timestamp": MIDNIGHT, "install_timestamp": MIDNIGHT, "kpi": 2, "timezone": 0}
    feed.send(record)
    feed.send(record, {**record, "click_id": "d"})
    first, second = published(feed, "event")
    key = "2024-01-10<;>0<;>0<;>0<;><;>0<;><;>0"
    assert [m for m in first if not m.startswith("0.0")] == sorted([
        f"{key}<;>1<;>1<;>0.0000", f"{key}<;>1.0000", f"{key}<;>1<;>1<;>1<;>1<;>1"])
    assert [m for m in second if not m.startswith("0.0")] == sorted([
        f"{key}<;>2<;>1<;>0.0000", f"{key}<;>1.0000", f"{key}<;>1<;>1<;>1<;>1<;>1"])


def test_conversion_messages(spark, feed):
    feed.send({"conv_timestamp": MIDNIGHT, "invalid_type": "E002", "net_profit": 1.5, "timezone": 5.5})
    (sent,) = published(feed, "conversion")
    assert "5.5<;>2024-01-10<;>0<;>0<;>0<;><;>E002<;>0<;>1<;>0<;>0<;>0.0000<;>0.0000" in sent
    assert "2024-01-10<;>0<;>0<;>0<;><;>0<;>1<;>0<;>0<;>1.5000<;>0.0000" in sent
    assert "2024-01-10<;>0<;>0<;>0<;><;>0.00<;><;>0.00<;><;>0<;>1<;>0<;>0<;>0.0000<;>0.0000" in sent
    assert len(sent) == 5


def test_every_job_runs_and_publishes(spark, tmp_path):
    for job in streams.RECORDS:
        base = tmp_path / job
        base.mkdir()
        feed = Feed(spark, base)
        feed.send({"option": {}, "clk_timestamp": 1, "clickts": 1})
        source = feed.messages().withColumn("topic", F.lit("clks"))
        sent = []
        emit = streams.publisher(job, lambda df: sent.extend(values(df)))
        for query in streams.start(job, source, feed.path("out"), feed.path("ck"), NOW, emit):
            query.awaitTermination()
        assert sent, job
