import datetime as dt

import pytest
from pyspark.sql import functions as F

from adtally import __main__ as cli
from adtally import grains, schemas
from adtally.operators import click, fraud, merge, reconcile, records
from adtally.plans import audit, daily
from adtally.sinks import reports, tables
from adtally.sources import logs, sample
from tests.conftest import values

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
KEYS = ["dated", "k"]
LAYOUT = "dated date, k string, n long, m double"


@pytest.fixture()
def old_new(frame):
    return (frame([(D1, "a", 1, 0.1), (D1, "b", 5, 0.2)], LAYOUT),
            frame([(D1, "b", 3, 0.1), (D2, "c", 4, 0.4)], LAYOUT))


def test_merges(old_new):
    old, new = old_new
    assert values(merge.replace(old, new, KEYS)) == [(D1, "a", 1, 0.1), (D1, "b", 3, 0.1), (D2, "c", 4, 0.4)]
    added = merge.increment(old, new, KEYS, ["n"], ["m"]).withColumn("m", F.col("m").cast("double"))
    assert values(added) == [(D1, "a", 1, 0.1), (D1, "b", 8, 0.3), (D2, "c", 4, 0.4)]
    assert values(merge.greatest(old, new, KEYS, ["n"]), "k", "n") == [("a", 1), ("b", 5), ("c", 4)]


def test_stack_pads_missing_measures(frame):
    left = frame([("x", 1)], "k string, a long")
    right = frame([("x", 2), ("y", 3)], "k string, b long")
    assert values(merge.stack([left, right], ["k"], ["a", "b"])) == [("x", 1, 2), ("y", 0, 3)]


def test_replacing_a_day_is_idempotent(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    layout = "dated date, unionk string, n long"
    tables.replace_days(frame([(D1, "a", 1), (D2, "b", 2)], layout), path)
    for _ in range(2):
        tables.replace_days(frame([(D2, "b", 7)], layout), path)
    assert values(spark.read.parquet(path), "dated", "unionk", "n") == [(D1, "a", 1), (D2, "b", 7)]


def test_replaying_a_batch_counts_once(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    layout = "k string, n long"
    tables.add_batch(frame([("a", 1), ("b", 2)], layout), path, 0)
    for _ in range(3):
        tables.add_batch(frame([("a", 10)], layout), path, 1)
    assert values(tables.read_increments(spark, path, ["k"], ["n"])) == [("a", 11), ("b", 2)]
    assert values(tables.read_latest(spark, path, ["k"], ["n"])) == [("a", 10), ("b", 2)]


def test_registered_tables_know_their_days(spark, frame, tmp_path):
    path, name = str(tmp_path / "t"), "known_days"
    layout = "dated date, n long"
    tables.replace_days(frame([(D1, 1), (D2, 2)], layout), path)
    tables.register(spark, name, path)
    assert values(spark.table(name), "dated", "n") == [(D1, 1), (D2, 2)]
    # A rerun empties one day and writes another; the catalog follows when told.
    tables.replace_days(frame([(D2, 3)], layout), path, [D1, D2])
    tables.register(spark, name, path, [D1, D2])
    assert values(spark.sql(f"SHOW PARTITIONS {name}")) == [(f"dated={D2}",)]
    assert values(spark.table(name), "dated", "n") == [(D2, 3)]
    plan = spark.table(name).where(F.col("dated") == F.lit(D2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dated" in plan
    tables.drop_days(spark, name, [D2])
    assert spark.table(name).count() == 0 and not (tmp_path / "t" / f"dated={D2}").exists()
    tables.drop(spark, name)
    assert not spark.catalog.tableExists(name)


def test_summary_reads_tables_by_name(spark, sf, tmp_path):
    events = sample.table(spark, sf, "events")
    days = [dt.date(2024, 1, d) for d in (2, 3)]
    daily.clicks(spark, sample.click_log(events), str(tmp_path), days)
    assert "gmt_daily_clicks" in daily.register(spark, str(tmp_path), "by_name", days)
    daily.wide_summaries(spark, str(tmp_path), days, "by_name")
    by_name = values(spark.read.parquet(f"{tmp_path}/gmt_daily_summary"), "unionk", "gross_clk_cnt")
    daily.wide_summaries(spark, str(tmp_path), days)
    assert values(spark.read.parquet(f"{tmp_path}/gmt_daily_summary"), "unionk", "gross_clk_cnt") == by_name != []
    spark.sql("DROP DATABASE by_name CASCADE")


def test_a_table_is_worked_out_once_for_each_write(spark, frame, tmp_path):
    """Days that were not written are found from their files, not by reading the frame again."""
    path, runs = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    tables.replace_days(frame([(D1, 1), (D2, 2)], "dated date, n long"), path)
    tables.replace_days(frame([(D2, 5)], "dated date, n long").mapInArrow(seen, "dated date, n long"), path, [D1, D2])
    assert values(spark.read.parquet(path), "dated", "n") == [(D2, 5)] and runs.value == 1


def test_jdbc_options():
    assert tables.jdbc_options("jdbc:x", "t")["batchsize"] == "1000"
    assert reports.kafka_writer_options("h:1", "t")["topic"] == "t"


def test_reconciliation_flags(frame):
    detail = frame([(D1, 1), (D1, 2), (D2, 9)], "dated date, gross_cnt long")
    summary = frame([(D1, 3), (dt.date(2024, 1, 3), 1)], "dated date, gross_clk_cnt long")
    assert values(reconcile.check(detail, summary, reconcile.CLICK, "gmt")) == [(D1, 1)]
    assert values(reconcile.check(detail, summary, reconcile.CLICK, "gmt", missing_days=True)) == [
        (D1, 1), (D2, 0), (dt.date(2024, 1, 3), 0)]
    wrong = frame([(D1, 4)], "dated date, gross_clk_cnt long")
    assert values(reconcile.check(detail, wrong, reconcile.CLICK, "gmt")) == [(D1, 0)]


def test_event_messages(frame):
    fine = frame([(1, 92, 5.5, D1, D2, 1, 2, 3, "p", 4, "USD", 0, 10, 6, 2.5),
                  (40, 1, 5.5, D1, D2, 1, 2, 3, "", 4, "USD", 0, 10, 6, 2.5),
                  (40, 10, 5.5, D1, D2, 1, 2, 3, "q", 4, "USD", 0, 10, 6, 2.5)],
                 "retent_days int, kpi int, timezone double, install_day date, event_day date, campaign_id int, "
                 "group_id int, aff_id int, aff_pub string, event_value int, currency string, algorithm int, "
                 "gross_cnt long, uniq_cnt long, total_amount double")
    assert values(records.event_records(fine, "adx")) == sorted([
        ("counts", "5.5<;>2024-01-02<;>1<;>2<;>3<;>p<;>4<;>USD<;>0<;>10<;>6<;>2.5000"),
        ("kpi", "5.5<;>2024-01-01<;>1<;>2<;>3<;>p<;>4<;>USD<;>0<;>6.0000"),
        ("retention", "5.5<;>2024-01-01<;>1<;>2<;>3<;>p<;>4<;>USD<;>0<;>0<;>6<;>6<;>6<;>6"),
        ("counts", "5.5<;>2024-01-02<;>1<;>2<;>3<;><;>4<;>USD<;>0<;>10<;>6<;>2.5000"),
        ("kpi", "5.5<;>2024-01-02<;>1<;>2<;>3<;><;>4<;>USD<;>0<;>10.0000"),
        ("counts", "5.5<;>2024-01-02<;>1<;>2<;>3<;>q<;>4<;>USD<;>0<;>10<;>6<;>2.5000"),
    ])


def test_conversion_detail_defaults(spark):
    log = spark.createDataFrame([tuple([None] * len(schemas.CONVERSION))], schemas.CONVERSION)
    value = records.conversion_detail(log).first()["value"]
    assert value == "<;>0<;>0<;>0<;>0<;><;>0.0<;><;>0.0<;><;>0<;><;><;><;><;>0<;>0"


def test_tagged_summary_record(frame):
    row = frame([(D1, 1, 2, 3, "p", 4, 9)],
                "dated date, campaign_id int, group_id int, aff_id int, aff_pub string, algorithm int, n long")
    out = records.summary_records(row, "gmt", grains.SUMMARY, ["n"], tag="click")
    assert values(out) == [("click<;>2024-01-01<;>1<;>2<;>3<;>p<;>4<;>9",)]


DAYS = [dt.date(2024, 1, d) for d in (9, 10, 11)]


@pytest.fixture(scope="module")
def written(spark, sf, tmp_path_factory):
    """All daily jobs over three days, the event and click job twice."""
    out = str(tmp_path_factory.mktemp("out"))
    events = sample.table(spark, sf, "events")
    daily.clicks(spark, sample.click_log(events), out, DAYS)
    daily.conversions(spark, sample.conversion_log(events), out, DAYS)
    daily.events(spark, sample.event_log(events), out, DAYS)
    daily.impressions(spark, sample.impression_log(events), out, DAYS)
    daily.impressions(spark, sample.impression_log(events), out, DAYS, "clk")
    daily.events(spark, sample.event_log(events), out, DAYS[1:2])
    daily.clicks(spark, sample.click_log(events), out, DAYS[:1])
    daily.wide_summaries(spark, out)
    return out


def test_jobs_write_the_wanted_days(spark, sf, written):
    log = sample.click_log(sample.table(spark, sf, "events"))
    for scope in grains.SCOPES:
        df = spark.read.parquet(f"{written}/{scope}_clk_daily_summary")
        assert [r[0] for r in values(df.select("dated").distinct())] == DAYS
    start = int(dt.datetime(2024, 1, 9, tzinfo=dt.timezone.utc).timestamp())
    expected = log.where((F.col("clk_timestamp") >= start) & (F.col("clk_timestamp") < start + 3 * 86400)).count()
    gmt = spark.read.parquet(f"{written}/gmt_clk_daily_summary")
    assert gmt.agg(F.sum("gross_cnt")).first()[0] == expected


@pytest.mark.parametrize("days", [[D1], [D1, D2]])
def test_a_day_emptied_by_a_rerun_is_cleared(spark, frame, tmp_path, days):
    path, batches = str(tmp_path / "t"), str(tmp_path / "b")
    rows = frame([(D1, "a", 1), (D2, "b", 2)], "dated date, name string, n long")
    added = rows.withColumn(tables.BATCH, F.col("dated"))
    tables.replace_days(rows, path, [D1, D2])
    tables.add_batches(added, batches, [D1, D2])
    tables.replace_days(rows.where(F.col("dated") != F.lit(D1)).where(F.col("dated").isin(days)), path, days)
    tables.add_batches(added.where(F.col(tables.BATCH) != F.lit(D1)).where(F.col(tables.BATCH).isin(days)), batches, days)
    assert values(spark.read.parquet(path), "name") == [("b",)]
    assert values(spark.read.parquet(batches), "name") == [("b",)]


def test_detail_adds_up_to_the_wide_summary(spark, written, tmp_path):
    report = str(tmp_path / "report")
    audit.reconciliation(spark, written, report, DAYS)
    lines = [r[0] for r in spark.read.text(report).collect()]
    # click, conversion and kpi lines, per day for gmt and per day and offset for adx
    assert len([x for x in lines if x.startswith("gmt_click_check")]) == 3
    for line in lines:
        assert set(line.split(",")[3 if line.startswith("adx") else 2:]) == {"1"}, line


def test_only_ended_days_are_checked(spark, written, tmp_path):
    midnight = int(dt.datetime(2024, 1, 11, tzinfo=dt.timezone.utc).timestamp())
    assert audit.rolled_over(midnight + 60, midnight - 60) == {0.0: DAYS[1]}
    assert audit.rolled_over(midnight - 5 * 3600, midnight - 6 * 3600) == {5.5: DAYS[1], 5.0: DAYS[1]}
    assert audit.rolled_over(midnight + 60, midnight + 1) == {}
    report = str(tmp_path / "report")
    audit.check_finished_days(spark, written, report, {0.0: DAYS[1], 5.5: DAYS[0]})
    lines = sorted(r[0].rsplit(",", 1)[0] for r in spark.read.text(report).collect())
    assert "gmt_click_check,2024-01-10" in lines and "adx_click_check,0.0,2024-01-10" in lines
    assert "adx_click_check,5.5,2024-01-09" in lines
    assert not [x for x in lines if ",5.5,2024-01-10" in x]


def test_unique_tuples_job(spark, sf, tmp_path):
    log = logs.filled(sample.click_log(sample.table(spark, sf, "events")), schemas.CLICK)
    daily.clicks(spark, log, str(tmp_path), DAYS[:1], by_tuple=True)
    expected = click.daily_two_step(log, "gmt").where(F.col("dated") == F.lit(DAYS[0]))
    got = spark.read.parquet(f"{tmp_path}/gmt_clk_daily_summary")
    assert values(got, "unionk", "uniq_cnt") == values(expected, "unionk", "uniq_cnt")


def test_a_batch_that_leaves_a_day_is_gone_from_it(spark, frame, tmp_path):
    path = str(tmp_path)
    rows = frame([(D1, D2, 1), (D2, D2, 2), (D1, D1, 4)], f"dated date, {tables.BATCH} date, n long")
    tables.add_batches(rows, path, [D1, D2])
    tables.add_batches(rows.where("n = 2"), path, [D2])
    assert values(spark.read.parquet(path), "n") == [(2,), (4,)]


def test_summary_reads_the_folders_of_its_days_only(spark, written):
    for table in ("gmt_daily_kpi", "adx_event_retention"):
        df = logs.read_summary(spark, f"{written}/{table}", DAYS[:1])
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(dated" in plan or "PartitionFilters: [dated" in plan
        files = df.select(F.input_file_name().alias("f")).distinct().collect()
        assert files and all("dated=2024-01-09" in r["f"] for r in files)


def test_event_day_replay_changes_nothing(spark, sf, written, tmp_path):
    once = str(tmp_path)
    daily.events(spark, sample.event_log(sample.table(spark, sf, "events")), once, DAYS)
    daily.wide_summaries(spark, once)
    for name in ("gmt_event_daily_summary", "adx_event_daily_summary"):
        a = spark.read.parquet(f"{written}/{name}")
        b = spark.read.parquet(f"{once}/{name}").select(*a.columns)
        assert values(a) == values(b)


def test_retention_lands_on_install_days(spark, written):
    df = spark.read.parquet(f"{written}/gmt_event_daily_summary")
    assert df.where(F.col("dated") < DAYS[0]).agg(F.sum("in30_retention_cnt")).first()[0] > 0
    assert df.where(F.col("dated") < DAYS[0]).agg(F.sum("gross_cnt")).first()[0] == 0


def test_impression_parts_share_a_row(spark, written):
    df = spark.read.parquet(f"{written}/gmt_impression_daily_summary")
    assert df.where("gross_imp_cnt != gross_clk_cnt or uniq_imp_cnt != uniq_clk_cnt").count() == 0


def test_demand_job(spark, sf, tmp_path):
    log = sample.demand_log(*[sample.table(spark, sf, t) for t in ("lineitem", "supplier", "part")])
    days = [dt.date(2018, 4, d) for d in range(1, 31)]
    daily.demands(spark, log, str(tmp_path), days)
    total = spark.read.parquet(f"{tmp_path}/gmt_demand_daily_summary").agg(F.sum("clks")).first()[0]
    assert total == log.count()
    supply = spark.read.parquet(f"{tmp_path}/gmt_supply_daily_summary").agg(F.sum("clks")).first()[0]
    assert supply == total


def test_fraud_reports(spark, sf, tmp_path):
    events = sample.table(spark, sf, "events")
    click = sample.click_log(events).withColumn("ip", F.lit("10.0.0.1"))
    audit.hourly_fraud(spark, click, sample.event_log(events).withColumnRenamed("event_timestamp", "clk_timestamp"),
                       str(tmp_path), more_than=1)
    audit.conversion_fraud(spark, sample.conversion_log(events), click, str(tmp_path))
    for name in ("click_analysis_ip", "event_analysis_aff", "conv_analysis_ip", "conv_analysis_ip_clk_time",
                 "conv_analysis_ip_clk_count"):
        assert spark.read.csv(f"{tmp_path}/{name}").count() > 0
    # The job counts the filled log: an absent publisher is an empty one, which a CSV file shows as "".
    hours = fraud.hourly_counts(logs.filled(click, schemas.CLICK_FRAUD), ["aff_id", "aff_pub"], more_than=1)
    written_hours = spark.read.option("nullValue", "\0").option("emptyValue", "").csv(f"{tmp_path}/click_analysis_aff")
    assert values(written_hours.na.fill("")) == sorted(tuple(str(v) for v in row) for row in values(hours))
    lines = spark.read.text(f"{tmp_path}/click_analysis_aff").where(F.col("value").contains(',"",'))
    assert lines.count() == hours.where("aff_pub = ''").count() > 0


def test_command_line():
    args = cli.parser().parse_args(
        ["click", "--log", "/logs/c-{day}", "--out", "/o", "--start-date", "2024-01-01", "--end-date", "2024-01-02"])
    assert args.start_date == D1 and args.job == "click"
    args = cli.parser().parse_args(["stream", "demand", "--servers", "h:1", "--out", "/o", "--checkpoint", "/c", "--topics", "x_clks,x_imps"])
    assert args.seconds == 20
