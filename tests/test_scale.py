"""What keeps the work of a task and the shuffled data in proportion to the input."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adtally import catalog, grains, schemas
from adtally.operators import demand, rollup
from adtally.operators.rollup import SCOPE, by_hash
from adtally.plans import streams
from adtally.sinks.ledger import Merge
from adtally.sources import sample
from adtally.streaming import rollups
from tests.conftest import values

NOON = 1_700_049_600


def plan(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def shuffles(df) -> list[str]:
    return [line for line in plan(df) if "Exchange hashpartitioning" in line]


@pytest.fixture()
def demand_log(spark):
    """Two visitors of one grain, one of them twice, and one of another; some keys null."""
    rows = [(8.0, "R", "b1", "x", 1.5), (8.0, "R", "b1", "x", 0.25), (8.0, "R", "b1", "y", None),
            (None, "A", None, "x", 2.0)]
    given = {"tz": "tz", "demand": "demand", "cid": "cid", "dcost": "dcost"}
    df = spark.createDataFrame(rows, "tz double, demand string, cid string, ip string, dcost double")

    def field(f):
        if f.name in given:
            return F.col(given[f.name]).cast(f.dataType)
        if f.name == "device":
            return F.struct(*[(F.col("ip") if d.name == "ip" else F.lit(None)).cast(d.dataType).alias(d.name)
                              for d in f.dataType.fields])
        return F.lit(NOON if f.name in ("clickts", "pixelts") else None).cast(f.dataType)

    out = df.select(*[field(f).alias(f.name) for f in schemas.DEMAND.fields])
    return spark.createDataFrame(out.collect(), out.schema)  # constants would be left out of the plan


@pytest.mark.parametrize("parts", [None, 3])
def test_demand_of_both_scopes_is_shuffled_once_before_it_is_fanned_out(demand_log, parts):
    out = demand.daily_by_scope(demand.flatten(demand_log), parts)
    assert len(shuffles(out)) == 1
    lines = plan(out)
    at = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line or "Generate explode" in line]
    assert "Generate" in lines[at[0]]
    got = out.select("scope", "campaign_id", "clks", "uniq_clks", F.col("cost").cast("double"))
    assert Counter(map(tuple, got.collect())) == Counter(
        (s, *rest) for s in ("adx", "gmt") for rest in [("b1", 3, 2, 1.75), ("", 1, 1, 2.0)])


@pytest.mark.parametrize("scope", grains.SCOPES)
def test_demand_of_a_scope_is_shuffled_once(demand_log, scope):
    out = demand.daily(demand.flatten(demand_log), scope, 3)
    assert len(shuffles(out)) == 1
    assert values(out, "campaign_id", "clks", "uniq_clks") == [("", 1, 1), ("b1", 3, 2)]


def test_demand_sketches_are_shuffled_before_they_are_fanned_out(demand_log):
    rows = demand_log.withColumn("topic", F.concat_ws("_", F.nullif("demand", "demand"), F.lit("clks")))
    totals = rollups.MERGES["demand"].totals(rollups.demand_totals(rows, 3))
    lines = plan(totals)
    at = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line or "Generate explode" in line]
    assert len(shuffles(totals)) == 1 and "Generate" in lines[at[0]]
    assert values(totals, "scope", "campaign_id", "gross_cnt", "uniq_cnt") == [
        ("adx", "", 1, 1), ("adx", "b1", 3, 2), ("gmt", "", 1, 1), ("gmt", "b1", 3, 2)]


def test_demand_table_is_sorted_and_added_up_once(spark, demand_log, tmp_path):
    """Neither the part of a batch nor the totals hash groups, or add them up in two steps; no row is shuffled twice."""
    rows = demand_log.withColumn("topic", F.concat_ws("_", F.nullif("demand", "demand"), F.lit("clks")))
    ledger = streams.table("demand", str(tmp_path))
    monitored = {}
    write = ledger._write
    ledger._write = lambda part, name: (monitored.__setitem__("part", plan(part)), write(part, name))
    for batch_id in range(2):
        ledger.add(streams.JOBS["demand"][1](rollups.demand_fields(rows)), batch_id)
    totals = ledger.totals(spark)
    monitored["totals"] = plan(totals)
    for lines in monitored.values():
        assert len([line for line in lines if "Exchange" in line]) == 1
        assert [line.split("Aggregate")[0].split()[-1] for line in lines if "Aggregate(" in line] == ["Sort"]
    assert values(totals, "scope", "campaign_id", "gross_cnt", "uniq_cnt") == [
        ("adx", "", 2, 1), ("adx", "b1", 6, 2), ("gmt", "", 2, 1), ("gmt", "b1", 6, 2)]


def test_demand_table_has_few_files_where_small_tasks_are_not_merged(spark, demand_log, tmp_path):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    rows = demand_log.withColumn("topic", F.lit("x_clks")).crossJoin(spark.range(40)).withColumn(
        "cid", F.concat("cid", F.col("id").cast("string"))).drop("id")
    spark.conf.set(name, "false")
    try:
        ledger = streams.table("demand", str(tmp_path))
        ledger.add(rollups.demand_part(rollups.demand_fields(rows).repartition(7)), 0)
        assert len(list(tmp_path.glob("data/part=*/dated=*/*.parquet"))) == len(list(tmp_path.glob("data/part=*/dated=*")))
        assert values(ledger.totals(spark).groupBy("scope").agg(F.sum("gross_cnt"))) == [("adx", 160), ("gmt", 160)]
    finally:
        spark.conf.set(name, "true")


@pytest.mark.parametrize("dims", [("a", "b"), ("", ""), (None, "b"), ("a\x1f", None), ("a\x1fb", "c"), ("a", "b\x1fc"),
                                  (None, None), ("\x1f", "")])
def test_dimensions_are_unpacked_as_they_were(spark, dims):
    rows = spark.createDataFrame([(*dims, 7), (*dims, None)], "a string, b string, n int")
    got = rollup.unpacked(rollup.packed(rows, ["a", "n", "b"]), ["a", "n", "b"]).select("a", "b", "n")
    assert sorted(got.collect(), key=str) == sorted(rows.collect(), key=str) and got.dtypes == rows.dtypes


def test_sketches_are_sorted_by_the_hash_of_their_keys(spark):
    rows = spark.createDataFrame([("a", None, "v"), ("a", None, "w"), ("b", 1, "v")], "k string, n int, v string")
    out = rows.groupBy(*by_hash("k", "n")).agg(F.count("*").alias("cnt")).drop("_hash")
    assert sorted(map(tuple, out.collect())) == [("a", None, 2), ("b", 1, 1)]


def test_parts_are_not_added_up_before_the_shuffle(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 4), (None, 8)], "k string, cnt long")
    merged = Merge(["k"], ["cnt"]).merged(rows)
    lines = plan(merged)
    shuffle = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert not [line for line in lines[shuffle:] if "Aggregate" in line]
    assert Counter(map(tuple, merged.collect())) == Counter([("a", 3), (None, 12)])


@pytest.fixture()
def events(spark, tmp_path):
    """A thousand clicks of some visitors; half of the click ids come twice."""
    n = F.col("id")
    start = F.lit(dt.datetime(2024, 1, 10))
    spark.range(1000).select(
        n.alias("event_id"), (start + F.make_dt_interval(secs=n * 60)).cast("timestamp_ntz").alias("ts"),
        (n % 50).alias("user_id"), F.lit("click").alias("event_type"), n.cast("double").alias("value"),
        F.format_string('{"k": %d}', n % 40).alias("props")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def delivered(spark, monkeypatch, tmp_path, name, sf):
    """The rows of a query and the sizes of the files its stream read."""
    monkeypatch.setattr(catalog, "work_dir", lambda spark, n: f"{tmp_path}/work")
    out = catalog.run(name, spark, sf).collect()
    files = spark.read.schema(sample.EVENTS_SCHEMA).parquet(f"{tmp_path}/work/files").select(
        F.col("_metadata.file_path").alias("f")).groupBy("f").count().collect()
    return out, [r["count"] for r in files]


def test_every_core_reads_a_part_of_the_restarted_stream(spark, monkeypatch, tmp_path, events):
    out, files = delivered(spark, monkeypatch, tmp_path, "stream_click_restarted", events)
    cores = spark.sparkContext.defaultParallelism
    assert len(files) == catalog.PARTS * cores and sum(files) == 1000 and max(files) < 3 * 1000 / len(files)
    assert {s: sum(r["gross_cnt"] for r in out if r["scope"] == s) for s in ("adx", "gmt")} == {"adx": 1000, "gmt": 1000}
    assert len({tuple(r[c] for c in [*SCOPE, *grains.CLICK]) for r in out}) == len(out)


def test_every_core_reads_a_part_of_each_delivery(spark, monkeypatch, tmp_path, events):
    out, files = delivered(spark, monkeypatch, tmp_path, "stream_conv_once", events)
    assert len(files) == 2 * spark.sparkContext.defaultParallelism and sum(files) == 2000
    wanted = {"" if n % 40 % 20 == 0 else f"{n % 50}-{n % 40}" for n in range(1000)}
    assert Counter(r["click_id"] for r in out) == Counter(wanted) and {r["gross_cnt"] for r in out} == {1}


def test_only_what_a_rollup_needs_crosses_into_its_micro_batches(spark, tmp_path, monkeypatch):
    """The demand streams of tiny tables: columns staged, columns of a micro-batch, and its share of compiled code."""
    line = F.col("id")
    spark.range(40).select(
        line.alias("l_orderkey"), (line % 4).alias("l_partkey"), (line % 2).alias("l_suppkey"),
        (line % 7 + 1).cast("int").alias("l_linenumber"), line.cast("double").alias("l_quantity"),
        line.cast("double").alias("l_extendedprice"), F.lit(0.5).alias("l_tax"), F.lit("R").alias("l_returnflag"),
        F.lit(dt.datetime(2024, 1, 10)).cast("timestamp_ntz").alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(2).select(line.alias("s_suppkey"), line.cast("int").alias("s_nationkey")).write.parquet(
        f"{tmp_path}/supplier.parquet")
    spark.range(4).select(line.alias("p_partkey"), F.lit(1).alias("p_size")).write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(catalog, "work_dir", lambda spark, n: f"{tmp_path}/work/{n}")
    limit, seen = "spark.sql.codegen.hugeMethodLimit", {}
    before = spark.conf.get(limit, None)

    def watched(job, rollup):
        def inner(batch):
            seen[job] = batch.columns, batch.sparkSession.conf.get(limit)
            return rollup(batch)
        return inner

    for job in ("supply", "demand"):
        schema, rollup = streams.JOBS[job]
        monkeypatch.setitem(streams.JOBS, job, (schema, watched(job, rollup)))
    out = catalog.run("stream_supply", spark, str(tmp_path))
    assert sum(r["gross_cnt"] for r in out.collect()) == 40
    staged = spark.read.parquet(f"{tmp_path}/work/lineitem-files").columns
    assert "l_tax" not in staged and "l_shipdate" in staged
    assert seen["supply"] == (["kind", "epoch", *grains.SUPPLY, "revenue"], "8000")
    monkeypatch.setattr(catalog, "work_dir", lambda spark, n: f"{tmp_path}/again/{n}")
    out = catalog.run("stream_demand", spark, str(tmp_path))
    assert {s: sum(r["gross_cnt"] for r in out.collect() if r["scope"] == s) for s in ("adx", "gmt")} == {
        "adx": 40, "gmt": 40}
    assert seen["demand"] == (["timezone", "epoch", "kind", *grains.DEMAND, "uv", "cost"], "8000")
    assert spark.conf.get(limit, None) == before
