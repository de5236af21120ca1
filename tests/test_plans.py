"""What the plans must and must not contain."""

from pyspark.sql import functions as F

from adtally.catalog import run
from adtally.operators import click, conversion
from adtally import schemas
from adtally.sources import logs, sample

def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clicks_read_only_what_they_need(spark, sf):
    plan = physical(run("click_daily_adx", spark, sf))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,props:string>" in plan


def test_distinct_counts_shuffle_by_visitor_first(spark, sf):
    plan = physical(click.daily(click.project(sample.click_log(sample.table(spark, sf, "events"))), "adx"))
    exchanges = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert len(exchanges) == 2 and "visitor" in exchanges[1] and "visitor" not in exchanges[0]


def test_dedup_combines_before_the_shuffle_and_sorts_no_log(spark, sf):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unique = conversion.dedup(logs.filled(sample.conversion_log(sample.table(spark, sf, "events")), schemas.CONVERSION))
        unique.collect()
        plan = physical(unique)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    final = plan[:plan.find("== Initial Plan ==")]
    assert "partial_min" in final and "Window" not in final
    # The earliest seconds are hashed; what is sorted are the records left after the join.
    assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final
    below = final[final.index("ShuffledHashJoin"):]
    assert "Sort [" not in below and "SortAggregate" not in below


def test_a_hot_blank_click_id_counts_once(spark):
    """A third of all records share the blank id."""
    log = sample.conversion_log(
        spark.range(6000).select(
            F.col("id").alias("event_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"),
            F.col("id").alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.0).alias("value"),
            F.concat(F.lit('{"k": '), F.when(F.col("id") % 3 == 0, 20).otherwise(7).cast("string"), F.lit("}"))
            .alias("props")))
    assert log.where("click_id = ''").count() == 2000
    unique = conversion.dedup(log)
    assert unique.where("click_id = ''").count() == 1
    assert unique.count() == 4001
