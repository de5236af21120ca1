import datetime as dt
import json

from pyspark.sql import functions as F

from adtally import __main__ as cli
from adtally import schemas, session
from tests.conftest import values


def test_partitions_follow_the_input():
    assert session.partitions_for(0, 8) == 8
    assert session.partitions_for(10 * 2**40, 1000) == 40960
    assert session.partitions_for(100 * 2**40, 1000) == 409600


def test_work_dir_lies_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = session.work_dir(spark, "x"), session.work_dir(spark, "x")
    assert one.startswith(base) and one != two


def test_stage_cuts_the_plan(spark, frame):
    df = frame([(1, "a"), (2, "b")], "n int, s string").withColumn("m", F.col("n") * 2)
    staged = session.stage(spark, df, "t")
    assert values(staged) == values(df)
    assert "parquet" in staged._jdf.queryExecution().executedPlan().toString()


def test_jobs_read_the_files_around_their_days(spark, tmp_path):
    for day in range(8, 13):
        (tmp_path / f"click-202401{day:02d}00").write_text(json.dumps({"campaign_id": day}) + "\n")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    log = cli.read_log(spark, f"{tmp_path}/click-{{day}}", schemas.CLICK, [dt.date(2024, 1, 10)])
    assert values(log, "campaign_id") == [(9,), (10,), (11,)]
    assert session.total_bytes(spark, [f"{tmp_path}/click-20240110*"]) == 20
    spark.conf.set("spark.sql.shuffle.partitions", before)
