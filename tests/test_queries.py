"""Every query over the logs against its SQL on the smallest tables; the corpus operators have tests of their own."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from adtally.catalog import QUERIES
from checks.compare import compare
from checks.oracle import ORACLE

FAST = [q for q in ORACLE if not q.startswith("stream_")]
#: Estimates have no SQL.
ESTIMATED = {"uniq_reach"}


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES) - ESTIMATED
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_the_log_grows_with_its_tables(spark):
    counts = [queries()["click_daily_gmt"](spark, f"/root/testdata/{sf}").count() for sf in ("sf0.001", "sf0.01")]
    assert counts[1] > 5 * counts[0]


def test_reach_of_the_sketches(spark):
    """One affiliate has more visitors than a sketch has registers; three standard errors are 4.9 %."""
    rows = queries()["uniq_reach"](spark, "/root/testdata/sf0.1").collect()
    assert max(r["exact_uniq_cnt"] for r in rows) > 10_000
    assert all(abs(r["uniq_cnt"] - r["exact_uniq_cnt"]) <= max(1, 0.049 * r["exact_uniq_cnt"]) for r in rows)


# Plan nodes no query may need.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas",
            "CollectLimit", "ExistingRDD")


@pytest.mark.parametrize("name", FAST)
def test_query_equals_its_sql(spark, sf, name):
    df = queries()[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    assert compare(spark, sf, name, df) is None


@pytest.mark.parametrize("name", ["stream_event_old", "stream_demand", "stream_click", "stream_growth"])
def test_stream_equals_its_sql(spark, sf, name):
    assert compare(spark, sf, name) is None
