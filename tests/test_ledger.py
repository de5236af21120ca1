"""Stream tables: merging, replays, growth, readers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adtally.sinks.ledger import Ledger, Merge
from tests.conftest import values

D1, D2, OLD = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2023, 12, 1)
COUNTS = Merge(["dated", "k"], ["n"])
UNIQUE = Merge(["dated", "k"], ["n"], [], {"seen": "uniq"})


def counted(spark, rows):
    return spark.createDataFrame(rows, "dated date, k string, n bigint")


def visits(spark, rows):
    """(day, key, visitor) as counts with sketches."""
    seen = spark.createDataFrame(rows, "dated date, k string, who string")
    return seen.groupBy("dated", "k").agg(F.count("*").alias("n"), F.hll_sketch_agg("who", F.lit(12)).alias("seen"))


def folders(tmp_path):
    return sorted(p.name for p in (tmp_path / "data").iterdir())


def test_two_hundred_batches_keep_few_folders(spark, tmp_path):
    """The same result before, during and after every merge."""
    ledger, most = Ledger(str(tmp_path), COUNTS, every=6), 0
    first = counted(spark, [(D1, "a", 1), (OLD, "b", 1)])
    later = counted(spark, [(D1, "a", 1), (D2, "b", 2)])
    for batch_id in range(200):
        ledger.compact(spark, batch_id)
        ledger.add(first if batch_id == 0 else later, batch_id)
        most = max(most, len(folders(tmp_path)))
        if batch_id % 6 in (0, 5) and batch_id % 4 == 0 or batch_id == 199:
            assert values(ledger.totals(spark)) == sorted(
                [(D1, "a", batch_id + 1), (OLD, "b", 1)] + [(D2, "b", 2 * batch_id)] * (batch_id > 0))
    # Up to five runs of 6 and of 36 batches, five batches, and what the last merge replaced.
    assert most <= 5 + 5 + 6 + 12
    assert len(list((tmp_path / "manifest").glob("0*"))) <= 2
    assert [(p.first, p.end) for p in ledger.manifest(spark).runs] == [
        (i * 36, i * 36 + 36) for i in range(5)] + [(180, 186), (186, 192), (192, 198)]


def test_a_repeated_batch_counts_once(spark, tmp_path):
    ledger = Ledger(str(tmp_path), COUNTS, every=2)
    for batch_id in range(5):
        for _ in range(2):
            ledger.compact(spark, batch_id)
            ledger.add(counted(spark, [(D1, "a", 10 ** batch_id)]), batch_id)
            assert values(ledger.growth(spark, batch_id)) == [(D1, "a", 10 ** batch_id)]
    assert values(ledger.totals(spark)) == [(D1, "a", 11111)]


def test_merging_again_after_a_failure(spark, tmp_path):
    """A run without its manifest is not seen, and is written again."""
    ledger = Ledger(str(tmp_path), COUNTS, every=2)
    for batch_id in range(2):
        ledger.add(counted(spark, [(D1, "a", 1)]), batch_id)
    keep, ledger._keep = ledger._keep, lambda *a: (_ for _ in ()).throw(OSError())
    with pytest.raises(OSError):
        ledger.compact(spark, 2)
    assert values(ledger.totals(spark)) == [(D1, "a", 2)]
    ledger._keep = keep
    ledger.compact(spark, 2)
    ledger.compact(spark, 2)
    assert values(ledger.totals(spark)) == [(D1, "a", 2)]
    assert [p.name[0] for p in ledger.parts(spark)] == ["r"]


def test_a_reader_keeps_its_files_over_a_merge(spark, tmp_path):
    ledger = Ledger(str(tmp_path), COUNTS, every=2)
    for batch_id in range(2):
        ledger.add(counted(spark, [(D1, "a", 1)]), batch_id)
    before = ledger.totals(spark)
    ledger.compact(spark, 2)
    assert values(before) == [(D1, "a", 2)]


def test_growth_of_unique_counts(spark, tmp_path):
    ledger = Ledger(str(tmp_path), UNIQUE, every=2)
    batches = [[(D1, "a", "x"), (D1, "a", "y"), (D1, None, "x")], [(D1, "a", "x"), (D1, None, "z")],
               [(D2, "a", "x")], [], [(D1, "a", "w"), (D1, "a", "x"), (OLD, "a", "x")]]
    wanted = [[(D1, "a", 2, 2), (D1, None, 1, 1)], [(D1, "a", 1, 0), (D1, None, 1, 1)], [(D2, "a", 1, 1)], [],
              [(OLD, "a", 1, 1), (D1, "a", 2, 1)]]
    total = {}
    for batch_id, (rows, growth) in enumerate(zip(batches, wanted)):
        ledger.compact(spark, batch_id)
        ledger.add(visits(spark, rows), batch_id)
        grown = ledger.growth(spark, batch_id)
        got = [tuple(r) for r in grown.collect()] if grown is not None else []
        assert sorted(got, key=str) == sorted(growth, key=str)
        for day, k, n, uniq in got:
            old = total.get((day, k), (0, 0))
            total[day, k] = (old[0] + n, old[1] + uniq)
    assert {(r.dated, r.k): (r.n, r.uniq) for r in ledger.totals(spark).collect()} == total


def test_growth_is_capped_at_the_records(spark, tmp_path):
    """Two thousand visitors, estimated; a batch of one record never adds more than one."""
    ledger = Ledger(str(tmp_path), UNIQUE)
    ledger.add(visits(spark, [(D1, "a", f"v{i}") for i in range(2000)]), 0)
    for batch_id in range(1, 6):
        ledger.add(visits(spark, [(D1, "a", f"w{batch_id}")]), batch_id)
        (row,) = ledger.growth(spark, batch_id).collect()
        assert row.n == 1 and row.uniq <= 1


def test_growth_of_rows_for_both_scopes(spark, tmp_path):
    """They are told apart before anything is compared."""
    merge = Merge(["scope", "timezone", "dated", "k"], ["n"], [], {"seen": "uniq"}, together=["k"])
    ledger = Ledger(str(tmp_path), merge, every=2)
    batches = [[("both", 8.0, D1, "a", "x"), ("both", 8.0, D1, "a", "y"), ("adx", 8.0, D2, None, "x")],
               [("both", 1.0, D1, "a", "x"), ("adx", 8.0, D1, "a", "z"), ("gmt", None, D1, None, "x")],
               [("both", 8.0, D1, "a", "z")]]
    wanted = [[("adx", 8.0, D1, "a", 2, 2), ("adx", 8.0, D2, None, 1, 1), ("gmt", None, D1, "a", 2, 2)],
              [("adx", 1.0, D1, "a", 1, 1), ("adx", 8.0, D1, "a", 1, 1), ("gmt", None, D1, "a", 1, 0),
               ("gmt", None, D1, None, 1, 1)],
              [("adx", 8.0, D1, "a", 1, 0), ("gmt", None, D1, "a", 1, 1)]]
    for batch_id, (rows, growth) in enumerate(zip(batches, wanted)):
        seen = spark.createDataFrame(rows, "scope string, timezone double, dated date, k string, who string")
        ledger.compact(spark, batch_id)
        ledger.add(seen.groupBy(*merge.keys).agg(
            F.count("*").alias("n"), F.hll_sketch_agg("who", F.lit(12)).alias("seen")), batch_id)
        assert sorted(map(tuple, ledger.growth(spark, batch_id).collect()), key=str) == sorted(growth, key=str)
        assert sorted(r.scope for r in ledger.batch(spark, batch_id).collect()) == sorted(
            s for row in {row[:4] for row in rows} for s in (("adx", "gmt") if row[0] == "both" else (row[0],)))
    assert sorted(map(tuple, ledger.totals(spark).collect()), key=str) == sorted([
        ("adx", 1.0, D1, "a", 1, 1), ("adx", 8.0, D1, "a", 4, 3), ("adx", 8.0, D2, None, 1, 1),
        ("gmt", None, D1, "a", 4, 3), ("gmt", None, D1, None, 1, 1)], key=str)


def test_greatest_values_and_rows_without_keys(spark, tmp_path):
    ledger = Ledger(str(tmp_path / "a"), Merge(["k"], ["n"], latest=["last"]), every=2)
    for batch_id, (n, last) in enumerate([(1, 5), (2, 3), (3, 9)]):
        ledger.compact(spark, batch_id)
        ledger.add(spark.createDataFrame([("a", n, last)], "k string, n bigint, last bigint"), batch_id)
    assert values(ledger.growth(spark, 1)) == [("a", 2, 5)]
    assert values(ledger.totals(spark)) == [("a", 6, 9)]
    lines = Ledger(str(tmp_path / "b"), Merge([]), every=2)
    for batch_id in range(3):
        lines.compact(spark, batch_id)
        lines.add(spark.createDataFrame([("x",), ("x",)], "value string"), batch_id)
    assert values(lines.rows(spark)) == [("x",)] * 6


def test_an_empty_table(spark, tmp_path):
    ledger = Ledger(str(tmp_path), COUNTS)
    assert ledger.rows(spark) is None and ledger.totals(spark) is None
    ledger.add(counted(spark, []), 0)
    assert ledger.totals(spark) is None and ledger.growth(spark, 0) is None
    ledger.add(counted(spark, [(None, "a", 1)]), 1)
    assert values(ledger.totals(spark)) == [(None, "a", 1)]
    assert ledger.totals(spark, [D1]) is None
    with pytest.raises(ValueError):
        Ledger(str(tmp_path), COUNTS, every=1)
