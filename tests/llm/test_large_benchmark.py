"""A benchmark too large for the tasks meets the texts by key, with the same result."""

import random

import pytest
from pyspark.sql import functions as F

from adtally.llm import decontaminate
from adtally.llm.decontaminate import contaminated, item_keys, without_contaminated

TEXT, ITEM = "doc_id bigint, text string", "item_id bigint, text string"


def rows(frame):
    return sorted(map(repr, frame.collect()))


@pytest.fixture
def large(monkeypatch):
    def use(items=0, at_once=decontaminate.AT_ONCE):
        monkeypatch.setattr(decontaminate, "ITEMS", items)
        monkeypatch.setattr(decontaminate, "AT_ONCE", at_once)

    return use


def test_both_ways_give_the_same(spark, sf, documents, edges, nothing, large):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    once, kept = rows(contaminated(documents, benchmark)), rows(without_contaminated(documents, benchmark))
    large()
    assert once and rows(contaminated(documents, benchmark)) == once
    assert rows(without_contaminated(documents, benchmark)) == kept
    assert contaminated(edges, benchmark).count() == 0 and contaminated(nothing, benchmark).count() == 0
    assert rows(without_contaminated(edges, benchmark)) == rows(edges)
    assert without_contaminated(edges, benchmark).columns == edges.columns


def test_short_repeated_and_missing_items_and_texts(spark, large):
    rng = random.Random(8)
    line = [f"same{k}" for k in range(12)]  # in every item, so never a key of one
    items = [(k, " ".join(line + [f"w{rng.randrange(60)}" for _ in range(n)])) for k, n in enumerate([60, 60, 25, 30, 9])]
    items += [(10 + n, " ".join(f"k{n}{x}" for x in range(n))) for n in (1, 2, 3, 4, 5, 6)]
    items += [items[0], (None, items[1][1]), (40, None), (41, ""), (42, " . ")]
    docs = [(None, None), (None, ""), (1, " \n"), (2, " ".join(line)), (3, "k10"), (4, "x K20 k21 y")]
    for _, item in items:
        words = (item or "").split()
        for missing in (0, 1, 2, 5, 9, 14):
            docs.append((len(docs), " ".join(words[missing:])))
            docs.append((len(docs), " ".join(["before", *words[:len(words) - missing], "after", *line])))
        if words:
            docs.append((len(docs), " ".join(w if k % 11 else "other" for k, w in enumerate(words))))
    docs += docs[-40:] + [(None, docs[20][1]), (7, " ".join(i or "" for _, i in items) + " " + " ".join(line))]
    frame, bench = spark.createDataFrame(docs, TEXT).repartition(5), spark.createDataFrame(items, ITEM)
    once, kept = rows(contaminated(frame, bench)), rows(without_contaminated(frame, bench))
    assert any("doc_id=None" in r for r in once) and any("item_id=None" in r for r in once)
    for at_once in (1000, 2):
        large(0, at_once)
        assert rows(contaminated(frame, bench)) == once
        assert rows(without_contaminated(frame, bench)) == kept


def test_keys_are_the_rarest(spark):
    line = [f"same{k}" for k in range(8)]
    items = spark.createDataFrame(
        [(k, " ".join([*line, *(f"v{k}x{n}" for n in range(40))])) for k in range(30)], "item bigint, text string")
    keys = item_keys(items.select("item", F.col("text").cast("binary").alias("text")), 80)
    # 44 shingles of which 36 at least are shared: one of any nine is.
    assert [r["n"] for r in keys.groupBy("item").agg(F.count("*").alias("n")).collect()] == [9] * 30
    assert keys.select("key").distinct().count() == 9 * 30  # none from the line all items begin with


def test_columns_of_the_caller_stay(spark, large):
    item = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame(
        [(1, item, "a", 1, None), (1, "clean", "b", 2, "x"), (None, item, None, None, "y"), (3, None, "c", 3, "z")],
        TEXT + ", digest string, item_id bigint, part string")
    bench = spark.createDataFrame([(7, item)], ITEM)
    large()
    kept = without_contaminated(docs, bench)
    assert kept.columns == docs.columns and rows(kept) == rows(docs.where("part in ('x', 'z')"))
    assert [(r.doc_id, r.item_id) for r in contaminated(docs, bench).orderBy("doc_id").collect()] == [(None, 7), (1, 7)]
