"""Repeated passages: heavy minimisers at any size of input, marks for missing ids, SQL."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from adtally.llm import substrings
from adtally.llm.queries import ORACLE, op6_substring_dedup
from adtally.llm.substrings import heavy_minimisers, remove_repeats
from checks.compare import compare


def test_missing_and_least_ids_differ(spark):
    text = " ".join(f"w{k}" for k in range(25))
    rows = [(None, text), (-2**63, text), (-2**63, text + " more"), (-2**63 + 1, text), (None, "a b")]
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_removed) for r in remove_repeats(
        spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), 12).collect()))
    assert got == [(False, 0, 2, 0), (False, 0, 25, 0), (True, -2**63, 25, 25), (True, -2**63, 26, 25),
                   (True, -2**63 + 1, 25, 25)]


def test_minimisers_that_are_rare_in_every_slice_are_counted(monkeypatch):
    monkeypatch.setattr(substrings, "SLICE", 400)
    line = " ".join(f"same{k}" for k in range(20))
    rng = np.random.default_rng(3)
    texts = [(line if k % 2 else " ".join(f"x{v}" for v in rng.integers(0, 10**9, 20))).encode() for k in range(400)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k:k + 2], pa.binary())], ["text"]) for k in range(0, 400, 2)]
    total, found = 0, {}
    for held in (substrings.HELD, 30):  # one count of all slices, and many
        monkeypatch.setattr(substrings, "HELD", held)
        total, found = 0, {}
        for b in substrings._count_minimisers(20, 3, 0.3)(iter(batches)):
            for key, n in zip(b.column("key").to_pylist(), b.column("n").to_pylist()):
                if key is None:
                    total += n
                else:
                    found[key] = found.get(key, 0) + n
        assert total == 400 and max(found.values()) == 200


def test_heavy_minimisers_are_bounded(spark, documents):
    docs = documents.select(F.col("text").cast("binary").alias("text"))
    every = heavy_minimisers(docs, 20, 3, 10**6)
    few = heavy_minimisers(docs, 20, 3, 10**6, most=100)
    assert len(few) <= 100 < len(every) and np.isin(few, every).all() and (np.diff(every.astype(np.int64)) > 0).all()


def test_repeats_equal_their_sql(spark, sf):
    assert "op6_substring_dedup" in ORACLE
    assert compare(spark, sf, "op6_substring_dedup", op6_substring_dedup(spark, sf)) is None
