"""Scores of the query against the model applied to one text at a time."""

import math
import zlib

import pytest
import zstandard

from adtally.llm import quality
from adtally.llm.queries import QUERIES


def test_query_equals_one_text_at_a_time(spark, sf, documents, texts):
    model = quality.fit(documents, spark.read.parquet(f"{sf}/labels.parquet"))
    press = [zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d))
             for d in (model.good, model.bad)]
    got = {r.doc_id: r for r in QUERIES["op7_compression_quality"](spark, sf).collect()}
    assert len(got) == len(texts)
    for doc_id, text in texts:
        data, row = (text or "").encode(), got[doc_id]
        good, bad = (sum(len(p.compress(data[i:i + 1024])) for i in range(0, len(data), 1024)) for p in press)
        difference, shortness = (bad - good) / (len(data) + 64), 64 / (len(data) + 64)
        total = model.weights[0] * difference + model.weights[1] * shortness + model.weights[2]
        assert row.score == pytest.approx(1 / (1 + math.exp(-total)), rel=1e-9)
        assert row.predicted == int(row.score >= 0.3)
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
