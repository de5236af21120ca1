"""The corpus pipeline stage by stage."""

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from adtally.llm.bytebpe import Vocabulary
from checks.compare import compare
from tests.llm.test_operators import brute_components, brute_leaks

FOLDER = "/root/testdata/sf0.001"


def rows(frame):
    return sorted((r.doc_id, r.text) for r in frame.collect())


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    steps = dict(corpus_pipeline.STAGES)
    good = steps[names[0]](spark, docs, FOLDER).cache()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {d for d, _ in rows(good)}
    assert good.columns == docs.columns
    assert np.mean([(d in kept) == bool(q) for d, q in labels.items()]) > 0.85

    single = steps[names[1]](spark, good, FOLDER).cache()
    groups = brute_components(rows(good), 5)
    assert [d for d, _ in rows(single)] == sorted(d for d, (_, c) in groups.items() if d == c)

    clean = steps[names[2]](spark, single, FOLDER).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaks = {d for d, _ in brute_leaks(rows(single), items)}
    assert [d for d, _ in rows(clean)] == [d for d, _ in rows(single) if d not in leaks]

    safe = steps[names[3]](spark, clean, FOLDER).cache()
    assert safe.columns == docs.columns and [d for d, _ in rows(safe)] == [d for d, _ in rows(clean)]
    assert not any("token = \"" in t for _, t in rows(safe))

    ranks = Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken")).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = {r.doc_id: r for r in steps[names[4]](spark, safe, FOLDER).collect()}
    for d, t in rows(safe):
        assert np.frombuffer(bytes(coded[d].ids), "<u4").tolist() == library.encode_ordinary(t)
    whole = {r.doc_id: bytes(r.ids) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert whole == {d: bytes(r.ids) for d, r in coded.items()}


def test_license_query_equals_its_sql(spark):
    assert compare(spark, FOLDER, "op2_license_scan") is None
