"""The quality model is fitted on whole texts."""

import random

from adtally.llm import quality
from adtally.llm.quality import quality_scores


def test_rows_that_differ_only_after_a_long_common_start(spark):
    rng = random.Random(7)
    common = " ".join(f"item{rng.randrange(300)}" for _ in range(1200))  # beyond 6000 characters
    words = [[f"{kind}{rng.randrange(10**6):06d}" for _ in range(150)] for kind in ("buy", "sum")]
    docs, labels = [], []
    for i in range(600):
        q = rng.randrange(2)
        docs.append((i, common + " " + " ".join(rng.choice(words[q]) for _ in range(400))))
        labels.append((i, q))
    known = dict(labels)
    rows = quality_scores(spark.createDataFrame(docs, "doc_id bigint, text string"),
                          spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()
    held = [(r.score >= 0.5, known[r.doc_id]) for r in rows if r.held_out]
    assert len(held) > 80 and sum(p == q for p, q in held) > 0.95 * len(held)


def test_calibration_sees_whole_texts(spark, monkeypatch):
    seen = []
    keep = quality._logistic
    monkeypatch.setattr(quality, "_logistic", lambda x, y: seen.append(x) or keep(x, y))
    docs = [(i, f"word{i % 2} " * (20 + 400 * i)) for i in range(60)]
    quality.fit(spark.createDataFrame(docs, "doc_id bigint, text string"),
                spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int"))
    assert seen[0][:, 1].min() < quality.PRIOR_BYTES / 100_000


def test_blocks_come_from_all_over_a_text():
    assert quality._drawn(3, b"") == [] and quality._drawn(-1, b"abc") == [b"abc"]
    numbered = b"".join(b"%04d" % k + b"x" * 1020 for k in range(100))
    drawn = [{int(b[:4]) for b in quality._drawn(i, numbered)} for i in range(200)]
    assert all(len(d) == quality.DRAWN for d in drawn) and set().union(*drawn) == set(range(100))
