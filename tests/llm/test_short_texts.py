"""Texts of fewer words than the benchmark item that they hold."""

import random
from collections import Counter

from adtally.llm.decontaminate import contaminated, without_contaminated


def brute(docs, items, percent):
    """Similarity by (doc_id, item_id) of texts that are shorter than the item."""
    out = {}
    for d, text in docs:
        for i, item in items:
            a, b = text.lower().split(), item.lower().split()
            if len(a) < len(b):
                g = min(5, len(b))
                x, y = (Counter(tuple(v[k:k + g]) for k in range(len(v) - g + 1)) for v in (a, b))
                alike = sum((x & y).values()) / max(1, sum((x | y).values()))
                if 100 * alike >= percent - 1e-9:
                    out[d, i] = alike
    return out


def test_items_that_are_cut_off(spark):
    rng = random.Random(5)
    items = [(k, " ".join(f"w{rng.randrange(40)}" for _ in range(n))) for k, n in enumerate([60, 60, 25, 9, 5, 4, 2, 1])]
    docs = [(0, " ".join(items[0][1].split()[:57]).upper())]  # 53 of 56 shingles
    for _, item in items:
        words = item.split()
        for missing in range(1, len(words)):
            for part in (words[:-missing], words[missing:], words[:len(words) // 2] + words[len(words) // 2 + missing:]):
                docs.append((len(docs), " ".join(part)))
    docs += [(-1, None), (-2, ""), (-3, " ")]
    text = "doc_id bigint, text string"
    frame, bench = spark.createDataFrame(docs, text), spark.createDataFrame(items, "item_id bigint, text string")
    for parts in (1, 7):  # many texts in a batch, or few
        for percent in (80, 60):
            got = contaminated(frame.repartition(parts), bench, percent).collect()
            words = {d: (t or "").split() for d, t in docs}
            short = {(r.doc_id, r.item_id): r for r in got if len(words[r.doc_id]) < len(items[r.item_id][1].split())}
            wanted = brute([(d, t or "") for d, t in docs], items, percent)
            if percent == 80:
                assert short.keys() == wanted.keys() and (0, 0) in short
            assert all(abs(r.similarity - wanted[k]) < 1e-12 and (r.start, r.n_words) == (0, len(words[k[0]]))
                       for k, r in short.items())
    left = {r.doc_id for r in without_contaminated(frame, bench).collect()}
    assert 0 not in left and {-1, -2, -3} <= left
    assert [r.doc_id for r in contaminated(frame.where("doc_id = 0"), bench).collect()] == [0]  # a batch shorter than the item


def test_sketches_of_few_shingles_cost_no_more(monkeypatch):
    """Ten thousand texts of four words, and the same borrowing as drawing until a filled range is hit."""
    import time

    import numpy as np

    from adtally.llm import neardup
    from adtally.llm.text import U64, mix

    draw = np.random.default_rng(5)
    values = np.sort(mix(draw.integers(0, 2**63, (10_000, 3), dtype=np.int64).view(U64)), axis=1)
    first = np.arange(0, 30_001, 3)
    neardup.sketches(values.ravel()[:3], first[:2])  # the order of draws is worked out once
    began = time.process_time()
    got = neardup.sketches(values.ravel(), first)
    assert time.process_time() - began < 6
    for row in (0, 17, 9_999):
        filled = {int((int(v) >> 32) * neardup.BINS >> 32): v for v in values[row][::-1]}
        for column in range(neardup.BINS):
            attempt, at = 0, column
            while at not in filled:
                attempt += 1
                at = int(mix(np.array([attempt * 65536 + column], U64))[0] % U64(neardup.BINS))
            assert got[row, column] == filled[at]
