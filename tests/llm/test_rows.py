"""Filters of the pipeline decide by row, whatever its doc_id."""

from collections import Counter

from adtally.llm import decontaminate
from adtally.llm.decontaminate import without_contaminated
from adtally.llm.neardup import first_of_each_group, near_duplicates

A, B, C = (" ".join(f"{c}{k}" for k in range(40)) for c in "abc")
LAYOUT = "doc_id bigint, text string, size int"


def left(frame):
    return Counter((r.doc_id, r.text) for r in frame.collect())


def test_one_row_of_each_group(spark):
    rows = [(1, A, 1), (1, A, 2), (1, B, 3), (2, A, 4), (None, C, 5), (None, C, 6), (None, C + " more", 7),
            (None, B.upper(), 8), (3, C.replace("c5 ", "x "), 9), (4, None, 1), (4, None, 2), (None, " ", 3), (None, " ", 4)]
    docs = spark.createDataFrame(rows, LAYOUT)
    out = first_of_each_group(docs.repartition(5))
    assert out.columns == docs.columns
    # The text under 3 has 31 of 41 shingles of C.
    got = left(out)
    assert got.pop((None, C), 0) + got.pop((None, C + " more"), 0) == 1  # by the hash of the text
    assert got == Counter({(1, A): 1, (1, B): 1, (3, rows[8][1]): 1, (4, None): 2, (None, " "): 2})


def test_a_clean_text_under_the_id_of_a_copy_stays(spark):
    out = first_of_each_group(spark.createDataFrame([(1, A, 1), (2, A, 2), (2, B, 3)], LAYOUT))
    assert left(out) == Counter({(1, A): 1, (2, B): 1})


def test_contaminated_rows(spark, monkeypatch):
    bench = spark.createDataFrame([(7, A), (None, C)], "item_id bigint, text string")
    docs = spark.createDataFrame(
        [(None, A, 1), (1, B, 2), (1, "x " + A, 3), (1, B, 4), (None, B, 5), (2, None, 6), (3, C, 7), (None, None, 8)], LAYOUT)
    for items in (decontaminate.ITEMS, 1):
        monkeypatch.setattr(decontaminate, "ITEMS", items)
        out = without_contaminated(docs, bench)
        assert out.columns == docs.columns
        assert left(out) == Counter({(1, B): 2, (None, B): 1, (2, None): 1, (None, None): 1})


def test_columns_of_any_name(spark):
    """Names that the stage might use itself, null and repeated ids."""
    names = ["_key", "_id", "_node", "_row", "_digest", "key", "node", "component", "digest", "_gone"]
    layout = "doc_id bigint, text string, " + ", ".join(f"{n} string" for n in names)
    rows = [(1, A, *names), (2, A, *names), (2, B, *names), (None, C, *names), (None, C, *names), (4, None, *names)]
    docs = spark.createDataFrame(rows, layout)
    out = first_of_each_group(docs)
    assert out.columns == docs.columns
    assert left(out) == Counter({(1, A): 1, (2, B): 1, (None, C): 1, (4, None): 1})
    assert {tuple(r)[2:] for r in out.collect()} == {tuple(names)}


def test_texts_under_one_doc_id_belong_together(spark):
    rows = [(1, A), (2, A), (2, B), (3, B), (None, A), (None, B), (5, None), (5, C), (6, C)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {
        (1, 1, True), (2, 1, False), (3, 1, False), (None, None, True), (5, 5, True), (6, 5, False)}


def test_split_buckets_are_compared_in_blocks_of_bytes(spark, monkeypatch):
    """Two families that share buckets and a star centre far from most; the same groups for any size of blocks."""
    import random
    draw = random.Random(8)
    words = [f"w{k}" for k in range(120)]
    rows = []
    for n in range(160):
        own = list(words)
        for _ in range(draw.randrange(0, 26)):
            own[draw.randrange(120)] = f"x{draw.randrange(10**6)}"
        rows.append((n, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    groups = []
    for size in (2 * 2**20, 4096):
        monkeypatch.setattr("adtally.llm.neardup.BLOCK_BYTES", size)
        groups.append(sorted((r.doc_id, r.component_id) for r in near_duplicates(docs, 2).collect()))
    sets = [set(zip(t.split(), t.split()[1:])) for _, t in rows]
    root = list(range(160))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(160):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    assert groups[0] == groups[1] == [(i, find(i)) for i in range(160)]
