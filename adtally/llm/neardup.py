"""MinHash near-duplicates: one-permutation hashing, banded buckets, star-shaped candidates.

A text's set holds the hashes of its distinct shingles. One permutation of the
hashes is cut into ``BINS`` ranges and the least hash of each range is kept;
an empty range borrows from a range drawn by a hash of its own number and the
attempt (optimal densification, Shrivastava 2017). ``ROWS`` neighbouring
ranges make a band; texts that agree on a band share a bucket.

A node is a text under a doc_id; nodes are numbered in the order of doc_id.
Texts with equal sets form one class, of which only the smallest node goes
on. In each bucket every class is linked with the smallest one
only, so a bucket of n classes gives n - 1 candidates and not n squared. A
star can miss two classes that resemble each other but not the centre.
Buckets that still hold several components after the stars are verified are
therefore compared in blocks inside the tasks, first by sketches, then by
full sets; only links between different components leave a task.

Two texts at the threshold share no band with probability (1 - 0.8**6)**40, 5e-6.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.graph import components
from adtally.llm.text import U64, Words, hashes, mix, shingles, slices, whole, words
from adtally.session import stage

ROWS, BANDS = 6, 40
BINS = ROWS * BANDS
WORDS, PERCENT = 5, 80
#: A sketch of BINS values errs by 0.026 at the threshold; six times that is left as a margin.
MARGIN = 0.16
#: Bytes of sets of one bucket that one task compares with as many others.
BLOCK_BYTES = 2 * 2**20
COLUMNS = 2048
_EMPTY = U64(2**64 - 1)
#: Draws for an empty range that are tried for all texts at once.
DRAWS = 6
#: Rows of a staged table that one task writes, if all cores have some.
STAGED_ROWS = 100_000


def distinct_shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one text after the other, and where each text begins."""
    s = shingles(w, hashes(w.data, w.starts, w.ends), size)
    order = np.lexsort((s.values, s.text))
    value, text = s.values[order], s.text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[new], text[new]
    return value, np.searchsorted(text, np.arange(len(w.first)))


def sketches(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One-permutation sketches, a row for each text; texts without shingles keep empty bins."""
    texts = np.repeat(np.arange(len(first) - 1), np.diff(first))
    ranges = ((values >> U64(32)) * U64(BINS) >> U64(32)).astype(np.int64)
    cell = texts * BINS + ranges  # in order, as the hashes are
    least = np.ones(len(cell), bool)
    least[1:] = cell[1:] != cell[:-1]
    sketch = np.full((len(first) - 1) * BINS, _EMPTY)
    sketch[cell[least]] = values[least]
    sketch = sketch.reshape(-1, BINS)
    filled = sketch != _EMPTY
    row, column = np.nonzero(~filled & filled.any(axis=1)[:, None])
    for attempt in range(1, DRAWS + 1):
        drawn = _drawn(column, attempt)
        found = filled[row, drawn]
        sketch[row[found], column[found]] = sketch[row[found], drawn[found]]
        row, column = row[~found], column[~found]
    if len(row):  # short texts: of their few filled ranges the one that comes first
        order = _draw_order()
        begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])).tolist()
        for x, y in zip(begin, [*begin[1:], len(row)]):
            there, empty = np.flatnonzero(filled[row[x]]), column[x:y]
            sketch[row[x], empty] = sketch[row[x], there[order[empty][:, there].argmin(axis=1)]]
    return sketch


def _drawn(column: np.ndarray, attempt: int) -> np.ndarray:
    return (mix(U64(attempt * 65536) + column.astype(U64)) % U64(BINS)).astype(np.int64)


@functools.cache
def _draw_order() -> np.ndarray:
    """For each range and each other one the attempt that draws it first."""
    order, columns, attempt = np.zeros((BINS, BINS), np.int64), np.arange(BINS), 0
    while not order.all():
        attempt += 1
        drawn = _drawn(columns, attempt)
        new = order[columns, drawn] == 0
        order[columns[new], drawn[new]] = attempt
    return order


def _binary(data: bytes, lengths: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])


def _mark(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            values, first = distinct_shingles(words(b.column("text"), lower=True), size)
            sketch = sketches(values, first)
            count = np.diff(first)
            with np.errstate(over="ignore"):
                both = [np.concatenate([[U64(0)], np.cumsum(mix(values ^ U64(k)))]) for k in (0, 0x5BD1E995)]
                sums = np.stack([mix((s[first[1:]] - s[first[:-1]]) ^ count.astype(U64)) for s in both], axis=1)
                bands = mix(rolling_rows(sketch.reshape(-1, BANDS, ROWS)) ^ mix(np.arange(1, BANDS + 1, dtype=U64)))
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("key"), pa.array(count, pa.int64()),
                _binary(sums.tobytes(), np.full(len(count), 16)),
                pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel().view(np.int64)), BANDS).cast(
                    pa.list_(pa.int64())),
                _binary((sketch & U64(0xFFFF)).astype(np.uint16).tobytes(), np.full(len(count), 2 * BINS)),
            ], ["doc_id", "key", "n_shingles", "digest", "bands", "sketch"])

    return run


def rolling_rows(rows: np.ndarray) -> np.ndarray:
    total = np.zeros(rows.shape[:-1], U64)
    for i in range(rows.shape[-1]):
        total = mix(total ^ rows[..., i]) + U64(i + 1)
    return total


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            values, first = distinct_shingles(words(b.column("text"), lower=True), size)
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), _binary(values.tobytes(), 8 * np.diff(first))], ["node", "shingles"])

    return run


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or 100 * len(x) < percent * len(y):
        return False
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [_alike(*(np.frombuffer(v.as_buffer(), U64) for v in pair), percent)
                    for pair in zip(b.column("left"), b.column("right"), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
    links = both.select("a", "b", "left", "right").mapInArrow(_similar(percent), "a bigint, b bigint")
    return links.distinct()


def _overlaps(sets: list[np.ndarray], mine: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of intersection and union of each pair of sets.

    Products of membership matrices, some columns at a time: a family of very
    many near copies costs little more than reading it.
    """
    used, at = np.unique(np.concatenate([mine, theirs]), return_inverse=True)
    if not len(used):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.array([len(sets[u]) for u in used])
    column = np.unique(np.concatenate([sets[u] for u in used]), return_inverse=True)[1]
    row = np.repeat(np.arange(len(used)), size)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.bincount(column)[column] > 1
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    both = np.zeros((len(used), len(used)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        x, y = np.searchsorted(column, [first, first + COLUMNS])
        member = np.zeros((len(used), COLUMNS), np.float32)
        member[row[x:y], column[x:y] - first] = 1
        both += member @ member.T
    a, b = at[:len(mine)], at[len(mine):]
    common = both[a, b].astype(np.int64)
    return common, size[a] + size[b] - common


def _across(percent: int):
    least = percent / 100 - MARGIN

    def run(group: pa.Table) -> pa.Table:
        """Links between different components of one block pair.

        A pair that shares several buckets is compared in the first of them.
        A link that is found joins two components for the rest of the group.
        """
        i, j, band = (group.column(c)[0].as_py() for c in ("i", "j", "band"))
        own = np.array(group.column("block")) == i
        ids, component = (np.array(group.column(c)) for c in ("node", "component"))
        sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint16).reshape(-1, BINS)
        bands = np.array(group.column("bands").combine_chunks().flatten()).reshape(-1, BANDS)
        sets = [np.frombuffer(v.as_buffer(), U64) for v in group.column("shingles")]
        joined = {c: c for c in set(component.tolist())}

        def root(c: int) -> int:
            while joined[c] != c:
                joined[c] = c = joined[joined[c]]
            return c

        mine, theirs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in np.flatnonzero(own):
            others = np.flatnonzero(((ids > ids[k]) if i == j else ~own) & (component != component[k]))
            others = others[(sketch[others] == sketch[k]).mean(axis=1) >= least]
            others = others[(bands[others] == bands[k]).argmax(axis=1) == band]
            mine.append(np.full(len(others), k))
            theirs.append(others)
        mine, theirs = np.concatenate(mine), np.concatenate(theirs)
        both, either = _overlaps(sets, mine, theirs)
        alike = 100 * both >= percent * either
        links = []
        for x, y in zip(mine[alike].tolist(), theirs[alike].tolist(), strict=True):
            low, high = root(int(component[x])), root(int(component[y]))
            if low != high:
                links.append((max(ids[x], ids[y]), min(ids[x], ids[y])))
                joined[low] = high
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def _key() -> Column:
    """A doc_id and its text; never null."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.sha2(whole(), 256))


def marks(docs: DataFrame, size: int) -> DataFrame:
    return docs.select("doc_id", _key().alias("key"), whole().alias("text")).mapInArrow(
        _mark(size), "doc_id bigint, key string, n_shingles bigint, digest binary, bands array<bigint>, sketch binary")


class _Found(NamedTuple):
    #: A row for every row of the documents: doc_id, key, n_shingles and more.
    marked: DataFrame
    #: node, doc_id, key: each key once, numbered in the order of doc_id, those without last.
    nodes: DataFrame
    #: node, component for every node with a link.
    components: DataFrame


def _find(docs: DataFrame, size: int, percent: int, by_doc_id: bool) -> _Found:
    """Groups of near copies. ``by_doc_id``: rows that share a doc_id belong together, those without one link with nothing."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    marked = stage(spark, marks(docs, size), "marks")
    files = max(spark.sparkContext.defaultParallelism, marked.count() // STAGED_ROWS)

    def staged(df: DataFrame, name: str) -> DataFrame:
        return stage(spark, df.coalesce(files), name)

    order = [F.col("doc_id").asc_nulls_last(), F.col("key")]
    nodes = staged(marked.select("doc_id", "key").distinct().repartitionByRange(*order).sortWithinPartitions(
        *order).withColumn("node", F.monotonically_increasing_id()), "nodes")
    able = marked.where("n_shingles > 0")
    linked = nodes.where("doc_id is not null") if by_doc_id else nodes
    members = staged(able.select("key", "digest").distinct().join(linked.select("key", "node"), "key").drop("key"), "members")
    classes = members.groupBy("digest").agg(F.min("node").alias("node"))
    copies = members.withColumnRenamed("node", "a").join(classes.withColumnRenamed("node", "b"), "digest").where(
        "a != b").select("a", "b")
    first = able.select("digest", "bands", "sketch", "n_shingles").dropDuplicates(["digest"]).join(classes, "digest")
    first = staged(first.drop("digest"), "classes")
    entries = first.select("node", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    shared = entries.groupBy("bucket").agg(F.min("node").alias("centre"), F.count("*").alias("n")).where("n > 1")
    stars = staged(entries.join(shared.drop("n"), "bucket"), "stars")
    pairs = stars.where("node != centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    # Only texts that share a bucket are read again. Their keys grow with the input: not to be broadcast.
    wanted = stars.select("node").distinct().join(nodes, "node").select("key", "node").hint("merge")
    sets = staged(docs.select(_key().alias("key"), whole().alias("text")).join(wanted, "key").dropDuplicates(
        ["key"]).select("node", "text").mapInArrow(_sets(size), "node bigint, shingles binary"), "sets")
    links = _confirm(pairs, sets, percent).union(copies)
    if by_doc_id:
        same = linked.groupBy("doc_id").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1")
        links = links.union(linked.join(same, "doc_id").where("node != b").select("node", "b"))
    links = staged(links, "links")
    found = components(links, "a", "b")

    labelled = staged(stars.join(found, "node", "left").select(
        "band", "bucket", "node", "n_shingles", F.coalesce("component", "node").alias("component")), "labelled")
    split = labelled.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.sum("n_shingles").alias("n")).where("low != high")
    rest = labelled.join(split.select("bucket", F.ceil(8 * F.col("n") / BLOCK_BYTES).alias("blocks")), "bucket")
    rest = rest.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    # Every block meets every block once: it goes along row and column of the triangle of block pairs.
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    rest = rest.select("band", "bucket", "node", "component", "block", F.least("block", "other").alias("i"),
                       F.greatest("block", "other").alias("j"))
    rest = rest.join(first.select("node", "sketch", "bands"), "node").join(sets, "node")
    more = staged(rest.groupBy("bucket", "i", "j").applyInArrow(_across(percent), "a bigint, b bigint").distinct(), "more")
    if not more.isEmpty():
        found = components(links.union(more), "a", "b")
    return _Found(marked, nodes, found)


def near_duplicates(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text, any other columns).

    Words are lower-cased in A-Z. A text of fewer than ``size`` words is one
    shingle; one without words, or a null text, has none and links with
    nothing. Rows that share a doc_id belong together, also with different
    texts. A row without doc_id links with nothing, has no component_id and is
    kept. An empty table gives an empty result. Ties take the smallest doc_id.
    """
    found = _find(docs, size, percent, by_doc_id=True)
    ids = found.nodes.select(F.col("node").alias("component"), F.col("doc_id").alias("of"))
    component = found.components.join(ids, "component").join(found.nodes.select("node", "key"), "node").select("key", "of")
    return found.marked.select("doc_id", "key", "n_shingles").join(component, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("of", "doc_id").alias("component_id"),
        F.coalesce("of", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"))


def first_of_each_group(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near copies, the one with the smallest doc_id, all columns as they are.

    Rows count as such: of repeated rows one stays, those without doc_id are
    compared like all others (and come last, by a hash of the text), and different texts under one
    doc_id go their own ways. Rows without words all stay.
    """
    spark = docs.sparkSession
    found = _find(docs, size, percent, by_doc_id=False)
    name = "_key"
    while name.lower() in map(str.lower, docs.columns):
        name = "_" + name
    # Both are staged, so their sizes are known when the joins are planned.
    gone = stage(spark, found.components.where("node != component").join(found.nodes, "node").select(
        F.col("key").alias(name)), "gone")
    again = stage(spark, found.marked.where("n_shingles > 0").groupBy("key").agg(F.count("*").alias("n")).where(
        "n > 1").select(F.col("key").alias(name)).join(gone, name, "left_anti"), "again")
    keyed = docs.withColumn(name, _key())
    once = keyed.join(gone.union(again), name, "left_anti")
    return once.unionByName(keyed.join(again, name, "left_semi").dropDuplicates([name])).drop(name)


#: The components of 2-word shingles for a database: all pairs that share a shingle, then all that is reachable.
SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
flat AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts),
follow AS (SELECT doc_id, n, word, lead(word) OVER (PARTITION BY doc_id ORDER BY place) AS following FROM flat),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN n = 1 THEN word ELSE word || ' ' || following END AS shingle
  FROM follow WHERE n = 1 OR following IS NOT NULL),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (
  SELECT x, y FROM shared JOIN sizes a ON x = a.doc_id JOIN sizes b ON y = b.doc_id
  WHERE 100 * common >= 80 * (a.n + b.n - common)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM texts UNION SELECT reach.doc_id, y FROM reach JOIN links ON other = x),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""
