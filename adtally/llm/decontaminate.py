"""Benchmark items inside texts: SimHash windows, multi-index Hamming blocks, weighted shingles.

For an item of n words every window of n words of a text is compared; a text
of fewer words, as of an item that was cut off, is one window. Windows and
items are bags of 5-word shingles; a SimHash of ``BITS`` bits stands for a
bag. Fingerprints are cut into ``RADIUS + 1`` blocks: two that differ in at
most ``RADIUS`` bits agree on a whole block, so looking up each block finds
all fingerprints within the radius. Candidates are verified exactly by the
weighted Jaccard similarity of their bags (each shingle weighs as often as it
occurs).

Only windows that share a shingle with an item of their size can be similar to
one, so windows without one get no fingerprint.

Two bags at the threshold (a Jaccard similarity of 0.8, a cosine of 0.89)
differ in 9.7 of 64 bits on average with a deviation of 2.9; the radius leaves
3.6 deviations.

A benchmark measured as small (``ITEMS``, ``ITEM_BYTES``) is sent to the tasks
and searched there. A larger one stays where it is: bags as similar as this
share at least one of any ``n - ceil(0.8 n) + 1`` shingles of the item, so the
rarest so many of each item are its keys. Texts give those of their shingles
that a bitmap of bounded size knows, both meet by key, and each text that met
items is searched for these, with the same result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from adtally.llm.text import U64, Words, hashes, mix, rolling, slices, whole, words
from adtally.session import stage

GRAM, PERCENT = 5, 80
BITS, RADIUS = 64, 20
#: Bounds of a benchmark that goes to the tasks as a whole.
ITEMS, ITEM_BYTES = 10_000, 8 * 2**20
#: Bits of the bitmap of keys (16 MB), and items that a text is searched for at once.
KEY_BITS, AT_ONCE = 27, 1000
#: Windows whose bits are summed at a time.
WINDOWS = 4096
_EDGES = [round(i * BITS / (RADIUS + 1)) for i in range(RADIUS + 2)]
_BITS = np.array([sum(1 << b for b in range(lo, hi)) for lo, hi in zip(_EDGES, _EDGES[1:])], U64)


def _bits(values: np.ndarray) -> np.ndarray:
    """+1 or -1 for every bit."""
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(
        np.int32) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel().astype(U64)


def simhash(values: np.ndarray) -> np.uint64:
    return _packed(_bits(mix(values)).sum(axis=0)[None, :])[0]


class Group(NamedTuple):
    """Items of one size in words."""

    size: int
    gram: int
    ids: list[int]
    bags: list[Counter]
    prints: np.ndarray
    #: Sorted shingles of all items of the group.
    known: np.ndarray
    #: For each block of bits, its values in order and the items they belong to.
    tables: list[tuple[np.ndarray, np.ndarray]]


def groups(items: pa.Table) -> list[Group]:
    """Items by size; those without words are left out."""
    column = items.column("text").combine_chunks()
    w = words(column, lower=True)
    values = hashes(w.data, w.starts, w.ends)
    by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
    for k, item in enumerate(items.column("item_id").to_pylist()):
        own = values[w.first[k]:w.first[k + 1]]
        if len(own):
            by_size.setdefault(len(own), []).append((item, rolling(own, min(GRAM, len(own)))))
    out = []
    for size, members in sorted(by_size.items()):
        prints = np.array([simhash(v) for _, v in members], U64)
        tables = []
        for bits in _BITS:
            order = np.argsort(prints & bits, kind="stable")
            tables.append(((prints & bits)[order], order))
        out.append(Group(size, min(GRAM, size), [i for i, _ in members], [Counter(v.tolist()) for _, v in members],
                         prints, np.unique(np.concatenate([v for _, v in members])), tables))
    return out


def _near(group: Group, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, item) pairs whose fingerprints differ in at most RADIUS bits."""
    keys = []
    for bits, (block, member) in zip(_BITS, group.tables, strict=True):
        low, high = np.searchsorted(block, prints & bits, "left"), np.searchsorted(block, prints & bits, "right")
        n = high - low
        window = np.repeat(np.arange(len(prints)), n)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item = member[np.repeat(low, n) + inner]
        close = np.bitwise_count(prints[window] ^ group.prints[item]) <= RADIUS
        keys.append(window[close] * len(group.ids) + item[close])
    pairs = np.unique(np.concatenate(keys))
    return pairs // len(group.ids), pairs % len(group.ids)


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two bags."""
    both = sum(min(n, b[k]) for k, n in a.items() if k in b)
    every = sum(a.values()) + sum(b.values()) - both
    return both / every if every else 0.0


class _Bitmap:
    """Which of the values may be known; without false negatives."""

    def __init__(self, known: np.ndarray):
        self.bits = max(16, int(len(known) * 16).bit_length())
        self.set = np.zeros(1 << self.bits, bool)
        self.set[known >> U64(64 - self.bits)] = True

    def maybe(self, values: np.ndarray) -> np.ndarray:
        return self.set[values >> U64(64 - self.bits)]


def _short(w: Words, own: np.ndarray, hits: np.ndarray, count: np.ndarray, group: Group,
           percent: int) -> Iterator[tuple[int, int, int, int, int, float]]:
    """The same for texts of fewer words than the items: each is one window."""
    text = w.text[hits]
    shingles = count[text] - group.gram + 1
    # A bag cannot be more similar than it is large.
    fits = (count[text] < group.size) & (100 * shingles >= percent * (group.size - group.gram + 1) - 1e-9)
    texts = np.unique(text[fits & (text == w.text[hits + group.gram - 1])])
    if not len(texts):
        return
    bags = [own[w.first[t]:w.first[t + 1] - group.gram + 1] for t in texts]
    prints = np.array([simhash(b) for b in bags], U64)
    for begin in range(0, len(texts), WINDOWS):
        for window, item in zip(*_near(group, prints[begin:begin + WINDOWS])):
            k = begin + int(window)
            alike = similarity(Counter(bags[k].tolist()), group.bags[item])
            if 100 * alike >= percent - 1e-9:
                t = int(texts[k])
                yield (t, group.ids[item], 0, int(count[t]), int(np.bitwise_count(prints[k] ^ group.prints[item])),
                       alike)


def _matches(w: Words, values: np.ndarray, found: list[Group], percent: int,
             filters: dict[int, _Bitmap]) -> Iterator[tuple[int, int, int, int, int, float]]:
    """(text, item, start, words, distance, similarity) of the best window of each text and item."""
    grams = {g: rolling(values, g) for g in filters}
    maybe = {g: np.flatnonzero(filters[g].maybe(v)) for g, v in grams.items() if len(v)}
    count = np.diff(w.first)
    for group in found:
        size, own = group.size, grams[group.gram]
        if group.gram not in maybe:
            continue
        at = maybe[group.gram]
        hits = at[group.known[np.minimum(np.searchsorted(group.known, own[at]), len(group.known) - 1)] == own[at]]
        if not len(hits):
            continue
        many = size - group.gram + 1  # shingles of a window
        yield from _short(w, own, hits, count, group, percent)
        if len(values) < size:
            continue
        reach = np.zeros(len(values) + 1, np.int64)  # windows that hold a hit
        np.add.at(reach, np.maximum(hits - many + 1, 0), 1)
        np.add.at(reach, hits + 1, -1)
        start = np.flatnonzero(np.cumsum(reach)[:len(values) - size + 1] > 0)
        start = start[w.text[start] == w.text[start + size - 1]]
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for begin in range(0, len(start), WINDOWS):
            part = start[begin:begin + WINDOWS]
            # Windows next to each other share their sums.
            cut = np.flatnonzero(np.diff(part, prepend=-10) > 1)
            prints = np.empty(len(part), U64)
            for x, y in zip(cut, [*cut[1:], len(part)]):
                run = part[x:y]
                sums = np.concatenate([np.zeros((1, BITS), np.int32), np.cumsum(
                    _bits(mix(own[run[0]:run[-1] + many])), axis=0, dtype=np.int32)])
                prints[x:y] = _packed(sums[many:] - sums[:len(run)])
            for window, item in zip(*_near(group, prints)):
                p = int(part[window])
                alike = similarity(Counter(own[p:p + many].tolist()), group.bags[item])
                if 100 * alike >= percent - 1e-9:
                    key = (int(w.text[p]), int(item))
                    if key not in best or alike > best[key][0]:
                        best[key] = (alike, p, int(np.bitwise_count(prints[window] ^ group.prints[item])))
        for (text, item), (alike, p, distance) in best.items():
            yield text, group.ids[item], p - int(w.first[text]), size, distance, alike


def _prepared(items: pa.Table) -> tuple[list[Group], dict[int, _Bitmap]]:
    found = groups(items)
    known: dict[int, list[np.ndarray]] = {}
    for g in found:
        known.setdefault(g.gram, []).append(g.known)
    return found, {g: _Bitmap(np.concatenate(v)) for g, v in known.items()}


def _search(items: pa.Table, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, filters = _prepared(items)
        for b in slices(batches, "text"):
            w = words(b.column("text"), lower=True)
            rows = list(_matches(w, hashes(w.data, w.starts, w.ends), found, percent, filters))
            text, item, start, size, distance, alike = zip(*rows) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(text, pa.int64())), pa.array(item, pa.int64()),
                 pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(distance, pa.int64()),
                 pa.array(alike, pa.float64())], ["doc_id", "item_id", "start", "n_words", "distance", "similarity"])

    return run


def _clean(items: pa.Table, percent: int) -> object:
    """A function of a binary column: whether a text holds none of the items."""

    @F.arrow_udf(BooleanType())
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found, filters = _prepared(items)
        for column in columns:
            clean, at = np.ones(len(column), bool), 0
            for b in slices(iter([pa.RecordBatch.from_arrays([column], ["text"])]), "text"):
                w = words(b.column("text"), lower=True)
                for text, *_ in _matches(w, hashes(w.data, w.starts, w.ends), found, percent, filters):
                    clean[at + text] = False
                at += b.num_rows
            yield pa.array(clean)

    return run


_FOUND = "item_id bigint, start bigint, n_words bigint, distance bigint, similarity double"


def _measured(benchmark: DataFrame) -> tuple[DataFrame, pa.Table | None]:
    """The items, and all of them at hand if they are few."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), whole().alias("text"))
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    return items, items.toArrow() if n <= ITEMS and size <= ITEM_BYTES else None


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All shingles of the items, as often as they occur."""
    for b in slices(batches, "text"):
        w = words(b.column("text"), lower=True)
        values = hashes(w.data, w.starts, w.ends)
        own = [values[x:y] for x, y in zip(w.first, w.first[1:])]
        bags = [rolling(v, min(GRAM, len(v))) if len(v) else v for v in own]
        count = [len(v) for v in bags]
        yield pa.RecordBatch.from_arrays(
            [b.column("item").take(pa.array(np.repeat(np.arange(len(bags)), count))),
             pa.array(np.concatenate(bags).view(np.int64)),
             pa.array(np.repeat([min(GRAM, len(v)) for v in own], count).astype(np.int32))], ["item", "key", "gram"])


def item_keys(items: DataFrame, percent: int) -> DataFrame:
    """(item, gram, key): of each item the rarest shingles, one of which any window similar to it must hold."""
    shingles = items.mapInArrow(_shingles, "item bigint, key bigint, gram int")
    often = shingles.groupBy("key").agg(F.count("*").alias("n"))
    rarest = shingles.join(often, "key").groupBy("item", "gram").agg(
        F.array_sort(F.collect_list(F.struct("n", "key"))).alias("bag"))
    m = F.size("bag")
    return rarest.select("item", "gram", F.explode(F.array_distinct(F.slice(
        "bag", F.lit(1), m - F.ceil(m * percent / 100 - 1e-9).cast("int") + 1)["key"])).alias("key"))


def _bitmap(keys: DataFrame) -> np.ndarray:
    """One bit for each value of the upper bits of a key: 2**KEY_BITS bits at most, whatever the benchmark."""
    at = F.shiftrightunsigned("key", 64 - KEY_BITS) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).toArrow()
    out = np.zeros((2**KEY_BITS // 32768, 4096), np.uint8)
    for bucket, bits in zip(parts.column("bucket").to_pylist(), parts.column("bits").to_pylist(), strict=True):
        out[bucket - 1] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def _known(bitmap: np.ndarray, grams: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shingles of the texts that may be keys."""
        for b in slices(batches, "text"):
            w = words(b.column("text"), lower=True)
            values = hashes(w.data, w.starts, w.ends)
            for gram in grams:
                own = rolling(values, gram)
                at = own >> U64(64 - KEY_BITS)
                known = bitmap[at >> U64(3)] >> (at & U64(7)).astype(np.uint8) & 1
                hits = np.flatnonzero(known)
                hits = hits[w.text[hits] == w.text[hits + gram - 1]]
                pairs = np.unique(np.stack([w.text[hits], own[hits].view(np.int64)]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("digest").take(pa.array(pairs[0])), pa.array(pairs[1])], ["digest", "key"])

    return run


def _verify(percent: int):
    def run(texts: pa.Table, items: pa.Table) -> pa.Table:
        """The items of a part that its text holds."""
        rows = []
        if texts.num_rows and items.num_rows:
            w = words(texts.column("text").combine_chunks(), lower=True)
            found, filters = _prepared(items)
            rows = [r[1:] for r in _matches(w, hashes(w.data, w.starts, w.ends), found, percent, filters)]
        item, start, size, distance, alike = zip(*rows) if rows else [()] * 5
        digest = texts.column("digest")[0].as_py() if rows else ""
        return pa.table({"digest": pa.array([digest] * len(rows), pa.string()), "item_id": pa.array(item, pa.int64()),
                         "start": pa.array(start, pa.int64()), "n_words": pa.array(size, pa.int64()),
                         "distance": pa.array(distance, pa.int64()), "similarity": pa.array(alike, pa.float64())})

    return run


def _digest() -> object:
    return F.sha2(whole(), 256)


def _met(docs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """(digest, ...): the matches of each different text, for a benchmark of any size.

    Neither the items nor the texts pass through the driver. A text that met
    many items is searched for some ``AT_ONCE`` of them in a task; copies of a
    text are merged before they are shuffled, and searched once.
    """
    spark = docs.sparkSession
    items = stage(spark, items.withColumn("item", F.monotonically_increasing_id()), "items")
    keys = stage(spark, item_keys(items.select("item", "text"), percent), "keys")
    grams = sorted(r[0] for r in keys.select("gram").distinct().collect())  # five at most
    texts = docs.select(_digest().alias("digest"), whole().alias("text"))
    known = texts.mapInArrow(_known(_bitmap(keys), grams), "digest string, key bigint").distinct()
    pairs = stage(spark, known.join(keys, "key").select("digest", "item").distinct(), "pairs")
    parts = pairs.groupBy("digest").agg(F.ceil(F.count("*") / AT_ONCE).alias("parts"))
    asked = pairs.join(parts, "digest").withColumn("part", F.pmod(F.xxhash64("item"), "parts")).join(
        items, "item").select("digest", "part", "item_id", "text")
    held = texts.join(parts, "digest").groupBy("digest", "parts").agg(F.first("text").alias("text")).select(
        "digest", "text", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    keyed = ["digest", "part"]
    return held.groupBy(*keyed).cogroup(asked.groupBy(*keyed)).applyInArrow(_verify(percent), "digest string, " + _FOUND)


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, start, n_words, distance, similarity): the best window of each text for each item it holds.

    Words are lower-cased in A-Z; ``start`` counts them from 0. A text of fewer
    words than the item is one window of ``n_words``. Ties take the first
    window. Items of fewer than five words are one shingle, so only equal
    windows match; items or texts that are null, empty or without words match
    nothing. Repeated rows of ``docs`` give a row each, as do repeated items; a null doc_id or
    item_id passes through. Without items or texts the result is empty.
    """
    items, few = _measured(benchmark)
    own = F.col("doc_id").cast("bigint").alias("doc_id")
    if few is not None:
        return docs.select(own, whole().alias("text")).mapInArrow(_search(few, percent), "doc_id bigint, " + _FOUND)
    return docs.select(own, _digest().alias("digest")).join(_met(docs, items, percent), "digest").drop("digest")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, all columns as they are; doc_id has no part in it."""
    items, few = _measured(benchmark)
    if few is not None:
        return docs.where(_clean(few, percent)(whole()))
    leaking = _met(docs, items, percent).select("digest").distinct()
    return docs.join(leaking, _digest() == leaking["digest"], "left_anti")
