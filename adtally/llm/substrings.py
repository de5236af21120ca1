"""Removal of repeated passages: super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one text. The minimiser of a
window is the least hash among its runs of ``GRAM`` words, so equal windows
have equal minimisers and neighbouring windows mostly share one. Neighbouring
windows with one minimiser travel as one packed string (a super-k-mer) to the
bucket of that minimiser. There the windows are hashed and sorted; windows of
one hash are compared byte by byte with the first of their run, which is the
earliest place, so counts are exact.

Packed strings of one task and bucket go as one compressed row. Exact copies
of a packed string in one task are judged at once: only the first travels.

A minimiser that occurs very often (part of a common line) would make one
bucket too large. A first pass over all texts counts minimisers; those above
an even share are heavy. Their windows travel each by itself, to a bucket
drawn from the hash of the whole window, so even one line that a third of all
texts share is spread. Which minimisers are heavy changes where windows meet,
never the result. So the table sent to the tasks may hold the upper half of
each heavy minimiser only; the few others that begin alike are spread as well.
It has ``MOST_HEAVY`` entries at most (64 MB): up to 16 TB of input any
minimiser above half an even share is heavy, at 100 TB any above 6 MB of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.text import U64, hashes, mix, rolling, slices, whole
from adtally.session import total_bytes

WINDOW, GRAM = 20, 3
SLICE = 8 * 2**20
LEVEL = 3
#: Windows whose bytes are compared at a time.
COMPARED = 100_000
#: Bytes of Parquet input for a bucket.
BUCKET_BYTES = 2 * 2**20
#: Buckets judged by one task, and the most tasks; a bucket is read and freed by itself.
TASK_BUCKETS, MOST_TASKS = 16, 100_000
#: Minimisers treated as heavy at most; it bounds the table sent to every task (four bytes each), not their windows.
MOST_HEAVY = 2**24
#: Minimisers counted together before they leave a task.
HELD = 2**21
_LEAST = -2**63


class _Texts:
    """The texts of a batch as words joined by single spaces, with hashes of words and windows."""

    def __init__(self, batch: pa.RecordBatch, size: int, gram: int):
        joined, count = [], []
        for value in batch.column("text"):
            part = value.as_buffer().to_pybytes().split()
            count.append(len(part))
            if part:
                joined.append(b" ".join(part))
        self.count = np.array(count, np.int64)
        self.data = b" ".join(joined)
        del joined
        raw = np.frombuffer(self.data, np.uint8)
        gaps = np.flatnonzero(raw == 32)
        self.starts = np.concatenate([[0], gaps + 1]) if len(raw) else np.zeros(0, np.int64)
        self.ends = np.append(gaps, len(raw)) if len(raw) else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        self.text = np.repeat(np.arange(len(self.count)), self.count)
        values = hashes(raw, self.starts, self.ends)
        self.values = values
        grams = rolling(values, gram)
        low, span = grams, 1  # the least of `span` grams
        wanted = size - gram + 1
        while span < wanted and len(low):
            step = min(span, wanted - span)
            low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
            span += step
        self.at = np.flatnonzero(self.text[:len(low)] == self.text[size - 1:]) if len(low) else np.zeros(0, np.int64)
        #: Minimiser of the window that starts at word at[i].
        self.low = low[self.at]


def _count_minimisers(size: int, gram: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Minimisers that hold more than half a share of some slices' windows, and these windows (key null).

        Slices are taken together until a share of them is four windows, or
        ``HELD`` minimisers are at hand; then less than half a share is lost
        whatever the number of slices.
        """
        held, windows, minimisers = [], 0, 0
        for b in slices(batches, "text", SLICE):
            t = _Texts(b, size, gram)
            held.append(np.unique(t.low, return_counts=True))
            windows += len(t.low)
            minimisers += len(held[-1][0])
            if share * windows >= 4 or minimisers >= HELD:
                yield _often(held, share * windows / 2, windows)
                held, windows, minimisers = [], 0, 0
        if windows:
            yield _often(held, share * windows / 2, windows)

    return run


def _often(held: list[tuple[np.ndarray, np.ndarray]], least: float, windows: int) -> pa.RecordBatch:
    key, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    n = np.bincount(at, np.concatenate([n for _, n in held]), len(key)).astype(np.int64)
    often = n > least
    return pa.RecordBatch.from_arrays(
        [pa.array([*key[often].view(np.int64).tolist(), None], pa.int64()),
         pa.array([*n[often].tolist(), windows], pa.int64())], ["key", "n"])


def heavy_minimisers(docs: DataFrame, size: int, gram: int, buckets: int, most: int = MOST_HEAVY) -> np.ndarray:
    """The upper halves of the minimisers above half an even share, in order; never more than ``most``."""
    share = max(1 / most, 0.5 / buckets)
    counted = docs.mapInArrow(_count_minimisers(size, gram, share), "key bigint, n bigint").groupBy("key").agg(
        F.sum("n").alias("n"))
    # Both conditions look at the sums, so they share one shuffle and the texts are read once.
    total = counted.select(F.max(F.when(F.col("key").isNull(), F.col("n")))).scalar()
    halves = counted.where(F.when(F.col("key").isNotNull(), F.col("n")) > F.lit(share) * total).select(
        F.shiftright("key", 32).cast("int").alias("half")).distinct().toArrow()
    return np.sort(halves.column("half").to_numpy().astype(np.int32).view(np.uint32))


def _among(low: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """Which minimisers begin like a heavy one."""
    if not len(heavy):
        return np.zeros(len(low), bool)
    half = (low >> U64(32)).astype(np.uint32)
    return heavy[np.minimum(np.searchsorted(heavy, half), len(heavy) - 1)] == half


def _pack(size: int, gram: int, buckets: int, heavy: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        for b in slices(batches, "text", SLICE):
            t = _Texts(b, size, gram)
            if not len(t.at):
                continue
            ids = b.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            marks = b.column("mark").to_numpy(zero_copy_only=False).astype(np.int64)
            window = rolling(t.values, size)[t.at]
            spread = _among(t.low, heavy)
            # Runs of windows that go on by one word with one minimiser; a spread window is a run by itself.
            new = np.ones(len(t.at), bool)
            new[1:] = (np.diff(t.at) != 1) | (t.low[1:] != t.low[:-1]) | spread[1:] | spread[:-1]
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(t.at)) - 1
            goes = mix(np.where(spread[begin], window[begin], t.low[begin]) + U64(1)) % U64(buckets)
            w0, w1 = t.at[begin], t.at[last] + size - 1
            text = t.text[w0]
            place = w0 - t.first[text]
            # Earliest first, so that the first of equal strings is the earliest place.
            order = np.lexsort((place, marks[text], ids[text], goes))
            out = {k: [] for k in ("bucket", "packed", "doc_id", "mark", "place", "windows")}
            edges = np.flatnonzero(np.diff(goes[order], prepend=U64(2**63 + 1))) if len(order) else []
            edges = [*edges, len(order)]
            again = []
            for x, y in zip(edges, edges[1:], strict=False):
                part, strings, seen = [], [], {}
                for r in order[x:y].tolist():
                    s = t.data[t.starts[w0[r]]:t.ends[w1[r]]]
                    if s in seen:
                        if (ids[text[r]], marks[text[r]], place[r]) != seen[s]:
                            again.append(r)
                    else:
                        seen[s] = (ids[text[r]], marks[text[r]], place[r])
                        part.append(r)
                        strings.append(s)
                part = np.array(part)
                out["bucket"].append(int(goes[order[x]]))
                out["packed"].append(press.compress(b" ".join(strings)))
                out["doc_id"].append(ids[text[part]].tobytes())
                out["mark"].append(marks[text[part]].tobytes())
                out["place"].append(place[part].astype(np.int64).tobytes())
                out["windows"].append((last[part] - begin[part] + 1).astype(np.int32).tobytes())
            if again:  # every window of these also starts earlier
                r = np.array(again)
                out["bucket"].append(-1)
                out["packed"].append(b"")
                out["doc_id"].append(ids[text[r]].tobytes())
                out["mark"].append(marks[text[r]].tobytes())
                out["place"].append(place[r].astype(np.int64).tobytes())
                out["windows"].append((last[r] - begin[r] + 1).astype(np.int32).tobytes())
            # A slice's repeats need no bucket; they are dealt out by a negative number.
            bucket = [k if k >= 0 else -1 - int(ids[0] % buckets) for k in out["bucket"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int64()), *[pa.array(out[k], pa.binary()) for k in list(out)[1:]]], list(out))

    return run


def _merged(ids, marks, begin, end) -> pa.Table:
    """Word ranges of each text, joined where they touch."""
    order = np.lexsort((end, begin, marks, ids))
    ids, marks, begin, end = (x[order] for x in (ids, marks, begin, end))
    if len(ids):
        text = np.cumsum(np.concatenate([[0], (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])]))
        far = int(end.max()) + 1
        reach = np.maximum.accumulate(end + text * far) - text * far
        new = np.concatenate([[True], (text[1:] != text[:-1]) | (begin[1:] > reach[:-1])])
        at = np.flatnonzero(new)
        ids, marks, begin, end = ids[at], marks[at], begin[at], np.maximum.reduceat(reach, at)
    return pa.table({"doc_id": ids, "mark": marks, "begin": begin, "end": end})


def _equal(data: bytes, starts, ends, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Which windows beginning at words ``a`` and ``b`` are the same bytes."""
    edges = (starts[a], ends[a + size - 1], starts[b], ends[b + size - 1])
    return np.array([data[i:j] == data[k:m] for i, j, k, m in zip(*(e.tolist() for e in edges), strict=True)], bool)


def _judge(size: int):
    def run(group: pa.Table) -> pa.Table:
        cols = {c: [v.as_buffer() for v in group.column(c)] for c in ("doc_id", "mark", "place", "windows")}
        ids, marks, place = (np.frombuffer(b"".join(cols[c]), np.int64) for c in ("doc_id", "mark", "place"))
        windows = np.frombuffer(b"".join(cols["windows"]), np.int32).astype(np.int64)
        if group.column("bucket")[0].as_py() < 0:
            return _merged(ids, marks, place, place + windows + size - 1)
        unpack = zstandard.ZstdDecompressor()
        data = b" ".join([unpack.decompress(v.as_buffer()) for v in group.column("packed")])
        raw = np.frombuffer(data, np.uint8)
        gaps = np.flatnonzero(raw == 32)
        starts, ends = np.concatenate([[0], gaps + 1]), np.append(gaps, len(raw))
        hashed = rolling(hashes(raw, starts, ends), size)
        word = np.concatenate([[0], np.cumsum(windows + size - 1)])[:-1]  # first word of each string
        order = np.lexsort((place, marks, ids))
        count = windows[order]
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        of = np.repeat(order, count)
        at = word[of] + inner
        key = hashed[at]
        by = np.argsort(key, kind="stable")
        k = key[by]
        head = np.concatenate([[True], k[1:] != k[:-1]])
        first = by[np.flatnonzero(head)[np.cumsum(head) - 1]]  # the earliest window with this hash
        repeat = np.zeros(len(at), bool)
        later = by != first
        x, y = by[later], first[later]
        equal = np.concatenate([np.zeros(0, bool), *(
            _equal(data, starts, ends, at[x[i:i + COMPARED]], at[y[i:i + COMPARED]], size)
            for i in range(0, len(x), COMPARED))])
        same_place = (ids[of[x]] == ids[of[y]]) & (marks[of[x]] == marks[of[y]]) & (
            place[of[x]] + inner[x] == place[of[y]] + inner[y])
        repeat[x] = equal & ~same_place
        for x in x[~equal]:  # two sequences with one hash: compare with all earlier windows of that hash
            mine = data[starts[at[x]]:ends[at[x] + size - 1]]
            rivals = by[k == key[x]]
            repeat[x] = any(
                data[starts[at[y]]:ends[at[y] + size - 1]] == mine for y in rivals[rivals < x].tolist())
        hit = np.flatnonzero(repeat)
        begin = place[of[hit]] + inner[hit]
        return _merged(ids[of[hit]], marks[of[hit]], begin, begin + size)

    return run


def _pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as words joined by one space, compressed for the shuffle."""
    press = zstandard.ZstdCompressor(level=LEVEL)
    for b in slices(batches, "text", SLICE):
        packed = [press.compress(b" ".join(v.as_buffer().to_pybytes().split())) for v in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("mark"), pa.array(packed, pa.binary())],
                                         ["doc_id", "mark", "packed"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for b in slices(batches, "packed", SLICE // 4):
        n, removed, text = [], [], []
        for value, ranges in zip(b.column("packed"), b.column("ranges"), strict=True):
            parts = unpack.decompress(value.as_buffer()).split()
            gone = np.zeros(len(parts), bool)
            for r in ranges.as_py() or ():
                gone[r["begin"]:r["end"]] = True
            n.append(len(parts))
            removed.append(int(gone.sum()))
            text.append(b" ".join([p for p, g in zip(parts, gone.tolist(), strict=True) if not g]) if removed[-1]
                        else b" ".join(parts))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(text, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])


def repeated_ranges(docs: DataFrame, buckets: int, size: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, mark, begin, end): word ranges covered by windows that also start earlier."""
    heavy = heavy_minimisers(docs.select("text"), size, gram, buckets)
    packed = docs.mapInArrow(
        _pack(size, gram, buckets, heavy),
        "bucket bigint, packed binary, doc_id binary, mark binary, place binary, windows binary")
    tasks = min(MOST_TASKS, buckets // TASK_BUCKETS)
    if tasks > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        packed = packed.repartition(tasks, "bucket")  # the grouping below takes it over
    return packed.groupBy("bucket").applyInArrow(_judge(size), "doc_id bigint, mark bigint, begin bigint, end bigint")


def remove_repeats(docs: DataFrame, buckets: int, size: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row; ``kept`` is what is left, joined by one space, as bytes.

    The order of documents is by doc_id, then by a hash of the text where rows
    share a doc_id. Rows that share both are one document: each gets its
    result. A null doc_id comes before all others. A null or empty text, or
    one of fewer words than a window, loses nothing. Judged on the input.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # A missing doc_id takes the place of the least one; their marks differ in sign, and the missing ones come first.
    mark, sign = F.xxhash64("text"), F.lit(_LEAST)
    mark = F.when(F.col("doc_id").isNull(), mark.bitwiseOR(sign)).when(
        F.col("doc_id") == _LEAST, mark.bitwiseAND(F.lit(-1 - _LEAST))).otherwise(mark)
    keyed = docs.select(F.coalesce("doc_id", sign).alias("doc_id"), mark.alias("mark"), whole().alias("text"))
    ranges = repeated_ranges(keyed, buckets, size, gram).groupBy("doc_id", "mark").agg(
        F.collect_list(F.struct("begin", "end")).alias("ranges"))
    packed = keyed.mapInArrow(_pressed, "doc_id bigint, mark bigint, packed binary")
    missing = (F.col("doc_id") == _LEAST) & (F.col("mark") < 0)
    return packed.join(ranges, ["doc_id", "mark"], "left").select(
        F.when(~missing, F.col("doc_id")).alias("doc_id"), "packed", "ranges").mapInArrow(
        _kept, "doc_id bigint, n_words bigint, n_removed bigint, kept binary")


def buckets_for(spark, path: str) -> int:
    """Buckets for the Parquet files below ``path``: their number grows with the input."""
    return max(12, -(-total_bytes(spark, [path]) // BUCKET_BYTES))


#: The same for a database; the first of equal windows is the one of the smallest doc_id, then of the earliest start.
SQL = rf"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
flat AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts),
starts AS (
  SELECT doc_id, place AS start, string_agg(word, ' ') OVER w AS said, count(*) OVER w AS n
  FROM flat WINDOW w AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)),
windows AS (
  SELECT doc_id, start, row_number() OVER (PARTITION BY said ORDER BY doc_id, start) AS nth
  FROM starts WHERE n = {WINDOW}),
gone AS (
  SELECT doc_id, list(DISTINCT place) AS places
  FROM (SELECT doc_id, start + unnest(range({WINDOW})) AS place FROM windows WHERE nth > 1) GROUP BY doc_id),
removed AS (SELECT doc_id, unnest(places) AS place FROM gone),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
  FROM flat ANTI JOIN removed USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""
