"""A quality classifier by compression.

Two zstandard dictionaries are trained, on good and on bad labelled texts. A
text is compressed with each, in blocks; the one that knows its kind of
writing compresses it better. The difference of the two sizes, over the length
of the text, becomes a probability by logistic regression on labelled rows
that had no part in the dictionaries. How short the text is goes in as well,
since the sizes of a few words say little.

The model is fitted on a bounded sample: ``DICTIONARY_ROWS`` labelled rows of
each class and ``CALIBRATION_ROWS`` further ones, those with the smallest hash
of doc_id. The dictionaries see ``DRAWN`` blocks from all over each text, the
calibration whole texts, as the scores do.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from adtally.llm.text import U64, mix, slices, whole

DICTIONARY_ROWS, CALIBRATION_ROWS = 1500, 3000
DICTIONARY_BYTES, BLOCK_BYTES, LEVEL = 112 * 1024, 1024, 3
#: Blocks of a text that go into a dictionary.
DRAWN = 6
#: Bytes added to a length, so that very short texts count as undecided.
PRIOR_BYTES = 64
RIDGE = 0.5
THRESHOLD = 0.3
_PICKED = ["doc_id", "quality", "use"]
_PICKED_SCHEMA = "doc_id bigint, quality int, use string"


class Model(NamedTuple):
    good: bytes
    bad: bytes
    #: Weights of the difference, of shortness and of the constant.
    weights: tuple[float, float, float]

    def score(self, measures: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(measures @ np.array(self.weights), -700, 700)))


def _blocks(data: bytes) -> list[bytes]:
    return [data[i:i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]


def _drawn(doc_id: int, data: bytes) -> list[bytes]:
    """At most DRAWN blocks, those with the smallest hashes of doc_id and place, in order."""
    n = -(-len(data) // BLOCK_BYTES)
    order = np.argsort(mix(np.arange(n, dtype=U64) + mix(np.array([doc_id], np.int64).view(U64))), kind="stable")
    return [data[i * BLOCK_BYTES:(i + 1) * BLOCK_BYTES] for i in np.sort(order[:DRAWN]).tolist()]


def _draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        blocks = [[] if use == "calibration" else _drawn(i, v.as_buffer().to_pybytes()) for i, use, v in zip(
            b.column("doc_id").to_pylist(), b.column("use").to_pylist(), b.column("text"), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in _PICKED), pa.array(blocks, pa.list_(pa.binary()))], [*_PICKED, "blocks"])


def _dictionary(texts: list[list[bytes]]) -> bytes:
    blocks = [b for t in texts for b in t]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:  # too few samples to choose from: they are the dictionary
        return b"\n".join(blocks)[-DICTIONARY_BYTES:]


class _Differences:
    def __init__(self, model: Model):
        self.press = [self._compressor(d) for d in (model.good, model.bad)]

    @staticmethod
    def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
        if not dictionary:
            return zstandard.ZstdCompressor(level=LEVEL)
        data = zstandard.ZstdCompressionDict(dictionary)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=data)

    def of(self, texts: list[bytes]) -> np.ndarray:
        """For each text the difference, above 0 if the good dictionary fits better, its shortness and 1."""
        out = np.ones((len(texts), 3))
        for row, data in zip(out, texts, strict=True):
            good, bad = (sum(len(p.compress(b)) for b in _blocks(data)) for p in self.press)
            row[:2] = (bad - good) / (len(data) + PRIOR_BYTES), PRIOR_BYTES / (len(data) + PRIOR_BYTES)
        return out


def _measure(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        differences = _Differences(model)
        for b in slices(batches, "text"):
            measures = differences.of([v.as_buffer().to_pybytes() for v in b.column("text")])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in _PICKED), pa.array(measures.tolist(), pa.list_(pa.float64()))],
                [*_PICKED, "measures"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Weights by Newton's method with a ridge."""
    scale = np.append(np.where(x[:, :2].std(axis=0) > 0, x[:, :2].std(axis=0), 1.0), 1.0)
    design, weights = x / scale, np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (y - p) - RIDGE * weights
        bend = (design * (p * (1 - p))[:, None]).T @ design + RIDGE * np.eye(3)
        step = np.linalg.solve(bend, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple((weights / scale).tolist())


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows whose labels no model may see."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows of ``docs`` that are not held out.

    Rows without doc_id or label take no part; of several labels for a doc_id
    the smallest counts. Without rows of either class every score is the
    share of good ones, or 0.5.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(
        F.min("quality").alias("quality")).withColumn("order", F.xxhash64("doc_id"))
    chosen = [(known.where(f"quality = {q}").orderBy("order", "doc_id").limit(DICTIONARY_ROWS), f"class{q}")
              for q in (0, 1)]
    # The others are those with the largest hash; a row of both samples counts for the dictionaries only.
    chosen.append((known.orderBy(F.desc("order"), "doc_id").limit(CALIBRATION_ROWS), "calibration"))
    picked = None
    for rows, use in chosen:
        rows = rows.select("doc_id", "quality", F.lit(use).alias("use"))
        picked = rows if picked is None else picked.union(rows)
    # A few thousand rows of numbers at most, by the limits above.
    picked = F.broadcast(docs.sparkSession.createDataFrame(picked.toArrow(), _PICKED_SCHEMA))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole().alias("text")).join(picked, "doc_id")
    texts = texts.select(*_PICKED, "text")

    def taken(run, column: str, uses: list[str]) -> list[dict]:
        """A row for each doc_id and use; of the texts only what ``run`` makes of them leaves the tasks."""
        rows = texts.where(F.col("use").isin(uses)).mapInArrow(run, f"{_PICKED_SCHEMA}, {column}")
        return rows.dropDuplicates(["doc_id", "use"]).toArrow().sort_by(
            [("doc_id", "ascending"), ("use", "ascending")]).to_pylist()

    sample = taken(_draw, "blocks array<binary>", ["class0", "class1", "calibration"])
    by_use: dict[str, list[dict]] = {"class0": [], "class1": [], "calibration": []}
    for row in sample:
        by_use[row["use"]].append(row)
    if not by_use["class0"] or not by_use["class1"]:
        good = len(by_use["class1"]) / max(1, len(sample))
        odds = float(np.log((good + 1e-9) / (1 - good + 1e-9))) if sample else 0.0
        return Model(b"", b"", (0.0, 0.0, odds))
    model = Model(*(_dictionary([r["blocks"] for r in by_use[f"class{q}"]]) for q in (1, 0)), (1.0, 0.0, 0.0))
    used = {r["doc_id"] for q in (0, 1) for r in by_use[f"class{q}"]}
    rest = [r for r in by_use["calibration"] if r["doc_id"] not in used]
    some = ["calibration"]
    if len({r["quality"] for r in rest}) < 2:
        some, used = [*some, "class0", "class1"], set()
    rest = [r for r in taken(_measure(model), "measures array<double>", some) if r["doc_id"] not in used]
    return model._replace(weights=_logistic(
        np.array([r["measures"] for r in rest]), np.array([r["quality"] for r in rest], float)))


def score(model: Model) -> object:
    """A function of a binary column: the probability that a text is good."""

    @F.arrow_udf(DoubleType())
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        differences = _Differences(model)
        for column in columns:
            yield pa.array(model.score(differences.of([v.as_buffer().to_pybytes() for v in column])))

    return run


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    A null text scores as an empty one. A null doc_id is not held out.
    Repeated rows get a row each; an empty table gives an empty result.
    """
    scored = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), score(fit(docs, labels))(whole()).alias("score"))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def good_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted good, all columns as they are."""
    return docs.where(score(fit(docs, labels))(whole()) >= THRESHOLD)
