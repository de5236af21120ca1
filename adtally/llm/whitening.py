"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Rows become whole numbers, so that their sums are exact, and are centred
before anything is multiplied. The matrix X of centred rows stays distributed.
The bidiagonalisation alternates two products with it, for a block of ``BLOCK``
directions at a time, since every product reads all rows:

* ``X q`` for the next right directions q, which gives the next left
  directions after full reorthogonalisation against all earlier ones, and
* ``Xᵀ u`` for these, which gives the right directions after the next, again
  fully reorthogonalised.

A left direction is as long as the table. It is never stored: each is X times
a short vector, which is kept instead, and what products of left directions
need is added up over the rows. Only sums leave the tasks, as rows that Spark
aggregates; nothing of the length of the table is shuffled or collected. The
small band matrix (bidiagonal in blocks) has the singular values of X; its SVD
ends the loop once the wanted components have converged, at the latest when
all dimensions are used up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.session import stage

SCALE, SHIFT = 1024, 100_000
COMPONENTS, BLOCK = 8, 8
#: A component has converged when its residual is below this share of the largest singular value.
CONVERGED = 1e-13
#: Directions with less than this share of the largest singular value carry rounding errors only.
NEGLIGIBLE = 1e-11
#: Whole numbers beyond this are cut to it.
MOST = 2**52
_ROW_BYTES = 8 * 2**20


class Fit(NamedTuple):
    n: int
    #: Exact sums by dimension.
    sums: list[int]
    #: A component in each row, by falling eigenvalue.
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _chunks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    size = max(1, _ROW_BYTES // (8 * dims))
    for b in batches:
        for first in range(0, b.num_rows, size):
            yield b.slice(first, size)


class _Centre(NamedTuple):
    """Whole part and rest of the mean, so that a centred value is rounded once."""

    whole: np.ndarray
    rest: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest


def _centre(n: int, sums: list[int]) -> _Centre:
    return _Centre(np.array([s // n for s in sums], np.int64), np.array([s % n / n for s in sums]))


def _added(rows: DataFrame, dims: int, width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``of``, ``width`` numbers for some rows, over all rows.

    A task adds its rows up and sends ``width`` numbers, which are added by place.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(width), False
        for b in _chunks(batches, dims):
            total += of(_matrix(b.column("x"), dims))
            seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["place", "value"])

    sums = rows.select("x").mapInArrow(run, "place bigint, value double").groupBy("place").agg(F.sum("value").alias("value"))
    found = sums.toArrow()  # width rows
    out = np.zeros(width)
    out[found.column("place").to_numpy()] = found.column("value").to_numpy()
    return out


def whole_rows(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): usable vectors as whole numbers.

    A vector that is null, empty or holds a null or a number that is not
    finite is dropped. Of vectors of several lengths those of the most
    frequent one stay, of equally frequent ones those of the greatest.
    """
    entry = F.col("e")
    rows = embeddings.select(F.col("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    rows = rows.where(F.size("e") > 0).where(F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    number = F.transform(entry, lambda c: (F.floor(F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), c * SCALE))) + SHIFT).cast("bigint"))
    return rows.select("vec_id", number.alias("x"))


def _exact_sums(rows: DataFrame, dims: int) -> list[int]:
    """Sums by dimension. Those of a task are split in two halves, which cannot overflow before they are added as decimals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for b in _chunks(batches, dims):
            x = _matrix(b.column("x"), dims)
            high += (x >> 26).sum(axis=0)
            low += (x & (2**26 - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(high), pa.array(low)], ["dim", "high", "low"])

    halves = rows.select("x").mapInArrow(run, "dim bigint, high bigint, low bigint").groupBy("dim").agg(
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
    return [(int(r["high"]) << 26) + int(r["low"]) for r in halves.orderBy("dim").collect()]  # a row for each dimension


def _orthonormal(candidate: np.ndarray, gram: Callable[[np.ndarray, np.ndarray], np.ndarray], basis: np.ndarray,
                 least: float) -> tuple[np.ndarray, np.ndarray]:
    """``candidate`` without its parts along ``basis``, made orthonormal under ``gram``, and the triangle that undoes it.

    Everything is done twice, which is enough for orthogonality to rounding.
    Directions shorter than ``least`` are left out.
    """
    triangle = np.eye(candidate.shape[1])
    for _ in range(2):
        both = gram(np.hstack([basis, candidate]), candidate)
        known = basis.shape[1]
        candidate = candidate - basis @ both[:known]
        own = both[known:] - both[:known].T @ both[:known]
        value, vector = np.linalg.eigh((own + own.T) / 2)
        size = np.sqrt(np.maximum(value, 0))
        keep = size > least
        least = 0.5  # of unit length the second time
        candidate = candidate @ (vector[:, keep] / size[keep])
        triangle = (vector[:, keep] * size[keep]).T @ triangle
    return candidate, triangle


def fit(rows: DataFrame, components: int = COMPONENTS, block: int = BLOCK) -> Fit | None:
    """Mean and leading components of ``rows`` (x), a staged table; None for one without variance."""
    shape = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    n, dims = int(shape[0]), int(shape[1] or 0)
    if not n:
        return None
    sums = _exact_sums(rows, dims)
    centre = _centre(n, sums)
    trace = float(_added(rows, dims, 1, lambda x: np.square(centre.of(x)).sum(keepdims=True).ravel())[0]) / n
    if not trace:
        return None
    scale = np.sqrt(trace * n)

    def left_gram(w: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Products of the left directions X w and X v."""
        def of(x: np.ndarray) -> np.ndarray:
            c = centre.of(x)
            return ((c @ w).T @ (c @ v)).ravel()

        return _added(rows, dims, w.shape[1] * v.shape[1], of).reshape(w.shape[1], v.shape[1])

    def back(w: np.ndarray) -> np.ndarray:
        """Xᵀ u for the left directions u = X w."""
        def of(x: np.ndarray) -> np.ndarray:
            c = centre.of(x)
            return (c.T @ (c @ w)).ravel()

        return _added(rows, dims, dims * w.shape[1], of).reshape(dims, w.shape[1])

    def plain(w: np.ndarray, v: np.ndarray) -> np.ndarray:
        return w.T @ v

    draw = np.random.default_rng(1)
    right, left = np.zeros((dims, 0)), np.zeros((dims, 0))  # left: u = X @ left
    band = np.zeros((0, 0))  # X @ right = U @ band
    following = draw.standard_normal((dims, min(block, dims)))
    while True:
        following, _ = _orthonormal(following, plain, right, 1e-6)
        if following.shape[1] == 0:
            break
        grown, _ = _orthonormal(following, left_gram, left, NEGLIGIBLE * scale)
        new_left = grown
        left_all = np.hstack([left, new_left])
        right = np.hstack([right, following])
        # X q in terms of the left directions: the parts along earlier ones and along its own.
        product = back(new_left) if new_left.shape[1] else np.zeros((dims, 0))
        wide = np.zeros((left_all.shape[1], right.shape[1]))
        wide[:band.shape[0], :band.shape[1]] = band
        if band.shape[0]:
            wide[:band.shape[0], band.shape[1]:] = left_back.T @ following
        wide[band.shape[0]:, band.shape[1]:] = product.T @ following
        left_back = product if not band.shape[0] else np.hstack([left_back, product])
        band, left = wide, left_all
        outer, value, inner = np.linalg.svd(band)
        wanted = min(components, len(value))
        # What Xᵀ u has beyond the right directions found so far.
        beyond = left_back - right @ (right.T @ left_back)
        residual = np.linalg.norm(beyond @ outer[:, :wanted], axis=0)
        if right.shape[1] >= dims or (right.shape[1] >= min(dims, components + block)
                                      and residual.max(initial=0) <= CONVERGED * value[0]):
            break
        # The next right directions; where they have run out, the search goes on in any other direction.
        following = product - right @ (right.T @ product)
        short = np.linalg.norm(following, axis=0) <= 1e-12 * scale
        following = following[:, ~short] / np.maximum(np.linalg.norm(following[:, ~short], axis=0), 1e-300)
        missing = min(block, dims - right.shape[1]) - following.shape[1]
        if missing > 0:
            following = np.hstack([following, draw.standard_normal((dims, missing)) / np.sqrt(dims)])
    _, value, inner = np.linalg.svd(band)
    keep = value[:components] > NEGLIGIBLE * scale
    found = (right @ inner[:len(value)].T)[:, :components][:, keep].T
    found *= np.sign(found[np.arange(len(found)), np.abs(found).argmax(axis=1)])[:, None]
    return Fit(n, sums, found, np.square(value[:components][keep]) / n, trace)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sums of (n * x - S) squared, exact; null where that is beyond 64 bits."""
    mean = np.array([s / n for s in sums])
    if (n * (np.abs(x - mean).max(initial=0) + 1)) ** 2 * x.shape[1] < 2**62 and n * (np.abs(x).max(initial=0) + 1.0) < 2**62:
        away = n * x - np.array(sums, np.int64)
        return pa.array((away * away).sum(axis=1), pa.int64())
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return pa.array([v if v < 2**63 else None for v in exact], pa.int64())


def _projected(found: Fit, dims: int):
    centre = _centre(found.n, found.sums)
    weights = (found.components / np.sqrt(found.eigenvalues)[:, None]).T
    kept = len(found.components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches, dims):
            x = _matrix(b.column("x"), dims)
            white = centre.of(x) @ weights
            again = pa.array(np.repeat(np.arange(len(x)), kept))
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(again), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x))),
                _deviations(x, found.n, found.sums).take(again), pa.array(white.ravel())],
                ["vec_id", "component", "deviation", "whitened"])

    return run


def whiten(embeddings: DataFrame, components: int = COMPONENTS, block: int = BLOCK) -> DataFrame:
    """A row for each usable vector of ``embeddings`` (vec_id, embedding) and component.

    Columns: vec_id, component (from 1, by falling eigenvalue), n, deviation,
    whitened, explained, identity_error, as the module and ``Fit`` describe.
    Which vectors are usable says ``whole_rows``. There are as many
    components as there are dimensions with variance, ``components`` at most:
    a table whose vectors are all equal, or an empty one, gives no rows. A
    null vec_id stays null, repeated rows count as often as they are there,
    other columns are ignored. Equal eigenvalues leave the choice of their
    components open; it is the same for all rows. ``deviation`` is null where
    it is beyond 64 bits.
    """
    spark = embeddings.sparkSession
    rows = stage(spark, whole_rows(embeddings), "whole-rows")
    lengths = rows.groupBy(F.size("x").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims"))
    most = lengths.first()
    rows = rows.where(F.size("x") == (most["dims"] if most else 0))
    found = fit(rows, components, block)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    layout = f"vec_id {id_type}, component int, deviation bigint, whitened double"
    if found is None or not len(found.components):
        empty = spark.createDataFrame([], layout)
        return empty.select("vec_id", "component", F.lit(0).cast("bigint").alias("n"), "deviation", "whitened",
                            F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error"))
    dims, kept = most["dims"], len(found.components)
    centre = _centre(found.n, found.sums)
    weights = (found.components / np.sqrt(found.eigenvalues)[:, None]).T

    def moments(x: np.ndarray) -> np.ndarray:
        white = np.hstack([centre.of(x) @ weights, np.ones((len(x), 1))])
        return (white.T @ white).ravel()

    total = _added(rows, dims, (kept + 1) ** 2, moments).reshape(kept + 1, kept + 1) / found.n
    covariance = total[:kept, :kept] - np.outer(total[kept, :kept], total[kept, :kept])
    error = float(np.abs(covariance - np.eye(kept)).max())
    shares = F.array(*[F.lit(float(e / found.trace)) for e in found.eigenvalues])
    return rows.mapInArrow(_projected(found, dims), layout).select(
        "vec_id", "component", F.lit(found.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("component")).alias("explained"), F.lit(error).alias("identity_error"))
