"""Whitening against a dense eigendecomposition of the whole covariance."""

import math

import numpy as np
import pytest

from adtally.llm import whitening
from adtally.llm.queries import QUERIES


def dense(vectors):
    """vec_id -> whole numbers; n, exact deviations, eigenvalues and vectors by the definition."""
    usable = {i: [math.floor(1024 * float(c)) + 100000 for c in v] for i, v in vectors
              if v and all(c is not None and math.isfinite(c) for c in v)}
    n = len(usable)
    sums = [sum(col) for col in zip(*usable.values())]
    deviation = {i: sum((n * x - s) ** 2 for x, s in zip(row, sums)) for i, row in usable.items()}
    centred = {i: np.array([(n * x - s) / n for x, s in zip(row, sums)]) for i, row in usable.items()}
    matrix = np.array(list(centred.values()))
    value, vector = np.linalg.eigh(matrix.T @ matrix / n)
    return n, deviation, centred, value[::-1], vector[:, ::-1]


def compare(rows, vectors, components=8):
    n, deviation, centred, value, vector = dense(vectors)
    got = {}
    for r in rows:
        got.setdefault(r.component, {})[r.vec_id] = r
    assert sorted(got) == list(range(1, min(components, int((value > 1e-9 * value[0]).sum())) + 1))
    for c, of in got.items():
        assert set(of) == set(deviation)
        white = {i: centred[i] @ vector[:, c - 1] / np.sqrt(value[c - 1]) for i in of}
        most = max(of, key=lambda i: abs(white[i]))
        sign = np.sign(white[most] * of[most].whitened)
        assert max(abs(white[i] * sign - of[i].whitened) for i in of) < 1e-8
        for i, r in of.items():
            assert r.n == n and r.deviation == deviation[i]
            assert r.explained == pytest.approx(value[c - 1] / value.sum(), rel=1e-9)
            assert 0 <= r.identity_error < 1e-8


def test_query_equals_dense(spark, sf):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    compare(QUERIES["op11_lanczos_whitening"](spark, sf).collect(), vectors)


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "x", 3.0) for i, v in vectors],
                                 "vec_id bigint, embedding array<double>, component string, n double")


@pytest.mark.parametrize("case", ["steep", "low rank", "narrow", "few rows", "doubled", "far away"])
def test_shapes(spark, case):
    draw = np.random.default_rng(3)
    if case == "steep":  # deviations over five orders of magnitude
        matrix = draw.standard_normal((400, 20)) * 10.0 ** np.linspace(3, -2, 20) @ np.linalg.qr(draw.standard_normal((20, 20)))[0]
    elif case == "low rank":
        matrix = np.hstack([draw.integers(-9, 9, (200, 3)) / 8.0] * 4)
    elif case == "narrow":
        matrix = draw.standard_normal((50, 3))
    elif case == "few rows":
        matrix = draw.standard_normal((4, 30))
    elif case == "doubled":
        matrix = np.repeat(draw.standard_normal((60, 12)), 2, axis=0)
    else:
        matrix = draw.standard_normal((100, 10)) + 1e6
    vectors = list(enumerate(matrix.tolist()))
    compare(whitening.whiten(table(spark, vectors)).collect(), vectors)


def test_stops_when_converged(spark, monkeypatch):
    """A dominant subspace is found long before all dimensions are used up, which would take 96 products."""
    products, added = [], whitening._added
    monkeypatch.setattr(whitening, "_added", lambda *a: products.append(1) or added(*a))
    draw = np.random.default_rng(4)
    scale = np.concatenate([2.0 ** np.arange(9, -1, -1), np.full(118, 0.004)])
    vectors = list(enumerate((draw.standard_normal((300, 128)) * scale).tolist()))
    compare(whitening.whiten(table(spark, vectors), components=3, block=4).collect(), vectors, 3)
    assert len(products) < 48


def test_unusable_rows(spark):
    good = [(i, [math.sin(i), math.cos(3 * i), 0.1 * i]) for i in range(9)]
    bad = [(20, None), (21, []), (22, [1.0, None, 2.0]), (23, [1.0, float("nan"), 2.0]), (24, [float("inf"), 0.0, 0.0])]
    compare(whitening.whiten(table(spark, good + bad)).collect(), good)
    short = whitening.whiten(table(spark, [*good, (30, [1.0, 2.0])])).collect()
    compare(short, good)  # of two lengths the frequent one
    repeated = whitening.whiten(table(spark, [*good, *good, (None, good[0][1])])).collect()
    assert {r.n for r in repeated} == {19} and sum(r.vec_id is None for r in repeated) == 3
    assert whitening.whiten(table(spark, bad)).collect() == []
    assert whitening.whiten(table(spark, good).limit(0)).collect() == []
    assert whitening.whiten(table(spark, good[:1] * 3)).collect() == []
    assert whitening.whiten(table(spark, bad)).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_beyond_64_bits_is_null(spark):
    vectors = [(i, [1e12 * i]) for i in range(4)]
    assert {r.deviation for r in whitening.whiten(table(spark, vectors)).collect()} == {None}
