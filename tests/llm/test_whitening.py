"""Whitening against exact arithmetic, numpy and odd input."""

from __future__ import annotations

from fractions import Fraction
from math import floor

import numpy as np
import pytest

from closebook.llm import whitening

VECTORS = "vec_id long, embedding array<double>, n int, whitened string"


def frame(spark, vectors):
    return spark.createDataFrame([(k, v, 1, "x") for k, v in enumerate(vectors)], VECTORS)


def counted(vectors):
    return [[floor(1024 * c) + 100_000 for c in v] for v in vectors]


def exact_covariance(x):
    n, size = len(x), len(x[0])
    mean = [Fraction(sum(r[k] for r in x), n) for k in range(size)]
    return [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n for j in range(size)] for i in range(size)]


def test_covariance_is_exact(spark):
    random = np.random.default_rng(1)
    vectors = random.normal(size=(60, 5)).tolist()
    docs = frame(spark, vectors)
    rows, size, n = whitening._remaining(docs, "vec_id", "embedding")
    model = whitening.Whitening(n, whitening._sums(rows, size), np.zeros(0), np.zeros((0, 0)), 0.0)
    x = counted(vectors)
    assert model.sums == [sum(r[k] for r in x) for k in range(5)]
    exact = [[float(v) for v in row] for row in exact_covariance(x)]
    assert whitening._covariance(rows, model).tolist() == exact  # to the last bit: both round once


def test_squares_of_all_sizes():
    random = np.random.default_rng(2)
    for top in (10, 1 << 30, 1 << 47, 1 << 50, 1 << 61):
        z = random.integers(-top, top, (50, 4))
        a, b, c = whitening.pair_squares(z)
        found = [(int(p) << 48) + (int(q) << 25) + int(r) for p, q, r in zip(a, b, c, strict=True)]
        rows = z.tolist()
        wanted = [sum((r[i] if i == j else r[i] + r[j]) ** 2 for r in rows) for i in range(4) for j in range(i, 4)]
        assert found == wanted or top == 1 << 61  # sums of values this large need Python's integers, as below
    z = random.integers(-(1 << 61), 1 << 61, (50, 4)).astype(object) * 12345
    a, b, c = whitening.pair_squares(z)
    found = [(int(p) << 48) + (int(q) << 25) + int(r) for p, q, r in zip(a, b, c, strict=True)]
    assert found == [sum((r[i] if i == j else r[i] + r[j]) ** 2 for r in z.tolist()) for i in range(4) for j in range(i, 4)]


def test_whitened_rows(spark):
    random = np.random.default_rng(3)
    vectors = (random.normal(size=(300, 10)) @ random.normal(size=(10, 10))).tolist()
    rows = sorted(whitening.whiten(frame(spark, vectors).repartition(7)).collect())
    x = np.array(counted(vectors), dtype=float)
    sums = [sum(c) for c in zip(*counted(vectors), strict=True)]
    assert [r.vec_id for r in rows] == list(range(300))
    assert [int(r.deviation) for r in rows] == [sum((300 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in counted(vectors)]
    values, columns = np.linalg.eigh(np.cov(x.T, bias=True))
    wanted = (x - x.mean(axis=0)) @ columns[:, ::-1][:, :8] / np.sqrt(values[::-1][:8])
    found = np.array([r.whitened for r in rows])
    assert found == pytest.approx(wanted * np.sign((found * wanted).sum(axis=0)), abs=1e-8)
    assert rows[0].explained == pytest.approx(values[::-1][:8] / values.sum())
    assert {r.n for r in rows} == {300} and rows[0].identity_error < 1e-9 and len({r.identity_error for r in rows}) == 1


def test_odd_vectors(spark):
    good = [[1.0, 2.0], [3.0, -1.0], [3.0, -1.0], [0.5, 7.25]]
    bad = [None, [], [1.0], [1.0, 2.0, 3.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1e300, 1.0], [0.0, -(2.0**42)]]
    docs = frame(spark, [*good, *bad]).unionByName(frame(spark, [[2.0, 2.0]]).selectExpr("CAST(NULL AS BIGINT) AS vec_id", "embedding", "n", "whitened"))
    rows = whitening.whiten(docs).collect()
    assert sorted(str(r.vec_id) for r in rows) == ["0", "1", "2", "3", "None"] and {r.n for r in rows} == {5}
    assert all(len(r.whitened) == 2 for r in rows) and rows[0].identity_error < 1e-9
    huge = whitening.whiten(frame(spark, [[2.0**41, 1.0], [-(2.0**41), 0.0], [5.0, 3.0]])).collect()
    assert len(huge) == 3 and huge[0].identity_error < 1e-4


def test_no_variance_and_no_rows(spark):
    one = whitening.whiten(frame(spark, [[1.0, 2.0, 3.0]])).first()
    assert (one.n, one.deviation, one.whitened, one.explained, one.identity_error) == (1, 0, [0.0] * 3, [0.0] * 3, 0.0)
    flat = whitening.whiten(frame(spark, [[1.0, 2.0], [2.0, 2.0], [5.0, 2.0]])).collect()
    assert all(r.whitened[1] == 0 for r in flat) and flat[0].explained == pytest.approx([1.0, 0.0]) and flat[0].identity_error < 1e-9
    for nothing in (frame(spark, []), frame(spark, [None, []])):
        assert whitening.whiten(nothing).count() == 0
        assert whitening.fit(nothing).n == 0


def test_floats_count_as_doubles(spark):
    docs = spark.createDataFrame([(1, [0.1, 0.2]), (2, [0.3, -0.7])], "vec_id long, embedding array<float>")
    rows = docs.selectExpr("vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS embedding")
    assert sorted(map(tuple, whitening.whiten(docs).collect())) == sorted(map(tuple, whitening.whiten(rows).collect()))
