"""Whitening against numpy's own solver and exact whole numbers."""

import math
from fractions import Fraction

import numpy as np
import pytest
from odd import SF
from pyspark.sql import functions as F

from quarry.llm import whitening
from quarry.llm.queries import REGISTRY


@pytest.mark.parametrize("values", [
    np.abs(np.random.default_rng(3).standard_normal(40)), np.r_[np.full(5, 5.0), np.ones(30)], np.r_[np.full(20, 1e6), np.full(20, 1e6 + 1e-6)],
    np.array([3.0]), np.array([2.0, 1.0]), np.r_[7.0, np.zeros(11)], np.geomspace(1e12, 1e-3, 30)])
def test_leading_pairs_of_known_matrices(values):
    n = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(n).standard_normal((n, n)))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    m = min(8, n)
    got, axes = whitening.leading_pairs(a, m)
    top = np.linalg.eigvalsh(a)[::-1]
    assert np.allclose(got, top[:m], rtol=0, atol=1e-13 * top[0])
    assert np.allclose(axes @ axes.T, np.eye(m), atol=1e-13)
    assert np.abs(a @ axes.T - axes.T * got).max() < 1e-13 * top[0]


def test_leading_pairs_of_a_diagonal_matrix():
    got, axes = whitening.leading_pairs(np.diag([1.0, 4.0, 4.0, 2.0]), 4)
    assert np.allclose(got, [4, 4, 2, 1]) and np.allclose(axes @ axes.T, np.eye(4), atol=1e-14)


def test_sturm_count_counts():
    d, e = np.array([1.0, 2.0, 3.0]), np.array([0.5, 0.0])
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    for x in (-1.0, 1.0, 1.5, 2.5, 3.5):
        assert whitening.sturm_count(d, e, np.array([x]))[0] == (values < x).sum()


def _brute(vectors):
    """n, exact deviations, eigenvalues and axes (numpy), trace, centred x."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    z = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums, strict=True)] for v in x])
    cov = z.T @ z / n
    w, axes = np.linalg.eigh(cov)
    return n, deviation, w[::-1], axes.T[::-1], np.trace(cov), z


def test_query_matches_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    n, deviation, values, axes, trace, z = _brute([r.embedding for r in rows])
    got = {}
    for r in REGISTRY["op11_embedding_whitening"](spark, SF).collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == n and all(set(c) == set(range(1, 9)) for c in got.values())
    want = z @ axes[:8].T / np.sqrt(values[:8])
    white = np.array([[got[r.vec_id][c].whitened for c in range(1, 9)] for r in rows])
    white *= np.sign((white * want).sum(axis=0))
    assert np.allclose(white, want, atol=1e-8)
    for r, d in zip(rows, deviation, strict=True):
        first = got[r.vec_id][1]
        assert (first.n, first.deviation) == (n, d) and first.identity_error < 1e-9
        assert all(math.isclose(got[r.vec_id][c].explained, values[c - 1] / trace, rel_tol=1e-9) for c in range(1, 9))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [1.0, -inf]), (6, []), (7, [1.0]), (8, [1.0, 2.0, 3.0]),
            (None, [-2.0, 7.25]), (9, [1e5, -1e-9]), (10, [1e300, 1.0])]
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("key", F.lit("x")).withColumn("vector", F.lit(1)).repartition(parts)
        fit = whitening.whiten(df)
        n, deviation, values, axes, trace, z = _brute([[0.5, 1.0], [0.5, 1.0], [-2.0, 7.25], [1e5, -1e-9]])
        got = sorted(((r.key is None, r.key or 0, r.deviation, r.whitened) for r in fit.rows.collect()), key=lambda r: r[:3])
        assert [r[2] for r in got] == [deviation[i] for i in (0, 1, 3, 2)] and fit.n == 4
        assert np.allclose(np.abs([r[3] for r in got]), np.abs(z @ axes.T / np.sqrt(values))[[0, 1, 3, 2]], atol=1e-6)
        assert fit.identity_error < 1e-6 and math.isclose(fit.trace, trace)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    fit = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    assert fit.rows.count() == 0 and fit.values == []


def test_low_rank_and_exact_deviation(spark):
    rows = [(i, [i * 1.0, 2.0 * i, 5.0]) for i in range(50)]
    fit = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    assert len(fit.values) == 1 and fit.identity_error < 1e-9
    rng = np.random.default_rng(5)
    x = rng.integers(-2**61, 2**61, (20, 3))
    sums = [sum(int(v) for v in x[:, i]) for i in range(3)]
    assert whitening.exact_deviation(x, 20, sums) == [sum((20 * int(c) - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
