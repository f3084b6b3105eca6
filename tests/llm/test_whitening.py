"""Spectrum slicing against numpy's eigenvalues; the query against a plain computation with fractions."""

import math

import numpy as np
import pytest

from tastegraph.llm import whitening
from tastegraph.llm.common import read_table

rng = np.random.default_rng(7)


def symmetric(values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    m = q @ np.diag(values) @ q.T
    return (m + m.T) / 2


MATRICES = {
    "spread": symmetric([9, 7, 4, 1, 0.5, 0.1]), "close": symmetric([1 + 1e-9, 1, 1 - 1e-9, 0.2, 0]), "equal": symmetric([5, 5, 5, 5, 1, 1]),
    "identity": np.eye(6), "zero": np.zeros((5, 5)), "one": np.array([[3.0]]), "rank one": np.outer(np.arange(5.0), np.arange(5.0)),
    "indefinite": symmetric([3, 1, -2, -8]), "antidiagonal": np.eye(4)[::-1].copy(), "large": symmetric(np.sort(rng.random(64))[::-1] * 1e9),
    "diagonal": np.diag([1.0, 4, 2, 3, 4]), "tiny": symmetric([1e-12, 3e-13, 0, 0]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_leading(name):
    matrix = MATRICES[name]
    want = np.linalg.eigvalsh(matrix)[::-1][:4]
    values, vectors = whitening.leading(matrix, 4)
    size = max(np.abs(matrix).max(), 1e-300)
    assert np.allclose(values, want, rtol=0, atol=1e-13 * size * len(matrix))
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-6
    assert np.abs(matrix @ vectors.T - vectors.T * values).max() <= 1e-12 * size * len(matrix)


@pytest.mark.parametrize("name", MATRICES)
def test_counts(name):
    matrix = MATRICES[name]
    values = np.linalg.eigvalsh(matrix)
    for shift in rng.uniform(values.min() - 1, values.max() + 1, 20):
        assert whitening.above(matrix, shift) == int((values > shift).sum())


def plain(rows):
    """Per row (vec_id, deviation, exact whitened up to sign), and e / trace, by numpy on exactly centred numbers."""
    usable = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in usable})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    centred = np.array([[(n * x[k] - sums[k]) / n for k in range(d)] for x in fit])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    out = []
    for i, x in usable:
        z = [n * x[k] - sums[k] for k in range(d)]
        w = (np.array(z) / n) @ vectors / np.sqrt(values)
        out.append((i, sum(v * v for v in z), w))
    return n, out, values / np.trace(cov)


def check(got, rows, alike=1e-6):
    n, want, explained = plain(rows)
    held = {}
    for r in got:
        held.setdefault((r.vec_id, r.deviation), []).append(r)
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained - explained[r.component - 1]) < 1e-9
    signs = {}
    assert len(got) == 4 * len(want)
    for i, deviation, w in want:
        for r in held[i, deviation]:
            sign = signs.setdefault(r.component, 1 if abs(r.whitened - w[r.component - 1]) < abs(r.whitened + w[r.component - 1]) else -1)
            assert abs(sign * r.whitened - w[r.component - 1]) < alike


def test_query_rows(spark, folder):
    from tastegraph.llm.queries import REGISTRY

    rows = [(r.vec_id, r.embedding) for r in read_table(spark, folder, "embeddings").collect()]
    check(REGISTRY["op12_whitening"](spark, folder).collect(), rows)


def test_odd_rows(spark):
    values = (rng.standard_normal((40, 6)) * [5, 4, 3, 2, 1, 1] + 300).tolist()
    odd = [None, [1.0, None, 1.0, 1.0, 1.0, 1.0], [math.inf] * 6, [math.nan] + [0.0] * 5]
    rows = [(k, v) for k, v in enumerate(values + values[:5] + odd)] + [(0, values[0]), (None, values[1])]
    table = spark.createDataFrame([(i, v, "x", 3) for i, v in rows], "vec_id long, embedding array<double>, n string, component int")
    got = whitening.whitened(table.repartition(5)).collect()
    check(got, rows)


def test_without_variance_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None), (2, [])], schema)).collect() == []
    one = whitening.whitened(spark.createDataFrame([(1, [0.5, -0.5]), (2, [0.5, -0.5])], schema)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 4
    two = whitening.whitened(spark.createDataFrame([(1, [0.5, -0.5]), (2, [1.5])], schema)).collect()
    assert sorted(r.whitened for r in two if r.component == 1) == pytest.approx([-1, 1]) and all(r.whitened is None for r in two if r.component == 2)
    assert {r.deviation for r in two} == {256 ** 2 + 128 ** 2}


def test_large_entries(spark):
    rows = [(k, [2.0 ** 40 * k, -(2.0 ** 39) * k * k, 1.0 * k, 0.0, 5.0]) for k in range(6)]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert all(r.deviation is None for r in got if r.vec_id == 5) and all(r.explained < 1 + 1e-9 for r in got)
    found = sorted((r.vec_id, r.whitened) for r in got if r.component == 1)
    assert abs(sum(w for _, w in found)) < 1e-9 and abs(sum(w * w for _, w in found) / 6 - 1) < 1e-9


def test_vectors_of_a_multiple_eigenvalue_are_orthogonal():
    """Also where rounding makes its counts look like those of single ones."""
    draw = np.random.default_rng(1)
    for _ in range(40):
        q, _ = np.linalg.qr(draw.standard_normal((4, 4)))
        m = q @ np.diag([1e-12, 3e-13, 0, 0]) @ q.T
        _, vectors = whitening.leading((m + m.T) / 2, 4)
        assert np.abs(vectors @ vectors.T - np.eye(4)).max() < 1e-6
