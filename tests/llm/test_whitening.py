import math
from fractions import Fraction

import numpy as np
import pytest

from parcelflow.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, n long, x int"


def table(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in vectors], schema)


def brute(vectors, most=4):
    """Eigenvectors of the covariance of the distinct integer vectors."""
    width = max(len(v) for v in vectors)
    x = np.array([[math.floor(256 * c) for c in v] + [0] * (width - len(v)) for v in vectors])
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    mean = np.array([float(Fraction(int(s), n)) for s in total])
    cov = (fit - mean).T @ (fit - mean) / n
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values)[: min(most, np.linalg.matrix_rank(fit - mean))]
    white = (x - mean) @ axes[:, order] / np.sqrt(values[order])
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, total, strict=True)) for row in x]
    return n, deviation, white, values[order] / np.trace(cov)


def check(spark, rows, schema=SCHEMA):
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    vectors = [[float(np.float32(c)) if "float" in schema else c for c in v] for _, v in usable]
    n, deviation, white, explained = brute(vectors)
    got = wh.whiten(table(spark, rows, schema).repartition(4)).collect()
    most = white.shape[1]
    assert len(got) == len(usable) * most
    for k in range(1, most + 1):
        own = sorted((r for r in got if r.component == k), key=lambda r: (r.vec_id is None, r.vec_id or 0, r.deviation))
        order = sorted(range(len(usable)), key=lambda j: (usable[j][0] is None, usable[j][0] or 0, deviation[j]))
        assert [r.deviation for r in own] == [deviation[j] for j in order] and {r.n for r in own} == {n}
        a, b = np.array([r.whitened for r in own]), white[order, k - 1]
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-7
        assert np.allclose([r.explained for r in own], explained[k - 1], rtol=1e-9)
        assert {r.identity_error for r in own} == {got[0].identity_error} and got[0].identity_error < 1e-9
    return got


def vectors(n, width, seed):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, width)) * 0.5 ** np.arange(width) + rng.normal(size=width)).tolist()


def test_equals_eigenvectors_with_odd_rows(spark):
    rows = [*enumerate(vectors(300, 12, 1)), (None, vectors(1, 12, 2)[0])]
    rows += [(5, rows[7][1]), (400, rows[7][1]), (400, rows[7][1])]
    rows += [(401, None), (402, [None] * 12), (403, [float("nan")] + [0.0] * 11), (404, [float("-inf")] * 12), (405, rows[0][1][:5]), (406, [])]
    check(spark, rows)


def test_dependent_and_constant_dimensions(spark):
    base = np.array(vectors(60, 2, 3))
    wide = np.hstack((base, 2 * base[:, :1], np.full((60, 1), 7.25)))
    rows = list(enumerate((np.floor(256 * wide[:, [0, 1]]) / 256).tolist()))
    rows = [(i, [a, b, 2 * a, 7.25]) for i, (a, b) in rows]
    got = check(spark, rows)
    assert max(r.component for r in got) == 2


def test_badly_conditioned(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(-3, 4, (400, 6)) * np.array([1 << 14, 1 << 11, 1 << 7, 16, 1, 1]) @ np.triu(np.ones((6, 6)))
    check(spark, list(enumerate((x / 256).tolist())), "vec_id long, embedding array<double>, n long, x int")


def test_few_vectors(spark):
    assert wh.whiten(table(spark, [])).count() == 0
    assert wh.whiten(table(spark, [(1, None), (2, [])])).count() == 0
    assert wh.whiten(table(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])).count() == 0  # one distinct vector: no variance
    assert {r.component for r in check(spark, [(1, [0.5, 1.0]), (2, [0.25, 3.0]), (2, [0.25, 3.0])])} == {1}


def test_exact_sums_and_deviations():
    x = np.array([[1 << 61, -(1 << 61)], [1 << 61, -(1 << 61)], [(1 << 61) + 1, 3]])
    assert wh.exact_sums(x) == [3 * (1 << 61) + 1, 3 - (1 << 62)]
    assert wh.deviations(np.array([[2, 0], [0, 1 << 40]]), 2, [2, 1 << 40]) == [None, None]
    assert wh.deviations(np.array([[2, 5], [0, 7]]), 2, [2, 12]) == [8, 8]


@pytest.mark.parametrize("size", [1, 5])
def test_triangular_solves(size):
    rng = np.random.default_rng(size)
    r1, r2 = (np.triu(rng.normal(size=(size, size))) + 3 * np.eye(size) for _ in range(2))
    a = rng.normal(size=(9, size))
    assert np.allclose(wh.solved(a, [r1, r2]) @ r2 @ r1, a)
