"""Whitening against the dense covariance."""

import math

import numpy as np
import pytest

from skylag.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, v int, component string, at int, n string"


def frame(spark, vectors, ids=None):
    ids = ids if ids is not None else range(len(vectors))
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "x", 1, "y", 2, "z") for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def check(got, vectors, components):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in np.float32(v).astype(float)] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    c = np.array((x * n - sums) / n, dtype=float)
    values, turn = np.linalg.eigh(c.T @ c / n)
    values, turn = values[::-1], turn[:, ::-1]
    want = c @ turn[:, :components] / np.sqrt(values[:components])
    table = np.full((n, components), np.nan)
    for r in got:
        table[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == sum(int(d) ** 2 for d in x[r.vec_id] * n - sums)
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9 and r.identity_error < 1e-9
    signs = np.sign((table * want).sum(axis=0))
    assert np.abs(table * signs - want).max() < 1e-7


@pytest.mark.parametrize("dims, n", [(64, 700), (90, 400), (40, 300), (5, 50)])
def test_whiten(spark, dims, n):
    """A flat spectrum, as in the given table; blocks narrower and as wide as the vectors."""
    rng = np.random.default_rng(dims)
    vectors = (rng.standard_normal((n, dims)) * rng.uniform(0.8, 1.2, dims)).tolist()
    check(whitening.whiten(frame(spark, vectors)).collect(), vectors, min(32, dims))


def test_filter_is_used(spark):
    rng = np.random.default_rng(1)
    rows = whitening.whole_numbers(frame(spark, rng.standard_normal((300, 64)).tolist()))
    found = whitening.fit(rows, 8, 4)
    assert found.passes > whitening.DEGREE and found.residual < 1e-12 and found.vectors.shape == (64, 8)
    assert np.abs(found.vectors.T @ found.vectors - np.eye(8)).max() < 1e-12


def test_other_rows(spark):
    """Vectors that take no part; few rows, equal rows, repeated ids, no rows."""
    rng = np.random.default_rng(2)
    good = rng.standard_normal((60, 6)).tolist()
    bad = [None, [], [1.0, None, 1, 1, 1, 1], [float("nan")] * 6, [float("inf")] + [0.0] * 5, [1.0, 2.0]]
    check(whitening.whiten(frame(spark, good + bad)).collect(), good, 6)
    assert whitening.whiten(frame(spark, bad[:5])).count() == 0
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 4)).count() == 0
    few = whitening.whiten(frame(spark, [[0.0] * 40, [1.0] * 40, [0.0] * 20 + [1.0] * 20], [7, 7, None])).collect()
    assert sorted({r.component for r in few}) == [1, 2] and len(few) == 6 and few[0].identity_error < 1e-9
