"""Whitening against a dense eigensolver, exact integers, and its defined cases."""

import math
import random

import numpy as np
import pytest

from cohortgraph.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, deviation string, v string, i string, m string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in vectors], SCHEMA).repartition(3)


def random_vectors(n, d, seed=1, rank=None):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, rank or d)) @ rng.standard_normal((rank or d, d))
    return [(k, [float(np.float32(x)) for x in row]) for k, row in enumerate(v)]


def plain(vectors):
    """(x, n, sums, covariance) in Python integers and doubles."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    return x, n, sums, centred, centred.T @ centred / n


@pytest.mark.parametrize("n, d", [(200, 40), (60, 5), (20, 40)])
def test_whitening_equals_dense_eigensolver(spark, n, d):
    rows = random_vectors(n, d)
    df = table(spark, rows)
    model = whitening.fit(df)
    x, count, sums, centred, covariance = plain([v for _, v in rows])
    e, q = np.linalg.eigh(covariance)
    e, q = e[::-1], q[:, ::-1]
    k = min(32, d, n - 1)
    assert (model.n, [int(s) for s in model.sums], len(model.values)) == (count, sums, k)
    np.testing.assert_allclose(model.values, e[:k], rtol=1e-9, atol=1e-9 * e[0])
    want = centred @ q[:, :k] / np.sqrt(e[:k])
    got = {r.vec_id: r for r in model.whiten(df).collect()}
    matrix = np.array([got[i].whitened for i in range(n)])
    signs = np.sign((matrix * want).sum(axis=0))
    np.testing.assert_allclose(matrix * signs, want, atol=1e-6)
    assert [got[i].deviation for i in range(n)] == [sum((count * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert model.identity_error(df) < 1e-6


def inertia_of(spectrum, shift):
    return sum(x > shift for x in spectrum)


def test_intervals_hold_every_eigenvalue():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.standard_normal((24, 24)))
    for spectrum in ([5.0] * 10 + [3.0] * 3 + [1.0] * 6 + [0.0] * 5, list(np.logspace(0, 8, 24)), [1.0] * 24, [2.0] + [0.0] * 23):
        a = q @ np.diag(spectrum) @ q.T
        a = (a + a.T) / 2
        true = sorted(spectrum, reverse=True)
        assert whitening.inertia(a, 1.5) == sum(x > 1.5 for x in spectrum)
        parts = whitening.intervals(a, 12)
        assert all(p[0] >= q[1] and inertia_of(spectrum, p[0]) == inertia_of(spectrum, q[1]) for p, q in zip(parts, parts[1:]))
        found = np.concatenate([whitening.feast(a, *p)[0] for p in parts])
        positive = [x for x in true if x > 0]
        assert min(12, len(positive)) <= len(found) <= len(positive)
        np.testing.assert_allclose(found, true[: len(found)], atol=1e-10 * true[0])


def test_inertia_of_indefinite_matrices():
    rng = np.random.default_rng(4)
    for d in (1, 2, 7, 30):
        a = rng.standard_normal((d, d))
        a = (a + a.T) / 2
        np.fill_diagonal(a, 0)  # needs pivots of two rows
        for shift in (0.0, 0.3, -1.0):
            assert whitening.inertia(a, shift) == int((np.linalg.eigvalsh(a) > shift).sum())


def test_dropped_rows_repeats_and_lengths(spark):
    rng = random.Random(2)
    good = [(k % 9, [rng.gauss(0, 1) for _ in range(4)]) for k in range(40)] + [(None, [0.5, 0.25, 0.0, 1.0])] * 3
    bad = [(50, None), (51, [1.0, None, 0.0, 0.0]), (52, [float("nan"), 0.0, 0.0, 0.0]), (53, [float("inf"), 0.0, 0.0, 0.0]), (54, []), (55, [1.0, 2.0]), (56, [-float("inf"), 0.0, 0.0, 0.0])]
    df = table(spark, good + bad)
    model = whitening.fit(df)
    out = model.whiten(df).collect()
    assert (model.n, model.size, len(model.values), len(out)) == (43, 4, 4, 43)
    assert sum(r.vec_id is None for r in out) == 3
    assert model.identity_error(df) < 1e-9


def test_no_variance_and_empty_tables(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(k, [1.0, 2.0]) for k in range(5)]):
        df = table(spark, rows) if rows else spark.createDataFrame([], SCHEMA)
        model = whitening.fit(df)
        assert (model.whiten(df).count(), model.identity_error(df)) == (0, 0.0)


def test_values_beyond_longs(spark):
    rows = [(k, [3e10 * (-1) ** k, float(k)]) for k in range(6)]
    model = whitening.fit(table(spark, rows))
    assert model.n == 6 and all(r.deviation is None for r in model.whiten(table(spark, rows)).collect())
    assert np.isfinite(model.values).all()
