"""Whitening against the eigenvectors of the plain covariance matrix."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dupelens.llm import whitening

CLASHES = ("x", "v", "n", "component", "at", "value")


def vectors(n=400, d=24, seed=5, rank=None):
    rng = np.random.default_rng(seed)
    made = rng.standard_normal((n, rank or d)) * np.linspace(3, 0.3, rank or d)
    return made @ rng.standard_normal((rank or d, d))


def table(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for name in CLASHES:
        frame = frame.withColumn(name, F.lit("clash"))
    return frame.repartition(4)


def awkward(values):
    rows = [(i, [float(np.float32(c)) for c in v], 1) for i, v in enumerate(values)]
    d = len(rows[0][1])
    rows += [(1000, rows[0][1], 2), (1000, rows[0][1], 2), (None, rows[1][1], None), (2000, None, 1), (2001, [], 1)]
    rows += [(2002, [1.0] * (d - 1) + [None], 1), (2003, [1.0] * (d - 1) + [math.nan], 1), (2004, [math.inf] * d, 1), (2005, [1.0] * (d + 1), 1)]
    return rows


def check(spark, rows, components=16):
    found = whitening.whitened(table(spark, rows)).collect()
    lengths = [len(v) for _, v, _ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    d = max(set(lengths), key=lengths.count)
    used = [(i, v) for i, v, _ in rows if v and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    whole = {k: tuple(math.floor(64 * c) + 1_000_000 for c in v) for k, (_, v) in enumerate(used)}
    fit = np.array(sorted(set(whole.values())))
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, d, int((values > 1e-12 * values[0]).sum()))
    assert len(found) == len(used) * k
    assert {r.n for r in found} == {n}
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-9
    exact = {(i, sum((n * c - s) ** 2 for c, s in zip(whole[p], sums, strict=True))) for p, (i, _) in enumerate(used)}
    assert {(r.vec_id, r.deviation) for r in found} == exact
    signs = {}
    expected = {}
    for p, (i, _) in enumerate(used):
        white = (np.array(whole[p]) - fit.mean(axis=0)) @ axes[:, :k] / np.sqrt(values[:k])
        expected[i] = white
    for r in found:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        value = expected[r.vec_id][r.component - 1]
        if abs(value) > 1e-3:
            sign = signs.setdefault(r.component, np.sign(value) * np.sign(r.whitened))
            assert r.whitened == pytest.approx(sign * value, rel=1e-6, abs=1e-7)
    return found


def test_components_equal_the_eigenvectors(spark):
    found = check(spark, awkward(vectors()))
    assert {r.component for r in found} == set(range(1, 17))
    assert sum(r.vec_id == 1000 for r in found) == 32


def test_few_dimensions_and_low_rank(spark):
    check(spark, awkward(vectors(100, 5)))
    flat = [[1.0, 2.0, 3.0], [1.0, 5.0, 3.0], [1.0, 9.0, 3.0]]
    found = check(spark, [(i, v, 0) for i, v in enumerate(flat)])
    assert {r.component for r in found} == {1}


def test_repeated_eigenvalues_are_all_found(spark):
    rows = []
    for axis in range(6):
        for sign in (1.0, -1.0):
            rows.append((len(rows), [sign if i == axis else 0.0 for i in range(6)], 0))
    found = whitening.whitened(table(spark, rows)).collect()
    assert len(found) == 12 * 6
    assert {round(r.explained, 12) for r in found} == {round(1 / 6, 12)}
    white = np.zeros((12, 6))
    for r in found:
        white[r.vec_id, r.component - 1] = r.whitened
    assert np.allclose(white.T @ white / 12, np.eye(6), atol=1e-12)


def test_nothing_to_fit(spark):
    assert whitening.whitened(table(spark, [])).count() == 0
    assert whitening.whitened(table(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).count() == 0
    assert whitening.whitened(table(spark, [(1, None, 0), (2, [math.nan], 0)])).count() == 0


def test_bidiagonal_matrix_has_the_singular_values_of_the_rows():
    x = vectors(80, 30, seed=9)
    x = x - x.mean(axis=0)
    right, bidiagonal = whitening.bidiagonalise(lambda q: (x.T @ (x @ q), float((x @ q) @ (x @ q))), 30, float(np.linalg.norm(x)))
    assert np.allclose(right.T @ right, np.eye(30), atol=1e-12)
    assert np.allclose(np.linalg.svd(bidiagonal)[1], np.linalg.svd(x)[1], rtol=1e-9)
    assert np.count_nonzero(bidiagonal - np.triu(np.tril(bidiagonal, 1))) == 0


def test_deviation_stays_exact_for_large_numbers():
    centre = whitening.Centre(3, np.array([1 << 30, 5], np.int64), np.array([2.0, 1.0]))
    x = np.array([[(1 << 30) + 7, 9], [3, 5]], np.int64)
    sums = [3 * (1 << 30) + 2, 16]
    exact = [sum((3 * int(c) - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    assert whitening.exact_deviation(centre, x) == [v if v < 1 << 63 else None for v in exact]
