"""Whitening against a plain eigendecomposition."""

from __future__ import annotations

import math

import numpy as np
import pytest

from jobweave.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int, x string, place string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", "z") for i, v in rows], SCHEMA).repartition(5)


def plain(rows, top=4):
    """By id: n, the deviation, whitened values, shares of variance; sums in exact integers, eigenvectors of the whole covariance."""
    whole = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = max((len(v) for _, v in whole), default=0)
    numbers = [(i, tuple(math.floor(256 * c) for c in v) + (0,) * (size - len(v))) for i, v in whole]
    fit = sorted({x for _, x in numbers})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    x = np.array(fit, float) - np.array(sums) / n
    e, vectors = np.linalg.eigh(x.T @ x / n)
    e, vectors = e[::-1], vectors[:, ::-1]
    out = {}
    for i, row in numbers:
        deviation = sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True))
        centred = np.array(row) - np.array(sums) / n
        out[i] = n, deviation, [centred @ vectors[:, k] / math.sqrt(e[k]) for k in range(min(top, size)) if e[k] > 1e-13 * e.sum()], [v / e.sum() for v in e[:top]]
    return out


def check(found, want, tolerance=1e-9):
    rows = {(r["vec_id"], r["component"]): r for r in found.collect()}
    assert len(rows) == sum(len(w[2]) for w in want.values())
    sign: dict[int, float] = {}
    for i, (n, deviation, values, shares) in want.items():
        for k, value in enumerate(values):
            r = rows[i, k + 1]
            assert r["n"] == n and r["deviation"] == deviation and abs(r["explained"] - shares[k]) <= 1e-9 * shares[k] and r["identity_error"] < 1e-9
            if abs(value) > 1e-3:
                turn = sign.setdefault(k, math.copysign(1.0, value * r["whitened"]))
                assert abs(turn * r["whitened"] - value) <= tolerance * (1 + abs(value))


def vectors(n=300, size=12, seed=1):
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((n, size)) * np.linspace(3, 0.2, size) + rng.standard_normal(size)
    return [(i, [float(c) for c in v]) for i, v in enumerate(rows)]


def test_equals_the_plain_version(spark):
    rows = vectors()
    rows += [(1000 + i, v) for i, v in rows[:100]] + [(2000, [0.1] * 12)] + [(3000 + i, rows[0][1]) for i in range(200)]
    check(whitening.whiten(frame(spark, rows)), plain(rows))


def test_odd_vectors_go_and_short_ones_are_filled(spark):
    rows = vectors(80, 6, 2)
    odd = [(500, None), (501, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (502, [float("nan")] * 6), (503, [float("inf")] + [0.0] * 5), (504, []), (505, [-0.001, 2.0])]
    found = whitening.whiten(frame(spark, rows + odd))
    check(found, plain(rows + odd))
    assert {r["vec_id"] for r in found.collect()} >= {504, 505}


def test_null_and_repeated_ids(spark):
    rows = [(None, v) for _, v in vectors(20, 3, 3)] + [(7, [1.0, 2.0, 3.0])] * 3
    found = whitening.whiten(frame(spark, rows)).collect()
    assert len(found) == 3 * 23 and sum(r["vec_id"] is None for r in found) == 60
    assert len({r["whitened"] for r in found if r["vec_id"] == 7}) == 3


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [0.5, 0.5])] * 4])
def test_no_variance_no_rows(spark, rows):
    assert whitening.whiten(frame(spark, rows)).collect() == []


def test_fewer_directions_than_components(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0, 1.0, -float(i)]) for i in range(30)]
    found = whitening.whiten(frame(spark, rows))
    check(found, plain(rows))
    assert {r["component"] for r in found.collect()} == {1}


def test_equal_variances_are_all_found():
    """A matrix with singular values 5, 5, 5, 2, 2, 0: the recurrence breaks down, new directions find the copies."""
    rng = np.random.default_rng(5)
    left, right = np.linalg.qr(rng.standard_normal((40, 6)))[0], np.linalg.qr(rng.standard_normal((6, 6)))[0]
    values = np.array([5.0, 5, 5, 2, 2, 0])
    x = left * values @ right.T

    def product(w, earlier):
        y = x @ w
        return np.r_[y @ y, (x @ earlier.T).T @ y], x.T @ y

    basis, small = whitening.bidiagonalise(product, 6, np.linalg.norm(x), 6)
    assert np.allclose(basis @ basis.T, np.eye(6), atol=1e-13)
    assert np.allclose(np.linalg.svd(small)[1], values, atol=1e-9)
    assert np.allclose(np.tril(small, -1), 0) and np.allclose(np.triu(small, 2), 0)


def test_close_variances_to_double_precision():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((500, 30)) * (1 + 1e-4 * np.arange(30))
    basis, small = whitening.bidiagonalise(lambda w, W: (np.r_[(x @ w) @ (x @ w), (x @ W.T).T @ (x @ w)], x.T @ (x @ w)), 30, np.linalg.norm(x), 30)
    _, values, turned = np.linalg.svd(small)
    real = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(values, real[1], rtol=1e-13)
    assert np.allclose(np.abs((turned[:4] @ basis) @ real[2][:4].T), np.eye(4), atol=1e-11)


def test_deviations_beyond_64_bits(spark):
    rows = [(1, [3e12, 1.0]), (2, [-3e12, 2.0]), (3, [1e12, 5.0])]
    found = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(frame(spark, rows)).collect()}
    assert found == {i: w[1] for i, w in plain(rows).items()} and max(found.values()) > 1 << 63
