"""Whitening against eigenvectors of the exact covariance; awkward vectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from sedimenta.llm import whitening
from sedimenta.llm.bidiagonal import directions

SCHEMA = "vec_id bigint, embedding array<float>, label int, component int, n bigint, whitened double"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 9, 9, 9.0) for i, v in enumerate(vectors)], SCHEMA)


def made(rows, width, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((rows, width)) @ (rng.standard_normal((width, width)) * 0.2)
    return [[float(c) for c in v] for v in x.astype(np.float32)]


def expected(vectors, limit=32):
    x = np.floor(64 * np.array(vectors, dtype=np.float64)).astype(int) + 1_000_000
    n = len(x)
    sums = [int(s) for s in x.sum(axis=0)]
    deviation = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    c = (n * x - np.array(sums)) / n
    v = c.T @ c / n
    e, p = np.linalg.eigh(v)
    e, p = e[::-1][:limit], p[:, ::-1][:, :limit]
    return n, deviation, c @ p / np.sqrt(e), e / np.trace(v)


@pytest.mark.parametrize("rows,width", [(400, 8), (3000, 40), (37, 5)])
def test_against_eigenvectors(spark, rows, width):
    vectors = made(rows, width)
    found = whitening.whiten(frame(spark, vectors).repartition(5)).collect()
    n, deviation, white, share = expected(vectors)
    assert len(found) == rows * min(width, 32)
    got = np.zeros_like(white)
    for r in found:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviation[r["vec_id"]]
        assert r["explained"] == pytest.approx(share[r["component"] - 1], rel=1e-9)
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-7
    measured = np.abs(got.T @ got / n - np.eye(white.shape[1])).max()
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]}
    assert found[0]["identity_error"] == pytest.approx(measured, abs=1e-12) and measured < 1e-10


def test_awkward_vectors(spark):
    good = made(60, 4)
    bad = [None, [], [1.0, None, 2.0, 3.0], [math.nan, 0.0, 0.0, 0.0], [0.0, math.inf, 0.0, 0.0], [1.0, 2.0],
           [1.0, 2.0, 3.0, 4.0, 5.0]]
    rows = [(i if i else None, v, 0, 9, 9, 9.0) for i, v in enumerate(good + bad + good[:1] * 30)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 90 * 4 and {r["n"] for r in found} == {90}
    ids = {r["vec_id"] for r in found}
    assert None in ids and not ids & set(range(60, 67))
    first = sorted(r["whitened"] for r in found if r["vec_id"] in (None, 67) and r["component"] == 1)
    assert first[0] == first[1]


def test_nothing_to_whiten(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for vectors in ([], [None, []], [[1.0, 2.0]], [[1.0, 2.0]] * 5):
        found = whitening.whiten(frame(spark, vectors))
        assert found.columns == columns and found.collect() == []
    # Five equal dimensions and one that is constant leave one component.
    rows = [[v] * 5 + [3.0] for v in (0.1, 0.5, 0.25, 2.0)]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert len(found) == 4 and {r["component"] for r in found} == {1}
    assert found[0]["explained"] == pytest.approx(1.0)


def test_huge_entries(spark):
    vectors = [[1e30, 1.0], [-1e30, 2.0], [0.5, 3.0]]
    found = whitening.whiten(frame(spark, vectors)).collect()
    assert len(found) >= 3 and all(r["deviation"] is None for r in found if r["vec_id"] < 2)


def test_triangles_are_joined_in_steps(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    vectors = made(200, 6)
    fit, _ = whitening.fit(frame(spark, vectors).repartition(9))
    _, _, _, share = expected(vectors)
    assert np.allclose(fit.values / fit.trace, share, rtol=1e-9)
    assert [int(s) for s in fit.sums] == [
        sum(math.floor(Fraction(64) * Fraction(v[d])) + 1_000_000 for v in vectors) for d in range(6)]


RNG = np.random.default_rng(5)
Q = np.linalg.qr(RNG.standard_normal((80, 80)))[0]
STEPS = np.repeat([5, 5 - 1e-9, 3, 1.0], 10)


@pytest.mark.parametrize("name,a", [
    ("one", np.array([[3.0]])), ("zero", np.zeros((4, 4))), ("identity", np.eye(7)), ("ones", np.ones((9, 9))),
    ("random", RNG.standard_normal((50, 50))), ("graded", RNG.standard_normal((90, 30)) * 10.0 ** (-np.arange(30) / 3)),
    ("rank", RNG.standard_normal((40, 3)) @ RNG.standard_normal((3, 20))), ("equal columns", np.repeat(RNG.standard_normal((60, 6)), 4, axis=1)),
    ("clusters", Q[:, :40] * STEPS), ("turned clusters", Q[:, :40] * STEPS @ Q[:40, :40]),
    *((f"noise {e}", Q[:, :40] * STEPS + 10.0 ** e * RNG.standard_normal((80, 40))) for e in (-15, -13, -10, -6, -3)),
    ("wilkinson", np.diag(np.abs(np.arange(21) - 10.0)) + np.eye(21, k=1) + np.eye(21, k=-1)),
])
def test_directions(name, a):
    values, vectors = directions(np.linalg.qr(a, mode="r"))
    scale = max(np.linalg.norm(a, 2), 1e-300)
    assert np.all(np.diff(values) <= 0)
    assert np.abs(np.sqrt(np.maximum(values, 0)) - np.linalg.svd(a, compute_uv=False)).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-7
    assert np.abs(a.T @ (a @ vectors) - vectors * values).max() <= 1e-7 * scale ** 2
