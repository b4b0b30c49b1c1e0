"""Singular values and right singular vectors of a small square matrix.

Householder reflections make the matrix upper bidiagonal, differential qd transforms with
shifts (dqds) find the squared singular values, and twisted factorisations give the
vectors. The matrix is as wide as a vector of the input is long, whatever the number of
rows behind it.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny
# Eigenvalues nearer than this, relatively, have their vectors orthogonalised.
CLUSTER = 1e-3


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V): r = U B V' with B upper bidiagonal."""
    a = np.array(r, dtype=float)
    n = a.shape[1]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        norm = np.linalg.norm(x)
        if norm == 0 or not np.any(x[1:]):
            return None
        w = x / norm
        w[0] += 1.0 if w[0] >= 0 else -1.0
        return w / np.linalg.norm(w)

    for k in range(n):
        w = reflector(a[k:, k])
        if w is not None:
            a[k:, k:] -= 2.0 * np.outer(w, w @ a[k:, k:])
        if k < n - 2:
            w = reflector(a[k, k + 1:])
            if w is not None:
                a[k:, k + 1:] -= 2.0 * np.outer(a[k:, k + 1:] @ w, w)
                v[:, k + 1:] -= 2.0 * np.outer(v[:, k + 1:] @ w, w)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One transform: (q, e) of the shifted matrix and the pivots, whose signs tell if the shift was too large."""
    d = q[0] - shift
    new_q, new_e, pivots = [], [], [d]
    for i in range(len(e)):
        top = d + e[i]
        new_q.append(top)
        if top == 0.0:
            new_e.append(0.0)
            d = q[i + 1] - shift
        else:
            ratio = q[i + 1] / top
            new_e.append(e[i] * ratio)
            d = d * ratio - shift
        pivots.append(d)
    new_q.append(d)
    return new_q, new_e, pivots


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling."""
    found: list[float] = []
    blocks = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in upper], 0.0)]
    while blocks:
        q, e, total = blocks.pop()
        while True:
            while q and (len(q) == 1 or e[-1] <= EPS * EPS * (total + q[-1])):
                found.append(total + max(q.pop(), 0.0))
                if e:
                    e.pop()
            if not q:
                break
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * min(q[i], q[i + 1])), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], total))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            # The transform without a shift gives the diagonal of the inverse: its trace bounds
            # the least eigenvalue from below, so that this shift never fails.
            plain_q, plain_e, pivots = _dqds(q, e, 0.0)
            if min(pivots) <= 0.0:
                q, e = plain_q, plain_e
                q[-1] = max(q[-1], 0.0)
                e[-1] = 0.0
                continue
            low = (1.0 - 8 * EPS * len(q)) / sum(1.0 / p for p in pivots)
            # A bolder one from the last row of the transformed matrix, tried first.
            bold = plain_q[-1] - np.sqrt(plain_q[-1] * plain_e[-1])
            for shift in (bold, low, 0.0):
                if shift < 0.0 or (shift < low and shift != 0.0):
                    continue
                next_q, next_e, pivots = _dqds(plain_q, plain_e, shift)
                if min(pivots[:-1], default=0.0) >= 0.0 and pivots[-1] >= 0.0:
                    q, e, total = next_q, next_e, total + shift
                    break
            else:
                q, e = plain_q, plain_e
    return np.sort(np.array(found))[::-1]


def _twisted(d: np.ndarray, low: np.ndarray, value: float, start: np.ndarray | None = None):
    """(z, gamma, k): solves (L D L' - value) z = gamma_k e_k, at the twist with the least |gamma|.

    With ``start`` the equation is solved for that right-hand side instead, for vectors of clusters.
    """
    n = len(d)
    plus, s = np.empty(n), np.empty(n)
    lower = np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        plus[i] = d[i] + s[i] or EPS * TINY ** 0.5
        lower[i] = d[i] * low[i] / plus[i]
        s[i + 1] = lower[i] * low[i] * s[i] - value
    plus[-1] = d[-1] + s[-1] or EPS * TINY ** 0.5
    minus, p = np.empty(n), np.empty(n)
    upper = np.zeros(n)
    p[-1] = d[-1] - value
    for i in range(n - 2, -1, -1):
        minus[i + 1] = d[i] * low[i] ** 2 + p[i + 1] or EPS * TINY ** 0.5
        t = d[i] / minus[i + 1]
        upper[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    gamma = s + p + value
    gamma[gamma == 0] = EPS * TINY ** 0.5
    k = int(np.argmin(np.where(np.isfinite(gamma), np.abs(gamma), np.inf)))
    z = np.zeros(n)
    if start is None:
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -lower[i] * z[i + 1]
        for i in range(k, n - 1):
            z[i + 1] = -upper[i] * z[i]
        return z, float(gamma[k]), k
    # N G N' z = start, with N unit lower above the twist and unit upper below it.
    y = start.copy()
    for i in range(1, k + 1):
        y[i] -= lower[i - 1] * y[i - 1]
    below = start[k]
    for i in range(n - 2, k - 1, -1):
        y[i] -= upper[i] * y[i + 1]
    if 0 < k < n - 1:
        y[k] = below - lower[k - 1] * y[k - 1] - upper[k] * y[k + 1]
    pivots = np.concatenate([plus[:k], [gamma[k]], minus[k + 1:]])
    y = y / pivots
    for i in range(k - 1, -1, -1):
        y[i] -= lower[i] * y[i + 1]
    for i in range(k, n - 1):
        y[i + 1] -= upper[i] * y[i]
    return y, float(gamma[k]), k


def _beside(d: np.ndarray, low: np.ndarray, value: float, near: np.ndarray, z: np.ndarray, rng) -> np.ndarray:
    """A vector of a cluster, orthogonal to those found before, by inverse iteration.

    The value is moved by some rounding errors for each vector found, so that equal values
    do not give the same vector again; a start that leads back to them is drawn anew.
    """
    def apart(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - near @ (near.T @ x)
        return x

    best, size = z, -1.0
    moved = value - 10 * EPS * near.shape[1] * max(abs(value), EPS)
    for draw in range(12):
        x = apart(z if draw == 0 else rng.standard_normal(len(z)))
        for _ in range(3):
            if not np.any(x):
                break
            y, _, _ = _twisted(d, low, moved, x / np.linalg.norm(x))
            if not np.all(np.isfinite(y)) or not np.any(y):
                break
            y /= np.abs(y).max()
            y /= np.linalg.norm(y)
            x = apart(y)
            left = float(np.linalg.norm(x))
            if left > size:
                best, size = x, left
            if left > 0.99:
                return x
        if size > 0.9:
            break
    return best


def _block_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Vectors (columns) of an unreduced bidiagonal block, for its values in falling order."""
    n = len(diagonal)
    if n == 1:
        return np.ones((1, 1))
    d = np.maximum(diagonal ** 2, TINY / EPS)
    low = upper * diagonal[:-1] / d[:-1]
    rng = np.random.default_rng(11)
    out = np.zeros((n, len(values)))
    first = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * abs(value):
            first = j
        z, gamma, _ = _twisted(d, low, value)
        if not np.all(np.isfinite(z)) or np.abs(z).max() > 1e150:
            z = rng.standard_normal(n)
        # The Rayleigh quotient of the vector corrects the value; then solve again.
        for _ in range(2):
            step = gamma / (z @ z)
            if not np.isfinite(step) or abs(step) > CLUSTER * abs(value) or j > first:
                break
            again, other, _ = _twisted(d, low, value + step)
            if not np.all(np.isfinite(again)) or np.abs(again).max() > 1e150:
                break
            if abs(other) / np.linalg.norm(again) > abs(gamma) / np.linalg.norm(z):
                break
            value, z, gamma = value + step, again, other
        z /= np.linalg.norm(z)
        if first < j:
            z = _beside(d, low, value, out[:, first:j], z, rng)
        out[:, j] = z / np.linalg.norm(z)
    return out


def directions(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): squared singular values of r, falling, and its right singular vectors in columns.

    Values that are zero to working precision come with their vectors too; a caller that
    divides by them has to leave them out.
    """
    diagonal, upper, v = bidiagonalise(r)
    n = len(diagonal)
    scale = max(np.abs(diagonal).max(initial=0), np.abs(upper).max(initial=0))
    if scale == 0:
        return np.zeros(n), v
    diagonal, upper = diagonal / scale, upper / scale
    # What is negligible against its neighbours, or against the error of the reflections, splits the matrix.
    small = EPS * np.maximum(np.abs(diagonal[:-1]) + np.abs(diagonal[1:]), 2 * np.sqrt(n))
    cuts = [0, *(np.flatnonzero(np.abs(upper) <= small) + 1), n]
    values, vectors = [], np.zeros((n, n))
    for a, b in zip(cuts[:-1], cuts[1:]):
        own = squared_singular_values(diagonal[a:b], upper[a: b - 1])
        vectors[a:b, a:b] = _block_vectors(diagonal[a:b], upper[a: b - 1], own)
        values.extend(own)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order] * scale ** 2, (v @ vectors)[:, order]
