"""Leading eigenvectors of a symmetric matrix.

Householder reflections make the matrix tridiagonal, bisection on Sturm counts finds the
leading eigenvalues one by one to the last bit, inverse iteration finds their vectors, and
those of close eigenvalues are made orthogonal among themselves. The matrix has the size of
a vector, not of the data.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps
# Eigenvalues nearer than this share of the norm form a cluster.
_CLOSE = 1e-3
_ROUNDS = 4


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit vectors of the reflections, first one first."""
    a = np.array(matrix, dtype=np.float64)
    size = len(a)
    mirrors = []
    for k in range(size - 2):
        v = a[k + 1 :, k].copy()
        long = np.linalg.norm(v)
        if long > 0:
            v[0] += np.copysign(long, v[0])
            v /= np.linalg.norm(v)
            block = a[k + 1 :, k + 1 :]
            p = block @ v
            w = 2 * (p - (v @ p) * v)
            block -= np.outer(v, w) + np.outer(w, v)
            a[k + 1 :, k] -= 2 * (v @ a[k + 1 :, k]) * v
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of eigenvalues below each given value: negative pivots of T - value."""
    floor = np.finfo(np.float64).tiny / _EPS
    pivot, below = None, np.zeros(len(at), dtype=np.int64)
    for d, e in zip(diagonal, [0.0, *off]):
        pivot = d - at - (0 if pivot is None else e * e / pivot)
        pivot = np.where(np.abs(pivot) < floor, -floor, pivot)
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The largest eigenvalues, falling; all are bisected side by side."""
    size = len(diagonal)
    radius = np.concatenate([np.abs(off), [0]]) + np.concatenate([[0], np.abs(off)])
    low, high = (diagonal - radius).min(), (diagonal + radius).max()
    slack = 2 * _EPS * max(abs(low), abs(high)) * size + np.finfo(np.float64).tiny
    lows, highs = np.full(count, low - slack), np.full(count, high + slack)
    places = size - 1 - np.arange(count)  # of each value among all, from the smallest
    while True:
        middle = lows + (highs - lows) / 2
        if ((middle <= lows) | (middle >= highs)).all():
            return middle
        above = sturm_counts(diagonal, off, middle) <= places
        lows, highs = np.where(above, middle, lows), np.where(above, highs, middle)


def _solve(diagonal: np.ndarray, off: np.ndarray, value: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """Solves (T - value) x = right by elimination with row exchanges; pivots of 0 become tiny."""
    size = len(diagonal)
    d, u, x = (diagonal - value).tolist(), [*off.tolist(), 0.0], right.tolist()
    second = [0.0] * size
    for i in range(size - 1):
        below = off[i].item()
        if abs(d[i]) >= abs(below):
            if d[i] == 0:
                d[i] = tiny
            share = below / d[i]
            d[i + 1] -= share * u[i]
            x[i + 1] -= share * x[i]
        else:
            share = d[i] / below
            d[i], u[i], d[i + 1], second[i] = below, d[i + 1], u[i] - share * d[i + 1], u[i + 1]
            u[i + 1] *= -share
            x[i], x[i + 1] = x[i + 1], x[i] - share * x[i + 1]
    for i in reversed(range(size)):
        if abs(d[i]) < tiny:
            d[i] = tiny
        rest = x[i]
        if i + 1 < size:
            rest -= u[i] * x[i + 1]
        if i + 2 < size:
            rest -= second[i] * x[i + 2]
        x[i] = rest / d[i]
    return np.array(x)


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A unit vector per given eigenvalue (falling), as rows."""
    size = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(off).max(initial=0)) or 1.0
    tiny = _EPS * norm
    random = np.random.default_rng(0)
    vectors = np.zeros((len(values), size))
    start = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > _CLOSE * norm:
            start = j
        # Equal values are set apart a little, or all would give one vector again.
        shifted = value - (j - start) * 2 * tiny
        x = random.uniform(-1, 1, size)
        for _ in range(_ROUNDS):
            x = _solve(diagonal, off, shifted, x / np.abs(x).max(), tiny)
            x /= np.abs(x).max()
            for _twice in range(2):
                for other in vectors[start:j]:
                    x -= (other @ x) * other
            x /= np.linalg.norm(x)
        vectors[j] = x
    return vectors


def leading_eigenpairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as rows."""
    size = len(matrix)
    count = min(count, size)
    scale = np.abs(matrix).max(initial=0)
    if count == 0 or scale == 0:
        return np.zeros(count), np.eye(count, size)
    diagonal, off, mirrors = tridiagonal(np.asarray(matrix, dtype=np.float64) / scale)
    near = np.abs(diagonal[:-1]) + np.abs(diagonal[1:])
    off[np.abs(off) <= _EPS * near] = 0
    values = leading_values(diagonal, off, count)
    vectors = tridiagonal_vectors(diagonal, off, values)
    for k, v in reversed(list(enumerate(mirrors))):
        vectors[:, k + 1 :] -= 2 * np.outer(vectors[:, k + 1 :] @ v, v)
    return values * scale, vectors
