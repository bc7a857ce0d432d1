"""Leading eigenvalues and eigenvectors of a symmetric matrix of bounded size, in numpy.

Householder reflections make the matrix tridiagonal; Sturm counts bisect the leading eigenvalues;
inverse iteration finds the tridiagonal eigenvectors, those of a cluster made orthogonal to each
other; the reflections take them back.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps
_TINY = np.finfo(np.float64).tiny


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit vectors of the Householder reflections (of growing start)."""
    a = np.array(matrix, np.float64)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        column = a[k + 1:, k].copy()
        length = np.linalg.norm(column)
        column[0] += np.copysign(length, column[0])
        size = np.linalg.norm(column)
        if size <= _TINY:
            reflections.append(np.zeros(n - k - 1))
            continue
        v = column / size
        reflections.append(v)
        # A <- H A H on the part below and right of k, as one update of rank two
        rest = a[k + 1:, k + 1:]
        w = rest @ v
        w -= (v @ w) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = a[k, k + 1] = -np.copysign(length, a[k + 1, k])
        a[k + 2:, k] = a[k, k + 2:] = 0
    return a.diagonal().copy(), a.diagonal(1).copy(), reflections


def counts_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each value: negative pivots of the shifted factorisation."""
    squares = np.append(0.0, off * off)
    least = max(_TINY / _EPS, _EPS * _EPS * max(np.abs(diagonal).max(initial=0), np.abs(off).max(initial=0)))
    pivot = np.ones(len(at))
    count = np.zeros(len(at), np.int64)
    for d, s in zip(diagonal, squares):
        pivot = d - at - s / pivot
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The `count` largest eigenvalues, falling, by bisection down to neighbouring doubles."""
    n = len(diagonal)
    reach = np.append(np.abs(off), 0) + np.append(0, np.abs(off))
    low = np.full(count, (diagonal - reach).min())
    high = np.full(count, (diagonal + reach).max())
    pad = 2 * _EPS * max(abs(low[0]), abs(high[0])) * n + _TINY
    low, high = low - pad, high + pad
    wanted = n - 1 - np.arange(count)  # eigenvalues that are smaller, at most
    for _ in range(2100):  # the exponent's range; a gap of two doubles is reached long before
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        below = counts_below(diagonal, off, middle) <= wanted
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return low + (high - low) / 2


def _solver(diagonal: np.ndarray, off: np.ndarray, value: float, least: float):
    """Solve (T - value) x = b by Gaussian elimination with row interchanges."""
    n = len(diagonal)
    main, upper, second = diagonal - value, np.append(off, 0.0), np.zeros(n)
    factors, swapped = np.zeros(n), np.zeros(n, bool)
    for i in range(n - 1):
        lower = off[i]
        if abs(main[i]) < abs(lower):
            swapped[i] = True
            main[i], lower = lower, main[i]
            upper[i], main[i + 1] = main[i + 1], upper[i]
            second[i], upper[i + 1] = upper[i + 1], second[i]
        if abs(main[i]) < least:
            main[i] = least
        factors[i] = lower / main[i]
        main[i + 1] -= factors[i] * upper[i]
        upper[i + 1] -= factors[i] * second[i]
    if abs(main[-1]) < least:
        main[-1] = least

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.copy()
        for i in range(n - 1):
            if swapped[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= factors[i] * x[i]
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                x[i] -= upper[i] * x[i + 1]
            if i + 2 < n:
                x[i] -= second[i] * x[i + 2]
            x[i] /= main[i]
            if abs(x[i]) > 1e200:  # only the direction counts
                x /= 1e200
        return x
    return solve


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray,
                        steps: int = 5) -> np.ndarray:
    """Unit eigenvectors as columns, for falling eigenvalues. Those closer than a thousandth of the
    norm are a cluster and are kept orthogonal to each other in every step."""
    n = len(diagonal)
    norm = max(np.abs(diagonal).max(initial=0) + 2 * np.abs(off).max(initial=0), _TINY)
    least, random = _EPS * norm, np.random.default_rng(13)
    vectors = np.zeros((n, len(values)))
    start, shift = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            start = k
        # equal eigenvalues get shifts of their own, a rounding apart
        shift = min(value, shift - 2 * least) if k > start else value
        solve = _solver(diagonal, off, shift, least)
        held = vectors[:, start:k]
        x = random.standard_normal(n)
        for _ in range(steps):
            for _ in range(2):
                x = x - held @ (held.T @ x)
            x = solve(x / np.linalg.norm(x))
            x = x / np.abs(x).max()
        for _ in range(2):
            x = x - held @ (held.T @ x)
            x /= np.linalg.norm(x)
        vectors[:, k] = x
    return vectors


def leading_eigenpairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The `count` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    diagonal, off, reflections = tridiagonal(matrix)
    values = leading_values(diagonal, off, min(count, len(diagonal)))
    vectors = tridiagonal_vectors(diagonal, off, values)
    n = len(diagonal)
    for k in range(len(reflections) - 1, -1, -1):
        v = reflections[k]
        part = vectors[k + 1:]
        part -= 2 * np.outer(v, v @ part)
    assert vectors.shape == (n, len(values))
    return values, vectors / np.linalg.norm(vectors, axis=0)
