"""Leading eigenpairs of a symmetric matrix: tridiagonal form, bisection, inverse iteration."""

from __future__ import annotations

import numpy as np

CLUSTER = 1e-3      # eigenvalues closer than this share of the norm are orthogonalised together
ITERATIONS = 4
SEED = 12


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """(diagonal, off-diagonal, reflectors) of H' a H by Householder reflections.

    A reflector (k, v) stands for I - 2 v v' on the rows from k on; v has length one.
    """
    a = np.array(a, np.float64)
    n = len(a)
    reflectors = []
    for k in range(n - 2):
        x = a[k + 1:, k]
        v = x.copy()
        v[0] += np.copysign(np.linalg.norm(x), x[0])
        norm = np.linalg.norm(v)
        if norm == 0:
            continue
        v /= norm
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] -= 2 * v * (v @ x)
        reflectors.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def counts_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of some numbers, by the signs of Sturm's sequence."""
    tiny = np.finfo(np.float64).tiny / np.finfo(np.float64).eps
    squares = np.concatenate([[0.0], off ** 2])
    found = np.zeros(len(at), np.int64)
    q = np.ones(len(at))
    for d, e2 in zip(diagonal, squares):
        q = d - at - e2 / q
        q[np.abs(q) < tiny] = -tiny
        found += q < 0
    return found


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected until no number lies between its bounds."""
    n = len(diagonal)
    radius = np.abs(np.concatenate([off, [0.0]])) + np.abs(np.concatenate([[0.0], off]))
    low = np.full(k, (diagonal - radius).min())
    high = np.full(k, (diagonal + radius).max())
    spread = max(abs(low[0]), abs(high[0])) * 1e-15
    low, high = low - spread, high + spread
    place = n - 1 - np.arange(k)  # so many eigenvalues are smaller
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return middle
        below = counts_below(diagonal, off, middle) > place
        high = np.where(open_ & below, middle, high)
        low = np.where(open_ & ~below, middle, low)


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """Solves (T - shift) x = b by elimination with row exchanges; a zero pivot becomes tiny."""
    n = len(diagonal)
    d, upper, second = diagonal - shift, off.copy(), np.zeros(max(n - 2, 0))
    lower, x = off.copy(), b.copy()
    small = np.finfo(np.float64).eps * max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), 1e-300)
    for i in range(n - 1):
        if abs(lower[i]) > abs(d[i]):
            d[i], lower[i] = lower[i], d[i]
            upper[i], d[i + 1] = d[i + 1], upper[i]
            if i < n - 2:
                second[i], upper[i + 1] = upper[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(d[i]) < small:
            d[i] = small
        factor = lower[i] / d[i]
        d[i + 1] -= factor * upper[i]
        if i < n - 2:
            upper[i + 1] -= factor * second[i]
        x[i + 1] -= factor * x[i]
    if abs(d[-1]) < small:
        d[-1] = small
    x[-1] /= d[-1]
    if n > 1:
        x[-2] = (x[-2] - upper[-1] * x[-1]) / d[-2]
    for i in range(n - 3, -1, -1):
        x[i] = (x[i] - upper[i] * x[i + 1] - second[i] * x[i + 2]) / d[i]
    return x


def leading_pairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit vectors as rows.

    Vectors come from inverse iteration on the tridiagonal form. Those of a cluster of close
    eigenvalues are made orthogonal to the earlier ones of the cluster in every step.
    """
    if not a.any():
        return np.zeros(k), np.eye(k, len(a))
    diagonal, off, reflectors = tridiagonal(a)
    values = leading_values(diagonal, off, k)
    norm = np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0)
    vectors = np.zeros((k, len(diagonal)))
    draw = np.random.default_rng(SEED)
    first = 0
    for j in range(k):
        if j and values[j - 1] - values[j] > CLUSTER * norm:
            first = j
        x = draw.standard_normal(len(diagonal))
        for _ in range(ITERATIONS):
            x = solve_shifted(diagonal, off, values[j], x / np.abs(x).max())
            x /= np.linalg.norm(x)
            for _ in range(2):  # once more takes out what rounding left
                x -= vectors[first:j].T @ (vectors[first:j] @ x)
            x /= np.linalg.norm(x)
        vectors[j] = x
    for start, v in reversed(reflectors):
        part = vectors[:, start:]
        part -= 2 * np.outer(part @ v, v)
    return values, vectors
