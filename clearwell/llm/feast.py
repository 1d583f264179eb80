"""The largest eigenpairs of a covariance by contour integration (FEAST).

Inertia counts cut the spectrum from the top into intervals of a few eigenvalues. In each, a subspace is filtered by a
quadrature of solves with complex shifts on a circle around the interval, which projects onto its eigenvectors;
Rayleigh-Ritz extracts them. An interval is done when as many pairs as its count says have converged.
"""

from __future__ import annotations

import numpy as np

#: Eigenvalues wanted in one interval, nodes on half a circle, and rounds of filtering.
FEW, NODES, ROUNDS = 8, 8, 60
#: Rounds without a result after which directions and nodes are doubled, and the most nodes.
SLOW, MOST_NODES = 6, 32
_EPS = float(np.finfo(float).eps)


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the same eigenvalues, by reflections."""
    a = matrix.copy()
    for k in range(len(a) - 2):
        x = a[k + 1 :, k]
        length = np.linalg.norm(x)
        if length <= np.finfo(float).tiny:
            continue
        v = x.copy()
        v[0] += np.copysign(length, x[0])
        v /= np.linalg.norm(v)
        a[k + 1 :, :] -= 2 * np.outer(v, v @ a[k + 1 :, :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


class Inertia:
    """How many eigenvalues are above a shift, by the signs of the pivots of the shifted matrix."""

    def __init__(self, matrix: np.ndarray):
        self.diagonal, off = tridiagonal(matrix)
        self.squares = np.concatenate([[0.0], off * off]).tolist()
        radius = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
        self.top = float((self.diagonal + radius).max())
        self.least = max(float(np.finfo(float).tiny), _EPS * _EPS * max(self.squares))

    def above(self, shift: float) -> int:
        count, pivot = 0, 1.0
        for d, square in zip(self.diagonal.tolist(), self.squares, strict=True):
            pivot = d - shift - square / pivot
            if abs(pivot) < self.least:
                pivot = -self.least
            count += pivot > 0
        return count


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """``(low, high, count)`` from the top on, until they hold ``wanted`` eigenvalues or there are no more.

    Eigenvalues that are nothing but rounding error are in none.
    """
    inertia = Inertia(matrix)
    if inertia.top <= 0:
        return []
    margin, found, held = 1e-11 * inertia.top, [], 0
    floor, high = 8 * len(matrix) * _EPS * inertia.top, inertia.top * (1 + 1e-9)

    def between(low: float, high: float) -> float:
        """A place near the middle that no eigenvalue is close to, if there is one."""
        for part in (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65, 0.3, 0.7):
            place = low + part * (high - low)
            if inertia.above(place - margin) == inertia.above(place + margin):
                break
        return place

    waiting = [(floor, high, inertia.above(floor), inertia.above(high))]
    while waiting and held < wanted:
        low, high, from_low, from_high = waiting.pop()
        count = from_low - from_high
        if count <= FEW or high - low < 100 * margin:
            if count:
                found.append((low, high, count))
                held += count
            continue
        place = between(low, high)
        from_place = inertia.above(place)
        waiting += [(low, place, from_low, from_place), (place, high, from_place, from_high)]
    return found


def eigenpairs(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between ``low`` and ``high`` and their unit vectors, as columns.

    Of the subspace's values inside, those with the smallest residuals count: a direction that mixes eigenvectors from
    below and above the interval may have a value inside as well, but a large residual. While pairs are missing, more
    directions, up to all, and more nodes separate eigenvalues that are close to the ends.
    """
    n = len(matrix)
    size, points = min(n, max(2 * count, count + 8)), NODES
    centre, radius = (low + high) / 2, max((high - low) / 2, 1e-9 * abs(high))
    random = np.random.default_rng(0)
    basis = random.standard_normal((n, size))
    scale, best = np.abs(matrix).sum(axis=1).max(), None
    for done in range(1, ROUNDS + 1):
        nodes, weights = np.polynomial.legendre.leggauss(points)
        filtered = np.zeros((n, size))
        for turn, weight in zip(np.exp(0.5j * np.pi * (1 - nodes)), weights, strict=True):
            solved = np.linalg.solve((centre + radius * turn) * np.eye(n) - matrix, basis.astype(complex))
            filtered += weight / 2 * (radius * turn * solved).real
        basis, _ = np.linalg.qr(filtered)
        values, small = np.linalg.eigh(basis.T @ matrix @ basis)
        basis = basis @ small
        off = np.linalg.norm(matrix @ basis - basis * values, axis=0) / scale
        inside = np.flatnonzero((values > low) & (values <= high))
        if len(inside) >= count:
            inside = np.sort(inside[np.argsort(off[inside], kind="stable")[:count]])
            worst = off[inside].max()
            if best is None or worst < best[0] / 2:
                best = (worst, values[inside], basis[:, inside])
                continue
        if best and best[0] < 1e-12:
            # No better than the last time: rounding error is reached.
            return best[1], best[2]
        if done % SLOW == 0:
            size, points = min(n, 2 * size), min(2 * points, MOST_NODES)
            basis = np.hstack([basis, random.standard_normal((n, size - basis.shape[1]))])
    raise RuntimeError(f"{count} eigenvalues between {low} and {high} were not all found")


def combined(matrix: np.ndarray, vectors: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and vectors of all intervals, made orthogonal to each other by one Rayleigh-Ritz step.

    Of a vector's two signs the one is taken whose largest entry is positive.
    """
    basis, _ = np.linalg.qr(vectors)
    values, small = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values, kind="stable")[:wanted]
    out = basis @ small[:, order]
    largest = np.argmax(np.abs(out), axis=0)
    return values[order], out * np.sign(out[largest, np.arange(len(order))])
