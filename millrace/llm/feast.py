"""The largest eigenvalues of a symmetric matrix by contour integration.

Inertia counts place the ends of a few intervals between eigenvalues. For each interval a quadrature of the resolvent on
a circle around it, a handful of complex shifted solves, projects a random block onto the eigenvectors inside, and
Rayleigh-Ritz on that block gives the pairs. An interval is done when the count says that none is missing and the residuals
are at rounding level. The matrix is as wide as a vector is long, whatever the number of rows it came from.
"""

from __future__ import annotations

import numpy as np

POINTS = 8        # of the quadrature on the upper half circle
PER_INTERVAL = 4  # eigenvalues wanted in an interval; ties stay together
WIDEST = 8        # how many times the smallest one of an interval the largest may be
MOST_ROUNDS = 48
WIDEN_EVERY = 8   # rounds after which a block that has not settled gets twice the columns
_EPS = float(np.finfo(np.float64).eps)


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared off-diagonal of an orthogonally congruent tridiagonal matrix, by Householder reflections."""
    a = np.array(matrix, np.float64)
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        length = np.linalg.norm(x)
        if length == 0 or not np.any(x[1:]):
            continue
        x[0] += length if x[0] >= 0 else -length
        x /= np.linalg.norm(x)
        a[k + 1:, k:] -= 2 * np.outer(x, x @ a[k + 1:, k:])
        a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ x, x)
    return np.diag(a).copy(), np.diag(a, 1) ** 2


def count_above(diagonal: np.ndarray, squares: np.ndarray, shift: float) -> int:
    """How many eigenvalues exceed ``shift``: the positive pivots of the shifted matrix, by Sylvester's law of inertia."""
    tiny = _EPS * _EPS * (float(np.abs(diagonal).max(initial=0)) + float(squares.max(initial=0)) ** 0.5 + np.finfo(np.float64).tiny)
    count, pivot = 0, 1.0
    for value, square in zip((diagonal - shift).tolist(), [0.0, *squares.tolist()], strict=True):
        pivot = value - square / pivot
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot > 0
    return count


class Spectrum:
    """Where the eigenvalues of a matrix lie, from inertia counts alone."""

    def __init__(self, matrix: np.ndarray):
        self.tri = tridiagonal(matrix)
        off = np.sqrt(np.append(self.tri[1], 0))
        reach = off + np.append(0, off[:-1])
        self.low, self.high = float((self.tri[0] - reach).min()), float((self.tri[0] + reach).max())
        self.scale = max(abs(self.low), abs(self.high))
        self.low -= 1e-3 * self.scale
        self.high += 1e-3 * self.scale

    def above(self, shift: float) -> int:
        return count_above(*self.tri, shift)

    def bracket(self, k: int) -> tuple[float, float]:
        """A narrow interval that holds the ``k``-th largest eigenvalue."""
        low, high = self.low, self.high
        while high - low > 64 * _EPS * self.scale:
            middle = (low + high) / 2
            if self.above(middle) >= k:
                low = middle
            else:
                high = middle
        return low, high

    def intervals(self, k: int) -> list[tuple[float, float, int]]:
        """``(low, high, count)`` from the top until the ``k`` largest are covered; eigenvalues closer than a millionth stay together."""
        size, found, done, top = len(self.tri[0]), [], 0, self.high
        while done < k:
            last = done + 1
            least = self.bracket(last)[0] / WIDEST
            while last < min(done + PER_INTERVAL, k) and self.bracket(last + 1)[0] >= least:
                last += 1
            while last < size:
                upper, lower = self.bracket(last), self.bracket(last + 1)
                if upper[0] - lower[1] > 1e-6 * self.scale:
                    break
                last += 1
            bottom = self.low if last >= size else (upper[0] + lower[1]) / 2
            first = self.bracket(done + 1)[1]
            found.append((bottom, min(top, first + (first - bottom) / 4), last - done))
            done, top = last, bottom
        return found


def _ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    basis = np.linalg.qr(block)[0]
    small = basis.T @ matrix @ basis
    values, turns = np.linalg.eigh((small + small.T) / 2)
    return values[::-1], basis @ turns[:, ::-1]


def eigenpairs_within(matrix: np.ndarray, low: float, high: float, count: int, scale: float, seed: int = 11) -> np.ndarray:
    """The eigenvectors of the ``count`` eigenvalues in ``(low, high)``, as columns."""
    size = len(matrix)
    block = np.random.default_rng(seed).normal(size=(size, min(size, 2 * count + 4)))
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    turns = np.exp(1j * np.pi / 2 * (nodes + 1))
    centre, radius = (low + high) / 2, (high - low) / 2
    for round_ in range(MOST_ROUNDS):
        if round_ and round_ % WIDEN_EVERY == 0:
            more = min(block.shape[1], size - block.shape[1])
            block = np.hstack([block, np.random.default_rng(seed + round_).normal(size=(size, more))])
        projected = np.zeros_like(block)
        for turn, weight in zip(turns, weights, strict=True):
            shifted = (centre + radius * turn) * np.eye(size) - matrix
            projected += weight / 2 * (radius * turn * np.linalg.solve(shifted, block.astype(complex))).real
        values, block = _ritz(matrix, projected)
        left_over = np.linalg.norm(matrix @ block - block * values, axis=0)
        # columns beyond the count hold what the projection left of everything else: their residuals stay large
        found = (values > low) & (values < high) & (left_over <= 32 * _EPS * size ** 0.5 * scale)
        if found.sum() == count:
            return block[:, found]
    raise ArithmeticError(f"eigenvalues between {low} and {high} were not found: {int(found.sum())} of {count}")


def largest_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``k`` largest positive eigenvalues, falling, and their unit eigenvectors as rows.

    An eigenvalue that rounding cannot tell from zero is none. Where equal eigenvalues meet the ``k``-th place all of them
    are computed, and any of their vectors may be the ones returned.
    """
    matrix = (matrix + matrix.T) / 2
    scale = float(np.abs(matrix).max(initial=0))
    if not scale:
        return np.zeros(0), np.zeros((0, len(matrix)))
    spectrum = Spectrum(matrix)
    rank = spectrum.above(8 * len(matrix) * _EPS * spectrum.scale)
    k = min(k, rank)
    blocks = [eigenpairs_within(matrix, low, high, count, spectrum.scale) for low, high, count in spectrum.intervals(k)]
    if not blocks:
        return np.zeros(0), np.zeros((0, len(matrix)))
    values, vectors = _ritz(matrix, np.hstack(blocks))
    return values[:k], vectors[:, :k].T
