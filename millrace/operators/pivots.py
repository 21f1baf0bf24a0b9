"""Cells around pivots, and which of them can hold a near neighbour, by the triangle inequality."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MAX_PIVOTS = 1024
SAMPLE_PER_PIVOT = 4
_EPS = float(np.finfo(np.float64).eps)


def unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, lengths, out=np.zeros_like(rows), where=lengths > 0)


def as_euclidean(distance: np.ndarray, metric: str) -> np.ndarray:
    """The reported distance as one that obeys the triangle inequality: of the vectors, or of their directions."""
    return np.sqrt(np.maximum(0.0, distance if metric == "l2" else 2.0 * distance))


@dataclass(frozen=True)
class Pivots:
    """``points`` are few and small enough to be sent to every task. Cosine has one more cell, of the zero vectors."""

    points: np.ndarray
    metric: str

    @property
    def cells(self) -> int:
        return len(self.points) + 1

    def distances(self, rows: np.ndarray) -> tuple[np.ndarray, float]:
        """To every pivot, and how far off they may be. A zero vector is as far from every direction: its cosine is 0."""
        rows = rows if self.metric == "l2" else unit(rows)
        middle = self.points.mean(axis=0)
        near, points = rows - middle, self.points - middle
        a, b = (near * near).sum(axis=1), (points * points).sum(axis=1)
        squares = a[:, None] + b[None, :] - 2.0 * near @ points.T
        largest = float(a.max(initial=0) + b.max(initial=0))
        moved = float(np.abs(rows).max(initial=0) + np.abs(middle).max(initial=0)) * _EPS * rows.shape[1]
        found = np.sqrt(np.maximum(0.0, squares))
        if self.metric == "cosine":
            found[~rows.any(axis=1)] = np.sqrt(2.0)
        return found, 4.0 * (np.sqrt(8 * (rows.shape[1] + 1) * _EPS * largest) + moved)

    def place(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """The cell of each row and the distance to its pivot."""
        found, slack = self.distances(rows)
        cell = found.argmin(axis=1)
        distance = found[np.arange(len(rows)), cell]
        if self.metric == "cosine":
            zero = ~rows.any(axis=1)
            cell[zero], distance[zero] = len(self.points), 0.0
        return cell, distance, slack


@dataclass(frozen=True)
class Cells:
    """What is known of the corpus: per cell the number of rows, and the least and largest distance to the pivot."""

    pivots: Pivots
    counts: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def first(self, distances: np.ndarray, k: int) -> np.ndarray:
        """For each query the nearest cells that together hold ``k`` rows, as a mask."""
        far = np.where(self.counts > 0, self._wide(distances), np.inf)
        order = np.argsort(far, axis=1, kind="stable")
        held = np.cumsum(self.counts[order], axis=1) - self.counts[order]
        mask = np.zeros(far.shape, bool)
        np.put_along_axis(mask, order, held < k, axis=1)
        return mask & (self.counts > 0)

    def _wide(self, distances: np.ndarray) -> np.ndarray:
        """With the cell of the zero vectors, which are all as far from any other."""
        return np.hstack([distances, np.full((len(distances), 1), np.sqrt(2.0))])

    def possible(self, distances: np.ndarray, slack: float, bounds: np.ndarray) -> np.ndarray:
        """The cells that may hold a row within a query's bound.

        A row of a cell is between ``least`` and ``most`` from its pivot, and nearer to it than to the query's own pivot.
        """
        nearest = distances.min(axis=1, keepdims=True)
        lower = np.maximum(np.maximum(distances - self.most[:-1], self.least[:-1] - distances), (distances - nearest) / 2)
        return (self._wide(lower) <= bounds[:, None] + slack) & (self.counts > 0)


def choose_pivots(sample: np.ndarray, wanted: int, metric: str, seed: int = 5, rounds: int = 4) -> Pivots:
    """Pivots spread over a sample: each next one far from those before, then a few means of what is nearest to them."""
    rows = sample if metric == "l2" else unit(sample)
    rows = np.unique(rows[rows.any(axis=1)] if metric == "cosine" else rows, axis=0)
    if not len(rows):
        return Pivots(np.zeros((1, sample.shape[1])), metric)
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(rows)))]
    gaps = ((rows - rows[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(wanted, len(rows)) and gaps.max() > 0:
        chosen.append(int(rng.choice(len(rows), p=gaps / gaps.sum())))
        gaps = np.minimum(gaps, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    points = rows[chosen]
    for _ in range(rounds):
        cell = Pivots(points, "l2").place(rows)[0]
        sums, counts = np.zeros_like(points), np.bincount(cell, minlength=len(points))[:, None]
        np.add.at(sums, cell, rows)
        points = np.divide(sums, counts, out=points.copy(), where=counts > 0)
    return Pivots(points, metric)
