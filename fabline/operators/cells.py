"""Voronoi cells round sampled pivots: exact pruning for nearest neighbours (J7, R1).

Every training vector belongs to its nearest pivot. A cell is known by its pivot, its rows, the range of their distances
to the pivot and the ``k`` smallest of these. That gives, for a query and without a look at any training vector,

- an upper bound on its k-th neighbour's distance: the k-th smallest of d(query, pivot) + d(pivot, row) over those rows;
- a lower bound on its distance to all rows of a cell: from the ring the rows lie in (triangle inequality) and from the
  plane half way between the cell's pivot and the query's own.

A query is sent to the cells alone whose lower bound does not exceed its upper one, and there it is measured against the
rows of a ring. Which vectors are pivots changes the cost, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Rounding of sums and products can't move a bound further than this share of the lengths involved.
SLACK = 1e-6
CHUNK = 256


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(len(a), len(b)) Euclidean distances."""
    d2 = np.einsum("ad,ad->a", a, a)[:, None] + np.einsum("bd,bd->b", b, b)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(d2, 0.0))


def reach(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row of ``a``, what its distances to rows of ``b`` may be off by."""
    longest = np.sqrt(np.einsum("bd,bd->b", b, b).max(initial=0.0))
    return SLACK * (np.sqrt(np.einsum("ad,ad->a", a, a)) + longest) + 1e-12


def home(t: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, distance to its pivot) of the rows of ``t``."""
    cell, dist = np.zeros(len(t), np.int64), np.zeros(len(t))
    for lo in range(0, len(t), CHUNK):
        d = distances(t[lo:lo + CHUNK], pivots)
        cell[lo:lo + CHUNK] = d.argmin(1)
        dist[lo:lo + CHUNK] = d.min(1)
    return cell, dist


def chain(pivots: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """Each cell's block: cells in a walk from pivot to nearest pivot not yet seen, cut where ``most`` rows are full. A
    larger cell is a block of its own."""
    apart = distances(pivots, pivots)
    block, at, free = np.zeros(len(pivots), np.int64), 0, np.ones(len(pivots), dtype=bool)
    number, held = 0, 0
    for _ in range(len(pivots)):
        free[at] = False
        if held and held + rows[at] > most:
            number, held = number + 1, 0
        block[at], held = number, held + rows[at]
        at = int(np.where(free, apart[at], np.inf).argmin())
    return block


class Cells:
    """What a query needs to know of the cells: ``near`` (cells, k) holds the smallest distances to the pivot, infinite
    where a cell has fewer rows; ``low`` and ``high`` are the range of all."""

    def __init__(self, pivots: np.ndarray, near: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.pivots, self.near, self.low, self.high = pivots, near, low, high
        self.apart = distances(pivots, pivots)

    def route(self, q: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, float]]:
        """(query, cells to search, distances to their pivots, upper bound on the k-th neighbour's distance)."""
        k = self.near.shape[1]
        for lo in range(0, len(q), CHUNK):
            part = q[lo:lo + CHUNK]
            d, off = distances(part, self.pivots), reach(part, self.pivots)
            bound = np.full((len(part), k), np.inf)
            for j in range(k):  # the j-th rows of all cells; the k best so far suffice
                bound = np.partition(np.concatenate([bound, d + self.near[:, j]], axis=1), k - 1, axis=1)[:, :k]
            bound = bound.max(1) + off
            own = d.argmin(1)
            apart = self.apart[own]
            plane = np.divide(d ** 2 - d[np.arange(len(part)), own][:, None] ** 2, 2 * apart, out=np.zeros_like(d), where=apart > 0)
            # The plane bound divides by the pivots' distance, and so does its rounding.
            blur = np.divide((d + off[:, None]) * off[:, None], apart, out=np.zeros_like(d), where=apart > 0)
            least = np.maximum(np.maximum(d - self.high, self.low - d), plane - 2 * blur) - off[:, None]
            wanted = ~(least > bound[:, None])  # what can't be compared is searched
            wanted &= np.isfinite(self.near[:, 0])
            for i in range(len(part)):
                c = np.flatnonzero(wanted[i])
                yield lo + i, c, d[i, c], float(bound[i])


def rings(q: np.ndarray, q_dist: np.ndarray, bound: np.ndarray, t: np.ndarray, t_dist: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(queries, training rows) of one cell that have to be measured against each other: queries at a like distance from
    the pivot meet the rows between the nearest and the farthest that any of them can use. A query whose distances are
    no numbers (an infinite component) has no ring and leaves the others theirs."""
    if not len(q) or not len(t):
        return
    off = reach(q, t)
    order, rows = np.argsort(q_dist, kind="stable"), np.argsort(t_dist, kind="stable")
    sorted_dist = t_dist[rows]
    for lo in range(0, len(q), CHUNK):
        some = order[lo:lo + CHUNK]
        width = bound[some] + off[some]
        some, width = some[~np.isnan(q_dist[some] + width)], width[~np.isnan(q_dist[some] + width)]
        a = np.searchsorted(sorted_dist, (q_dist[some] - width).min(initial=np.inf), "left")
        b = np.searchsorted(sorted_dist, (q_dist[some] + width).max(initial=-np.inf), "right")
        if a < b:
            yield some, rows[a:b]
