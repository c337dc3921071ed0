"""Pairs of edges that may meet, in numpy, in blocks of bounded size.

Edges of large groups are swept in the order of one coordinate, each beside those alone that begin before it ends.
"""

from __future__ import annotations

import numpy as np

#: Pairs of edges looked at together.
BLOCK = 1 << 20
#: Shapes of so many edges are not worth sorting.
FEW = 24


def blocks(first: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Index arrays of (first[k], each of low[k] to high[k] - 1, k), in blocks."""
    n = np.maximum(high - low, 0)
    total = np.cumsum(n)
    at = 0
    while at < len(n):
        stop = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + BLOCK, side="right")), at + 1)
        m = n[at:stop]
        k = np.repeat(np.arange(at, stop), m)
        yield first[k], low[k] + np.arange(len(k)) - np.repeat(np.cumsum(m) - m, m), k
        at = stop


def sweep(group: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges by group and where they begin; and for each in this order the place behind the last that begins before it ends."""
    n = len(low)
    order = np.lexsort((np.repeat((0, 1), n), np.concatenate((low, high)), np.concatenate((group, group))))
    begins = order < n
    stop = np.empty(n, np.int64)
    stop[order[~begins] - n] = np.cumsum(begins)[~begins]
    order = order[begins]
    return order, stop[order]


def near_pairs(group: np.ndarray, x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray):
    """Blocks of pairs (i, j), i < j, of edges of one group whose boxes meet; edges come group by group.

    A group is swept along the coordinate that leaves fewer pairs.
    """
    low, high = (np.minimum(x1, x2), np.minimum(y1, y2)), (np.maximum(x1, x2), np.maximum(y1, y2))
    size = np.bincount(group, minlength=1) if len(group) else np.zeros(1, np.int64)

    def boxes_meet(i, j):
        near = np.flatnonzero((low[0][i] <= high[0][j]) & (low[0][j] <= high[0][i]) & (low[1][i] <= high[1][j]) & (low[1][j] <= high[1][i]))
        return np.minimum(i[near], j[near]), np.maximum(i[near], j[near])

    few = np.flatnonzero(size[group] <= FEW)
    for i, j, _ in blocks(few, few + 1, np.searchsorted(group, group[few], side="right")):
        yield boxes_meet(i, j)
    many = np.flatnonzero(size[group] > FEW)
    if not len(many):
        return
    of = group[many]
    pairs = []
    for a, b in zip(low, high):
        order, stop = sweep(of, a[many], b[many])
        pairs.append(np.bincount(of[order], stop - np.arange(len(many)), len(size)))
    along_x = (pairs[0] <= pairs[1])[of]
    order, stop = sweep(of, *(np.where(along_x, b[0][many], b[1][many]) for b in (low, high)))
    for i, j, _ in blocks(np.arange(len(many)), np.arange(len(many)) + 1, stop):
        yield boxes_meet(many[order[i]], many[order[j]])
