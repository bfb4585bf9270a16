"""Cover trees over the rows of one task, walked in pairs."""

from __future__ import annotations

import numpy as np


class CoverTree:
    """Nested levels of balls with halving radii.

    A node's rows are a range of ``rows``; its children are balls of half its
    radius at most whose centres are rows of its own, its own centre the first.
    ``radius`` is the measured distance of the furthest row. A node of few rows,
    or whose halved balls would hold hardly more than their centres, is a leaf.
    """

    def __init__(self, points: np.ndarray, leaf: int = 128, least: int = 4):
        self.points, self.leaf, self.least = points, leaf, least
        self.rows = np.arange(len(points))
        self.center: list[int] = []
        self.radius: list[float] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        if len(points):
            self._grow()

    def _node(self, center: int, low: int, high: int, far: np.ndarray) -> int:
        self.center.append(center)
        self.radius.append(float(far.max()))
        self.span.append((low, high))
        self.children.append([])
        return len(self.center) - 1

    def _away(self, center: int, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.points[rows] - self.points[center]) ** 2).sum(axis=1))

    def _grow(self) -> None:
        far = self._away(0, self.rows)
        todo = [self._node(0, 0, len(self.rows), far)]
        while todo:
            node = todo.pop()
            low, high = self.span[node]
            if high - low <= self.leaf or self.radius[node] == 0.0:
                continue
            half, left, balls = self.radius[node] / 2, self.rows[low:high], []
            center, most = self.center[node], (high - low) // self.least
            while len(left) and len(balls) <= most:
                far = self._away(center, left)
                near = far <= half
                balls.append((center, left[near], far[near]))
                left = left[~near]
                center = int(left[0]) if len(left) else -1
            if len(left):
                continue
            at = low
            for center, rows, far in balls:
                self.rows[at:at + len(rows)] = rows
                child = self._node(center, at, at + len(rows), far)
                self.children[node].append(child)
                todo.append(child)
                at += len(rows)

    def of(self, node: int) -> np.ndarray:
        low, high = self.span[node]
        return self.rows[low:high]


def near_pairs(a: CoverTree, b: CoverTree, reach: float):
    """Leaf pairs ``(rows of a, rows of b)`` that may hold points within ``reach``.

    Node pairs are pruned when their centres are further apart than ``reach``
    and both radii. With ``a is b`` a pair of nodes is met once.
    """
    if not len(a.rows) or not len(b.rows):
        return
    slack = reach + 1e-9
    todo = [(0, 0)]
    while todo:
        x, y = todo.pop()
        apart = np.sqrt(((a.points[a.center[x]] - b.points[b.center[y]]) ** 2).sum())
        if apart > slack + a.radius[x] + b.radius[y]:
            continue
        xs, ys = a.children[x] or [x], b.children[y] or [y]
        if xs == [x] and ys == [y]:
            yield a.of(x), b.of(y)
        elif a is b and x == y:
            todo += [(p, q) for i, p in enumerate(xs) for q in xs[i:]]
        elif ys == [y] or xs != [x] and a.radius[x] >= b.radius[y]:
            todo += [(p, y) for p in xs]
        else:
            todo += [(x, q) for q in ys]


def best_scores(queries: CoverTree, data: CoverTree, query_ids: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray):
    """The k best inner products per query: ``(scores, ids)``, ids -1 where fewer exist.

    ``floor`` are scores every query is known to reach k times elsewhere or
    -inf. A node pair is pruned when even the corner points of its balls give
    less than the worst kth score of the query node. Ties go to smaller ids; a
    query never meets a row of its own id.
    """
    n = len(query_ids)
    scores, found = np.full((n, k), -np.inf), np.full((n, k), -1, np.int64)
    if not n or not len(ids):
        return scores, found
    query_norm = np.sqrt((queries.points ** 2).sum(axis=1))
    data_norm = np.sqrt((data.points ** 2).sum(axis=1))

    def bound(x: int, y: int) -> float:
        c, d, r, s = queries.center[x], data.center[y], queries.radius[x], data.radius[y]
        top = queries.points[c] @ data.points[d] + r * data_norm[d] + s * query_norm[c] + r * s
        return top + 1e-9 * abs(top) + 1e-6

    todo = [(bound(0, 0), 0, 0)]
    while todo:
        top, x, y = todo.pop()
        rows = queries.of(x)
        if top < np.maximum(scores[rows, k - 1], floor[rows]).min():
            continue
        xs, ys = queries.children[x], data.children[y]
        if xs and (not ys or queries.radius[x] >= data.radius[y]):
            todo += sorted((bound(p, y), p, y) for p in xs)
        elif ys:
            todo += sorted((bound(x, q), x, q) for q in ys)  # the most promising is taken first
        else:
            cols = data.of(y)
            for at in range(0, len(rows), 256):
                part = rows[at:at + 256]
                for low in range(0, len(cols), 4096):
                    own = cols[low:low + 4096]
                    met = queries.points[part] @ data.points[own].T
                    met[query_ids[part][:, None] == ids[own][None, :]] = -np.inf
                    if met.shape[1] > k:
                        least = np.partition(met, met.shape[1] - k, axis=1)[:, -k][:, None]
                        hit = met >= np.maximum(least, np.maximum(scores[part, k - 1], floor[part])[:, None])
                    else:
                        hit = met > -np.inf
                    hit &= met > -np.inf
                    r, c = np.nonzero(hit)
                    if not len(r):
                        continue
                    touched = np.unique(r)
                    row = np.concatenate([r, np.repeat(touched, k)])
                    score = np.concatenate([met[r, c], scores[part[touched]].ravel()])
                    ident = np.concatenate([ids[own][c], found[part[touched]].ravel()])
                    order = np.lexsort((ident, -score, row))
                    row, score, ident = row[order], score[order], ident[order]
                    first = np.searchsorted(row, touched)
                    take = first[:, None] + np.arange(k)
                    scores[part[touched]], found[part[touched]] = score[take], ident[take]
    found[scores == -np.inf] = -1
    return scores, found
