"""R-trees over count vectors, and the links of many points by searching one.

A point is the vector of how many of a set's tokens fall into each group of tokens; coordinate
minima summed up bound the overlap of two sets from above, and with a node's coordinate maxima, that
of a set with every set in the node. A node is left out if its bound is too small for its sizes,
or if all its points are in the searching point's component already.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

FANOUT = 32
QUERIES = 64
PAIRS_AT_ONCE = 1 << 22


def needed(total: np.ndarray) -> np.ndarray:
    """Least overlap of two sets with ``total`` elements together for 100 * overlap >= 80 * union."""
    return -(-4 * total // 9)


def overlap_bound(a: np.ndarray, b: np.ndarray, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """Summed coordinate minima of the rows ``ia`` of a and ``ib`` of b."""
    out = np.empty(len(ia), np.int64)
    step = max(1, PAIRS_AT_ONCE // max(1, a.shape[1]))
    for i in range(0, len(ia), step):
        out[i : i + step] = np.minimum(a[ia[i : i + step]], b[ib[i : i + step]]).sum(1, dtype=np.int32)
    return out


class CountTree:
    """Points packed by size and then by their first coordinates; leaves of FANOUT points, nodes of FANOUT nodes."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        coarse = vectors[:, : min(4, vectors.shape[1])]
        self.order = np.lexsort((*coarse.T[::-1], sizes))
        self.vectors, self.sizes = vectors, sizes
        level = (vectors[self.order], sizes[self.order], sizes[self.order])
        self.levels = [level]
        while len(level[1]) > FANOUT:
            cut = np.arange(0, len(level[1]), FANOUT)
            level = (
                np.maximum.reduceat(level[0], cut, axis=0),
                np.minimum.reduceat(level[1], cut),
                np.maximum.reduceat(level[2], cut),
            )
            self.levels.append(level)

    def label(self, component: np.ndarray) -> None:
        """Smallest and largest component in each node."""
        low = high = component[self.order]
        self.spans = [(low, high)]
        for level in self.levels[1:]:
            cut = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            self.spans.append((low, high))
            assert len(low) == len(level[1])

    def search(self, asked: np.ndarray, component: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, point, bound) of the points in other components that the bounds don't rule out."""
        count = len(self.levels[-1][1])
        query, node = np.repeat(asked, count), np.tile(np.arange(count), len(asked))
        bound = np.zeros(0, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            (top, low, high), (first, last) = self.levels[depth], self.spans[depth]
            n = self.sizes[query]
            fits = (5 * high[node] >= 4 * n) & (4 * low[node] <= 5 * n)
            fits &= (first[node] != component[query]) | (last[node] != component[query])
            query, node = query[fits], node[fits]
            bound = overlap_bound(self.vectors, top, query, node)
            least = np.maximum(low[node], -(-4 * self.sizes[query] // 5))
            fits = bound >= needed(self.sizes[query] + least)
            query, node, bound = query[fits], node[fits], bound[fits]
            if depth:
                below = len(self.levels[depth - 1][1])
                query = np.repeat(query, FANOUT)
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                query, node = query[node < below], node[node < below]
        return query, self.order[node], bound


def connect(
    vectors: np.ndarray,
    sizes: np.ndarray,
    accept: Callable[[int, int], bool] | None = None,
    side: np.ndarray | None = None,
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Components of the points, and the links that make them: pairs within the bounds that ``accept`` confirms.

    Only pairs of different components are tried, the best bound first, so there are fewer links
    than points. With ``side``, only pairs of points on different sides are.
    """
    parent = list(range(len(sizes)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links: list[tuple[int, int]] = []

    def join(query: np.ndarray, point: np.ndarray, bound: np.ndarray) -> bool:
        if side is not None:
            other = side[query] != side[point]
            query, point, bound = query[other], point[other], bound[other]
        score = bound / (sizes[query] + sizes[point] - bound)
        merged = False
        for i in np.argsort(-score, kind="stable").tolist():
            a, b = int(query[i]), int(point[i])
            x, y = find(a), find(b)
            if x != y and (accept is None or accept(a, b)):
                parent[max(x, y)] = min(x, y)
                links.append((a, b))
                merged = True
        return merged

    if len(sizes) <= FANOUT:
        a, b = np.triu_indices(len(sizes), 1)
        fits = (5 * sizes[a] >= 4 * sizes[b]) & (4 * sizes[a] <= 5 * sizes[b])
        a, b = a[fits], b[fits]
        bound = overlap_bound(vectors, vectors, a, b)
        fits = bound >= needed(sizes[a] + sizes[b])
        join(a[fits], b[fits], bound[fits])
    else:
        tree = CountTree(vectors, sizes)
        component = np.arange(len(sizes))
        tree.label(component)
        for begin in range(0, len(sizes), QUERIES):
            query, point, bound = tree.search(tree.order[begin : begin + QUERIES], component)
            if accept is None and side is None and len(query):
                # one point of each component will do
                _, pick = np.unique(np.stack([query, component[point]]), axis=1, return_index=True)
                query, point, bound = query[pick], point[pick], bound[pick]
            if join(query, point, bound):
                component = np.fromiter(map(find, range(len(sizes))), np.int64, len(sizes))
                tree.label(component)
    return np.fromiter(map(find, range(len(sizes))), np.int64, len(sizes)), links


def overlaps(sets: list[np.ndarray], query: int, points: np.ndarray, held: np.ndarray) -> np.ndarray:
    """How many elements the set of ``query`` has in common with each of the others; elements are small integers,
    and ``held`` has a place for each, all False."""
    held[sets[query]] = True
    out = np.empty(len(points), np.int64)
    ends = np.cumsum([len(sets[p]) for p in points.tolist()])
    begin = 0
    while begin < len(points):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + PAIRS_AT_ONCE, "right")))
        found = held[np.concatenate([sets[p] for p in points[begin:end].tolist()])]
        first = np.append(0, ends[begin : end - 1] - before)
        out[begin:end] = np.add.reduceat(found, first, dtype=np.int64)
        begin = end
    held[sets[query]] = False
    return out


def link_counts(vectors: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None = None) -> np.ndarray:
    """With how many others each set links: every pair that the bounds let through is verified.

    With ``side``, only pairs of sets on different sides count. No set is empty.
    """
    sizes = np.array(list(map(len, sets)))
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.split(ids, np.cumsum(sizes)[:-1])
    held = np.zeros(len(values), bool)
    tree = CountTree(vectors, sizes)
    apart = np.arange(len(sizes)) if side is None else side
    tree.label(apart)
    counts = np.zeros(len(sizes), np.int64)
    for begin in range(0, len(sizes), QUERIES):
        query, point, _ = tree.search(tree.order[begin : begin + QUERIES], apart)
        other = apart[query] != apart[point]
        query, point = query[other], point[other]
        order = np.argsort(query, kind="stable")
        query, point = query[order], point[order]
        first = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.zeros(0, np.int64)
        for b, e in zip(first.tolist(), [*first[1:].tolist(), len(query)], strict=False):
            q = int(query[b])
            both = overlaps(own, q, point[b:e], held)
            counts[q] = int((100 * both >= 80 * (sizes[q] + sizes[point[b:e]] - both)).sum())
    return counts
