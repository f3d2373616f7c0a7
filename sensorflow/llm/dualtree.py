"""Nearest entries of many points by two trees, with integers only.

A tree halves its points at the median of their widest side until a node is small; a node knows its box and the sum of its
points. Both trees are walked down together, level by level: of all pairs (node of points, node of entries) those go whose least
distance is above the largest distance to another node of entries. A node of points with one single entry left gets it as a
whole; only points of leaves with several entries left are compared one by one. All bounds are exact integers and equal
distances are never pruned, so the result is the nearest entry, the lowest index among equals.

No points give empty results; equal points share one box without extent, however many there are. Components must stay within
2**27 and a part within 256 of them, so that squared distances fit 64 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 32


@dataclass
class Tree:
    """Points in the order of the leaves. Level i has nodes ``bounds[i][j]:bounds[i][j + 1]`` of that order."""

    points: np.ndarray
    order: np.ndarray
    bounds: list[np.ndarray]
    children: list[np.ndarray]  # children[i][j]:children[i][j + 1] are node j's nodes in level i + 1
    lows: list[np.ndarray]
    highs: list[np.ndarray]
    sums: list[np.ndarray]


def split(points: np.ndarray, leaf: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Order of the points, and bounds and children of each level."""
    order, bound = np.arange(len(points)), np.array([0, len(points)])
    bounds, children = [bound], []
    while (np.diff(bound) > leaf).any():
        sizes = np.diff(bound)
        inside = points[order]
        spread = np.maximum.reduceat(inside, bound[:-1]) - np.minimum.reduceat(inside, bound[:-1])
        node = np.repeat(np.arange(len(sizes)), sizes)
        widest = inside[np.arange(len(inside)), spread.argmax(axis=1)[node]]
        order = order[np.lexsort((widest, node))]
        large = sizes > leaf
        first = np.concatenate([[0], np.cumsum(1 + large)])
        below = np.empty(first[-1] + 1, np.int64)
        below[first] = bound
        below[first[:-1][large] + 1] = (bound[:-1] + sizes // 2)[large]
        bound = below
        bounds.append(bound)
        children.append(first)
    return order, bounds, children


def grow(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """A tree over one row per point, at least one."""
    order, bounds, children = split(points, leaf)
    return planted(points[order], order, bounds, children)


def planted(inside: np.ndarray, order: np.ndarray, bounds: list[np.ndarray], children: list[np.ndarray]) -> Tree:
    """The tree of points that already stand in its order."""
    lows = [np.minimum.reduceat(inside, bound[:-1]) for bound in bounds]
    highs = [np.maximum.reduceat(inside, bound[:-1]) for bound in bounds]
    sums = [np.add.reduceat(inside, bound[:-1]) for bound in bounds]
    return Tree(inside, order, bounds, children, lows, highs, sums)


def _expanded(nodes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position in ``nodes`` and child, for all children of all nodes."""
    sizes = first[nodes + 1] - first[nodes]
    at = np.repeat(np.arange(len(nodes)), sizes)
    inner = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return at, first[nodes][at] + inner


def nearest(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Each point's entry (in the order of the points given to ``grow``), sum and count of each entry's points, and how
    many points came to their entry as part of a whole node."""
    book = grow(entries, 1)
    chosen = np.full(len(tree.points), -1, np.int64)
    sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
    whole = level = depth = 0
    node = np.zeros(1, np.int64)  # pairs, sorted by node
    other = np.zeros(1, np.int64)
    while len(node):
        low, high = tree.lows[level][node], tree.highs[level][node]
        book_low, book_high = book.lows[depth][other], book.highs[depth][other]
        near = (np.maximum(0, np.maximum(book_low - high, low - book_high)) ** 2).sum(axis=1)
        far = (np.maximum(high - book_low, book_high - low) ** 2).sum(axis=1)
        begins = np.flatnonzero(np.diff(node, prepend=-1))
        reach = np.repeat(np.minimum.reduceat(far, begins), np.diff(begins, append=len(node)))
        node, other = node[near <= reach], other[near <= reach]

        single = depth + 1 == len(book.bounds)
        if single:
            begins = np.flatnonzero(np.diff(node, prepend=-1))
            alone = np.diff(begins, append=len(node)) == 1
            sure = begins[alone]
            bound = tree.bounds[level]
            for n, entry in zip(node[sure].tolist(), book.order[other[sure]].tolist(), strict=True):
                chosen[bound[n] : bound[n + 1]] = entry
                sums[entry] += tree.sums[level][n]
                counts[entry] += bound[n + 1] - bound[n]
                whole += int(bound[n + 1] - bound[n])
            open_ = np.ones(len(node), bool)
            open_[sure] = False
            node, other = node[open_], other[open_]
            if level + 1 == len(tree.bounds):
                break
        if level + 1 < len(tree.bounds):
            at, node = _expanded(node, tree.children[level])
            other = other[at]
            level += 1
        if not single:
            at, other = _expanded(other, book.children[depth])
            node = node[at]
            depth += 1
        # children of one pair stand together, those of one node need not
        by = np.argsort(node, kind="stable")
        node, other = node[by], other[by]
    if len(node):
        _leaves(tree, node, book.order[other], entries, chosen, sums, counts)
    out = np.empty_like(chosen)
    out[tree.order] = chosen
    return out, sums, counts, whole


def _leaves(tree: Tree, node: np.ndarray, entry: np.ndarray, entries: np.ndarray, chosen, sums, counts) -> None:
    """Points of leaves with several entries left, each against these."""
    at, point = _expanded(node, tree.bounds[-1])
    open_, row = np.unique(point, return_inverse=True)
    distances = np.full((len(open_), len(entries)), np.iinfo(np.int64).max)
    distances[row, entry[at]] = ((tree.points[point] - entries[entry[at]]) ** 2).sum(axis=1)
    best = distances.argmin(axis=1)
    chosen[open_] = best
    np.add.at(sums, best, tree.points[open_])
    counts += np.bincount(best, minlength=len(entries))
