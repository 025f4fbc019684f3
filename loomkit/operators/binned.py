"""Classification forests grown over counted bins instead of rows.

Spark's forests cut every number into at most ``maxBins`` bins and see nothing
else of it: rows of equal bins and class are alike to every tree.  Where a
table has more rows than its features have combinations of bins (cells), its
rows are counted per cell in one pass, and a task grows whole trees over the
counts: the memory and the work of a tree depend on the bins, not on the rows.

The forest is the one that Spark grows, step by step: its rule for the bins,
its split search (numbers by threshold, categories ordered by their count of
class 1), Gini gain, ``minInstancesPerNode``, a draw of features per node, and
the merging of leaves that predict alike.  The bootstrap gives each row
Poisson(1) copies, so n equal rows get Poisson(n) together.  Tree t of a seed
draws from a generator of its own: the draws do not depend on partitions, and
smaller forests are prefixes of larger ones, upper levels those of shallower
trees.  The draws are others than Spark's, whose own change with the
partitions of its input.  Functions here need numpy only (they run in tasks).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# More combinations of bins are not counted: the rows go to Spark's forest.
MOST_CELLS = 1 << 16
# Children of less impurity are leaves (Spark's own limit).
EPSILON = 2.0 ** -52


@dataclass
class Cells:
    """Counted rows: codes (cell x feature), how many codes a feature has, whether it is a category, and the rows of
    each cell by class, for those trained on and those held out."""

    codes: np.ndarray
    bins: list
    category: list
    train: np.ndarray
    test: np.ndarray


def thresholds(values: np.ndarray, rows: float, max_bins: int) -> np.ndarray:
    """Spark's cuts of a number, from the values looked at: midpoints between neighbouring values, all of them or those
    nearest to equal shares.  As there, zeros are what is missing to the ``rows`` expected."""
    value, count = np.unique(values[values != 0], return_counts=True)
    zeros = rows - count.sum()
    if not len(value):
        return value
    if zeros > EPSILON * count.sum() * 100:
        at = np.searchsorted(value, 0.0)
        value, count = np.insert(value, at, 0.0), np.insert(count.astype(float), at, zeros)
    mid = (value[:-1] + value[1:]) / 2.0
    if len(mid) < max_bins:
        return mid
    stride = rows / max_bins
    out, target, seen = [], stride, count[0]
    for i in range(1, len(value)):
        before, seen = seen, seen + count[i]
        if abs(before - target) < abs(seen - target):
            out.append(mid[i - 1])
            target += stride
    return np.array(out)


def encode(rows: np.ndarray, cuts: list, arity: dict) -> np.ndarray:
    """The cell of each row in mixed radix, -1 where a value is no number or no category."""
    cell, good = np.zeros(len(rows), np.int64), np.isfinite(rows).all(axis=1)
    for j in range(rows.shape[1]):
        x = np.where(good, rows[:, j], 0.0)
        if j in arity:
            code = x.astype(np.int64)
            good &= (code == x) & (code >= 0) & (code < arity[j])
            cell = cell * arity[j] + np.where(good, code, 0)
        else:
            cell = cell * (len(cuts[j]) + 1) + np.searchsorted(cuts[j], x, side="left")
    return np.where(good, cell, -1)


def decode(cell: np.ndarray, bins: list) -> np.ndarray:
    """The codes of cells."""
    codes = np.empty((len(cell), len(bins)), np.int64)
    for j in range(len(bins) - 1, -1, -1):
        cell, codes[:, j] = np.divmod(cell, bins[j])
    return codes


def gini(a, b):
    total = a + b
    p, q = a / total, b / total
    return 1.0 - p * p - q * q


def drawn(rng, nodes: int, width: int, size: int) -> np.ndarray:
    """``size`` of ``width`` features for each node, by reservoir sampling."""
    out = np.tile(np.arange(size), (nodes, 1))
    for i in range(size, width):
        at = (rng.random(nodes) * (i + 1)).astype(np.int64)
        hit = np.flatnonzero(at < size)
        out[hit, at[hit]] = i
    return out


def _best_of(code, bins: int, category: bool, node, a, b, ta, tb, least: int):
    """For each node the best split of one feature: gain (-inf: none), last code on its left, the order of its codes
    (categories only) and the counts of both classes on its left.  ``ta``, ``tb``: the counts of the nodes."""
    n = len(ta)
    key = node * bins + code
    ha, hb = (np.bincount(key, weights=w, minlength=n * bins).reshape(n, bins) for w in (a, b))
    order = None
    if category:
        order = np.argsort(np.where(ha + hb > 0, hb, np.inf), axis=1, kind="stable")
        ha, hb = np.take_along_axis(ha, order, 1), np.take_along_axis(hb, order, 1)
    la, lb = np.cumsum(ha, axis=1), np.cumsum(hb, axis=1)
    left = la + lb
    # an empty bin splits like the one before it, and the first of equal splits is taken
    at, end = np.nonzero((ha + hb > 0) & (left >= least) & ((ta + tb)[:, None] - left >= least))
    gain, split = np.full(n, -np.inf), np.zeros(n, np.int64)
    if len(at):
        xa, xb = la[at, end], lb[at, end]
        ra, rb = ta[at] - xa, tb[at] - xb
        total = (xa + xb) + (ra + rb)
        g = gini(ta, tb)[at] - (xa + xb) / total * gini(xa, xb) - (ra + rb) / total * gini(ra, rb)
        start = np.flatnonzero(np.diff(at, prepend=-1))
        gain[at[start]] = np.maximum.reduceat(g, start)
        first = np.flatnonzero(g == gain[at])[::-1]
        split[at[first]] = end[first]
    here = np.arange(n), split
    return gain, split, order, la[here], lb[here]


def grow(cells: Cells, bag: np.ndarray, depth: int, least: int, size: int, rng) -> tuple:
    """A tree over the cells with the counts ``bag``: the nodes of each level, the children of each node (-1: a leaf),
    its counts, and the leaf of every cell, those with no row in the bag too."""
    width, most = len(cells.bins), max(cells.bins)
    at = np.zeros(len(cells.codes), np.int64)
    counts, left, right = [bag.sum(axis=0, dtype=float)[None]], [np.array([-1])], [np.array([-1])]
    levels, nodes = [np.array([0])], 1
    todo, total = levels[0], counts[0]
    held, weight = bag.sum(axis=1) > 0, bag.astype(float)
    place = np.array([0])
    live = np.arange(len(at))
    while len(todo) and len(levels) <= depth:
        n = len(todo)
        tried = drawn(rng, n, width, size)
        gains, splits = np.full((n, width), -np.inf), np.zeros((n, width), np.int64)
        la, lb, orders = np.zeros((n, width)), np.zeros((n, width)), {}
        mine = live[held[live]]
        node = place[at[mine]]
        ta, tb = total[:, 0], total[:, 1]
        for j in range(width):
            if cells.bins[j] < 2:
                continue
            of = np.flatnonzero((tried == j).any(axis=1))
            if not len(of):
                continue
            local = np.full(n, -1)
            local[of] = np.arange(len(of))
            some = local[node]
            keep = slice(None) if len(of) == n else np.flatnonzero(some >= 0)
            c = mine[keep]
            gains[of, j], splits[of, j], order, la[of, j], lb[of, j] = _best_of(
                cells.codes[c, j], cells.bins[j], cells.category[j], some[keep], weight[c, 0], weight[c, 1], ta[of], tb[of], least)
            if order is not None:
                orders[j] = (local, order)
        row = np.arange(n)
        best = tried[row, np.take_along_axis(gains, tried, 1).argmax(axis=1)]
        good = np.flatnonzero(gains[row, best] > 0)
        if not len(good):
            break
        best = best[good]
        split = splits[good, best]
        goes = np.arange(most)[None, :] <= split[:, None]
        for j, (local, order) in orders.items():
            i = np.flatnonzero(best == j)
            rank = np.argsort(order[local[good[i]]], axis=1)
            goes[i, :rank.shape[1]] = rank <= split[i, None]
        a, b = la[good, best], lb[good, best]
        below = np.empty((2 * len(good), 2))
        below[0::2, 0], below[0::2, 1] = a, b
        below[1::2] = total[good] - below[0::2]
        ids = nodes + np.arange(2 * len(good))
        all_left = np.full(2 * len(good), -1)
        left.append(all_left)
        right.append(all_left.copy())
        counts.append(below)
        # levels are numbered one after another: the last but one pair of arrays is that of the nodes split
        base = levels[-1][0]
        left[-2][todo[good] - base], right[-2][todo[good] - base] = ids[0::2], ids[1::2]
        # cells go on below the nodes that were split
        cut = np.full(n, -1)
        cut[good] = np.arange(len(good))
        here = cut[place[at[live]]]
        live, here = live[here >= 0], here[here >= 0]
        at[live] = ids[0] + 2 * here + ~goes[here, cells.codes[live, best[here]]]
        nodes += len(ids)
        levels.append(ids)
        impure = gini(below[:, 0], below[:, 1]) >= EPSILON
        todo, total = ids[impure], below[impure]
        place = np.full(nodes, -1)
        place[todo] = np.arange(len(todo))
        live = live[impure[at[live] - ids[0]]]
    return levels, np.concatenate(left), np.concatenate(right), np.concatenate(counts), at


def voting(levels, left, right, prediction, depth: int) -> np.ndarray:
    """For each node, the leaf above it (or itself) in the tree cut to ``depth`` (-1: it is inside the cut tree).
    Leaves that predict alike are merged into their parent."""
    ends = left < 0
    if depth < len(levels):
        ends[levels[depth]] = True
    for level in reversed(levels[:depth]):
        inner = level[left[level] >= 0]
        a, b = left[inner], right[inner]
        ends[inner] = ends[a] & ends[b] & (prediction[a] == prediction[b])
    at = np.full(len(left), -1)
    at[levels[0]] = np.where(ends[levels[0]], levels[0], -1)
    for level in levels:
        inner = level[left[level] >= 0]
        for below in (left[inner], right[inner]):
            at[below] = np.where(at[inner] >= 0, at[inner], np.where(ends[below], below, -1))
    return at


def votes(cells: Cells, sizes: list, least: int, size: int, seed: int, bootstrap: bool = True):
    """Yields (depth, trees, summed votes of every cell) for the ``(depth, trees)`` sizes of a forest, of which the
    largest is grown."""
    most = {d: max(n for x, n in sizes if x == d) for d, _ in sizes}
    summed = {d: np.zeros((len(cells.codes), 2)) for d in most}
    for t in range(max(most.values())):
        rng = np.random.default_rng([seed % (1 << 64), t])
        bag = rng.poisson(cells.train) if bootstrap else cells.train
        depths = [d for d in most if most[d] > t]
        levels, left, right, counts, leaf = grow(cells, bag, max(depths), least, size, rng)
        total = counts.sum(axis=1, keepdims=True)
        share = np.divide(counts, total, out=np.zeros_like(counts), where=total != 0)
        for d in depths:
            summed[d] += share[voting(levels, left, right, counts.argmax(axis=1), d)[leaf]]
            if (d, t + 1) in sizes:
                yield d, t + 1, summed[d]


def confusions(cells: Cells, sizes: list, least: int, size: int, seed: int, bootstrap: bool = True) -> dict:
    """``{(depth, trees): counts}`` by part (held out, trained on), class and prediction."""
    out = {}
    for d, n, summed in votes(cells, sizes, least, size, seed, bootstrap):
        says = summed.argmax(axis=1)
        out[d, n] = np.array([[[rows[says == p, c].sum() for p in (0, 1)] for c in (0, 1)] for rows in (cells.test, cells.train)])
    return out


def score(counts: np.ndarray, metric: str) -> float:
    """A metric of class x prediction counts, as in ``metrics`` (weighted by support)."""
    support, predicted, right = counts.sum(axis=1), counts.sum(axis=0), np.diagonal(counts)
    if metric == "accuracy":
        return float(right.sum() / support.sum())
    over = lambda x, y: np.divide(x, y, out=np.zeros(len(x)), where=y > 0)
    precision, recall = over(right, predicted), over(right, support)
    of = {"precision": precision, "recall": recall, "f1": over(2 * precision * recall, precision + recall)}[metric]
    return float((of * support).sum() / support.sum())
