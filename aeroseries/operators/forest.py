"""Random forests on binned columns (I5, I8): bootstrap rows, all columns at every split, least variance.

Spark's forest holds a histogram of every column for every node and sends it
from every partition; a deep tree has as many nodes as rows, and nearly all of
a fit goes into cells that stay empty.  Here a node of over ``GROUP`` rows is
split from histograms of all tasks, level by level.  The rows of a smaller one
meet in one group, which grows the rest of its tree; the test rows of a fold
go with them, so a fold's error needs no trees on the driver.  All trees share
the jobs, ``SHUFFLED`` bytes of rows at a time.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroseries.operators.boosting import ALL_BLOCKS, BinnedTable, BoostedModel, Tree, _stored, descend
from aeroseries.session import drop_tables

# Tasks get this module's functions by value and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a node that one group may hold.
GROUP = 1 << 17
#: Bytes of rows that one shuffle may hold.
SHUFFLED = 1 << 30
#: Spark's default: at most 31 cuts a column (and the byte of missing values).
BINS = 33
LEAST_GAIN = 1e-9
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


@dataclass(frozen=True)
class Forest:
    """One fit, named as in Spark: rows of block <= ``upto`` train, those of the next block test it."""
    numTrees: int = 20
    maxDepth: int = 5
    minInstancesPerNode: int = 1
    bootstrap: bool = True
    seed: int = 42
    upto: int = ALL_BLOCKS


def cut_values(values: np.ndarray, counts: np.ndarray, most: int = BINS - 2) -> list[float]:
    """Where Spark's forest cuts a column of these different values in order: between any two if they are few, else
    where their running count passes the next of ``most`` + 1 equal shares."""
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) <= most:
        return middle.tolist()
    out, total = [], np.cumsum(counts)
    stride = total[-1] / (most + 1)
    target = stride
    for i in range(1, len(values)):
        if abs(total[i - 1] - target) < abs(total[i] - target):
            out.append(float(middle[i - 1]))
            target += stride
    return out[:most]


def forest_edges(df: DataFrame, features: Sequence[str], most: int = BINS - 2) -> list[list[float]]:
    """``cut_values`` of every column: of all its values where they are few, else of 255 quantiles."""
    features = list(dict.fromkeys(features))
    probs = F.array(*[F.lit(i / 256) for i in range(1, 256)])
    columns = [F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)]
    rows = df.select(*columns)
    row = rows.agg(*[F.percentile_approx(c, probs, 10_000).alias(c) for c in rows.columns]).first()

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0)] * len(features)
        for batch in batches:
            for i, own in enumerate(held):
                if own.size <= most + 1:
                    x = batch.column(i).fill_null(math.nan).to_numpy(zero_copy_only=False)
                    held[i] = np.union1d(own, x[~np.isnan(x)])[:most + 2]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(held)), [v.size for v in held]), pa.int32()), pa.array(np.concatenate(held), pa.float64())], ["column", "value"])

    found = rows.mapInArrow(few, "column int, value double").groupBy("column").agg(F.slice(F.array_sort(F.collect_set("value")), 1, most + 2).alias("own"))
    whole = {r["column"]: r["own"] for r in found.collect() if len(r["own"]) <= most + 1}
    return [cut_values(*np.unique(whole.get(i, q or []), return_counts=True), most) for i, q in enumerate(row)]


def drawn(h: np.ndarray, f: Forest, tree: int) -> np.ndarray:
    """How often a tree's sample holds each row, about Poisson(1): the same on every attempt of a task."""
    if not f.bootstrap:
        return np.ones(h.size, np.uint8)
    x = h.view(np.uint64) + np.arange(h.size, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    x ^= np.uint64((f.seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return np.searchsorted(_POISSON, (x >> np.uint64(11)).astype(float) * 2.0 ** -53, "right").astype(np.uint8)


def best_cuts(n: np.ndarray, s: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Gain and cut of each node's best split of one column, from its rows and label sums by bin."""
    nl, sl = np.cumsum(n, 1), np.cumsum(s, 1)
    rows, total = nl[:, -1:], sl[:, -1:]
    nl, sl = nl[:, :-1], sl[:, :-1]
    nr = rows - nl
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = sl * sl / nl + (total - sl) ** 2 / nr
    gain[(nl < least) | (nr < least)] = -np.inf
    at = gain.argmax(1)
    return gain[np.arange(len(n)), at] - (total * total / rows)[:, 0], at


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, least: float, bins: int) -> list[np.ndarray]:
    """Column (-1: leaf), cut, left child (the right one is next), value and gain of every node, level by level."""
    levels, first = [], 0
    least = max(least, 1)
    node, k, wy, wyy = np.zeros(len(y), np.int64), 1, w * y, w * y * y
    while k:
        n, s, q = (np.bincount(node, v, k) for v in (w, wy, wyy))
        column, cut, left, gain = np.full(k, -1, np.int16), np.zeros(k, np.uint8), np.zeros(k, np.int32), np.zeros(k)
        worth = s * s / n
        able = np.flatnonzero((n >= 2 * least) & (q - worth > LEAST_GAIN)) if depth else np.empty(0, int)
        if able.size:
            slot = np.full(k, -1)
            slot[able] = np.arange(able.size)
            here = np.flatnonzero(slot[node] >= 0)
            x, w, wy, wyy, node = x[here], w[here], wy[here], wyy[here], slot[node[here]]
            found, size, base = np.full(able.size, LEAST_GAIN), able.size * bins, node * bins
            for c in range(x.shape[1]):
                cell = base + x[:, c]
                g, at = best_cuts(np.bincount(cell, w, size).reshape(-1, bins), np.bincount(cell, wy, size).reshape(-1, bins), least)
                better = np.flatnonzero(g > found)
                found[better], column[able[better]], cut[able[better]] = g[better], c, at[better]
        inner = np.flatnonzero(column >= 0)
        left[inner] = first + k + 2 * np.arange(inner.size)
        if inner.size:
            gain[able] = found
            gain[column < 0] = 0
            child = np.full(k, -1)
            child[inner] = 2 * np.arange(inner.size)
            old = able[node]
            keep = np.flatnonzero(child[old] >= 0)
            x, w, wy, wyy, old = x[keep], w[keep], wy[keep], wyy[keep], old[keep]
            node = child[old] + (x[np.arange(keep.size), column[old]] > cut[old])
        levels.append((column, cut, left, s / n, gain))
        first, k, depth = first + k, 2 * inner.size, depth - 1
    return [np.concatenate(v) for v in zip(*levels)]


class _Top:
    """A tree's nodes of over ``GROUP`` rows, on the driver: ``open`` ones wait for their split, ``small`` ones for their group."""

    def __init__(self, rows: int):
        self.column, self.cut, self.left, self.value, self.gain, self.depth = [-1], [0], [0], [0.0], [0.0], [0]
        self.open, self.small = ([0], []) if rows > GROUP else ([], [0])

    def arrays(self) -> tuple:
        left = np.array(self.left)
        return np.array(self.column), np.array(self.cut), left, left + 1, np.array(self.value)

    def split(self, node: int, column: int, cut: int, gain: float, value: float, sides: Sequence[float], f: Forest) -> None:
        self.value[node] = value
        if gain <= LEAST_GAIN or self.depth[node] >= f.maxDepth:
            return
        self.column[node], self.cut[node], self.left[node], self.gain[node] = column, cut, len(self.column), gain
        for rows in sides:
            (self.open if rows > GROUP else self.small).append(len(self.column))
            for own, v in ((self.column, -1), (self.cut, 0), (self.left, 0), (self.value, 0.0), (self.gain, 0.0), (self.depth, self.depth[node] + 1)):
                own.append(v)


def _split_tops(data: BinnedTable, f: Forest, tops: dict[int, _Top], bins: int) -> None:
    """Split all large nodes, a level at a time."""
    while any(t.open for t in tops.values()):
        orders = {t: (top.arrays(), top.open) for t, top in tops.items() if top.open}

        def sums(blocks: Iterator[tuple]) -> Iterator[tuple]:
            held: dict = {}
            for _, x, ys, block, h, _ in blocks:
                for t, (tree, nodes) in orders.items():
                    w = drawn(h, f, t)
                    use = np.flatnonzero((w > 0) & (block <= f.upto))
                    slot = np.full(len(tree[0]), -1)
                    slot[nodes] = np.arange(len(nodes))
                    node = slot[descend(tree, x[use])]
                    use, node = use[node >= 0], node[node >= 0] * bins
                    own, wy, size = w[use].astype(float), w[use] * ys[use, 0], len(nodes) * bins
                    for c in range(x.shape[1]):
                        cell = node + x[use, c]
                        held[t, c] = held.get((t, c), 0) + np.stack([np.bincount(cell, own, size), np.bincount(cell, wy, size)]).reshape(2, -1, bins)
            for (t, c), both in held.items():
                for i, node in enumerate(orders[t][1]):
                    yield (t, node, c), both[:, i].copy()

        def cut(item: tuple) -> tuple:
            (t, node, c), (n, s) = item
            g, at = best_cuts(n[None], s[None], max(f.minInstancesPerNode, 1))
            left = float(n[:at[0] + 1].sum())
            return (t, node), (float(g[0]), -c, int(at[0]), float(s.sum() / n.sum()), left, float(n.sum()) - left)

        best = data.rows.mapPartitions(sums).reduceByKey(lambda a, b: a + b).map(cut).reduceByKey(max).collect()
        for top in tops.values():
            top.open = []
        for (t, node), (g, c, at, value, *sides) in sorted(best):
            tops[t].split(node, -c, at, g, value, sides, f)


def _groups(data: BinnedTable, f: Forest, tops: dict[int, _Top], bins: int, few: bool) -> RDD:
    """(tree, its small node, the subtree under it, its test rows by block of the table and their predictions)."""
    trees = {t: top.arrays() for t, top in tops.items()}
    depths = {(t, node): top.depth[node] for t, top in tops.items() for node in top.small}
    small = {key: i for i, key in enumerate(depths)}

    def deal(index: int, blocks: Iterator[tuple]) -> Iterator[tuple]:
        for j, (_, x, ys, block, h, _) in enumerate(blocks):
            known, tested = block <= f.upto, block == f.upto + 1
            if np.isnan(ys[known | tested, 0]).any() or (x[known | tested] == 0).any():
                raise ValueError("a forest takes no null or NaN in its features or label")
            for t, tree in trees.items():
                w = drawn(h, f, t)
                use = np.flatnonzero(known & ((w > 0) | few) | tested)
                node = descend(tree, x[use])
                for at in np.unique(node).tolist():
                    own = use[node == at]
                    train, test = own[known[own]], own[tested[own]].astype(np.int32)
                    if (t, at) in depths:
                        yield (t, at), (index, j, x[train], ys[train, 0], w[train], x[test], test, None)
                    elif test.size:  # a large leaf: nothing is left to grow
                        yield (t, at), (index, j, None, None, None, None, test, tree[4][at])

    def finish(item: tuple) -> tuple:
        (t, at), parts = item
        if (t, at) not in depths:
            return t, at, None, [(p[0], p[1], p[6], np.full(p[6].size, p[7])) for p in parts]
        parts = sorted(parts, key=lambda p: p[:2])
        x, y, w = (np.concatenate([p[i] for p in parts]) for i in (2, 3, 4))
        if not w.any():  # a sample of no rows, out of a few
            w = np.ones(w.size, np.uint8)
        own = grow(x[w > 0], y[w > 0], w[w > 0].astype(float), f.maxDepth - depths[t, at], f.minInstancesPerNode, bins)
        tree = own[0], own[1], own[2], own[2] + 1, own[3]
        return t, at, own, [(p[0], p[1], p[6], own[3][descend(tree, p[5])]) for p in parts if p[6].size]

    some = min(max(len(small), 1), 8 * data.rows.context.defaultParallelism)
    return data.rows.mapPartitionsWithIndex(deal).groupByKey(some, lambda key: small.get(key, sum(key))).map(finish)


def _rounds(data: BinnedTable, f: Forest) -> Iterator[tuple[dict[int, _Top], RDD]]:
    """Trees whose rows fit into one shuffle: their tops and their groups."""
    bins = max([3, *(len(e) + 2 for e in data.edges)])
    n, tested = data.rows.map(lambda own: (int((own[3] <= f.upto).sum()), int((own[3] == f.upto + 1).sum()))).fold((0, 0), lambda a, b: (a[0] + b[0], a[1] + b[1]))
    if not n:
        raise ValueError("a forest needs training rows")
    some = max(1, int(SHUFFLED / ((n * (0.64 if f.bootstrap else 1) + tested) * (len(data.features) + 13))))
    for first in range(0, f.numTrees, some):
        tops = {t: _Top(n) for t in range(first, min(first + some, f.numTrees))}
        _split_tops(data, f, tops, bins)
        yield tops, _groups(data, f, tops, bins, n < 64)


def forest_error(data: BinnedTable, f: Forest) -> float | None:
    """Mean absolute error of a forest on the rows of the block after ``upto`` (None: it has none)."""
    paths, sums = [], data.rows.mapPartitionsWithIndex(lambda i, blocks: (((i, j), (-1, np.flatnonzero(own[3] == f.upto + 1), own[2][own[3] == f.upto + 1, 0])) for j, own in enumerate(blocks)))

    def added(item: tuple) -> tuple:
        """A block's test rows meet, their trees added up in order."""
        parts = sorted(item[1], key=lambda p: p[:2])
        total = np.zeros(max(int(p[2].max()) for p in parts) + 1)
        for _, _, at, v in parts:
            total[at] += v
        return item[0], (parts[0][0], None, total)

    def error(parts: Sequence[tuple]) -> tuple[float, int]:
        (_, at, y), *totals = sorted(parts, key=lambda p: p[0])
        return (float(np.abs(sum(v[at] for _, _, v in totals) / f.numTrees - y).sum()) if at.size else 0.0), at.size

    for _, groups in _rounds(data, f):
        predicted = groups.flatMap(lambda g: [((p, j), (g[0], g[1], at, v)) for p, j, at, v in g[3]])
        stored, path = _stored(data.spark, predicted.groupByKey(groups.getNumPartitions()).map(added), "predicted")
        sums, paths = sums.union(stored), [*paths, path]
    found = sorted(sums.groupByKey(data.rows.getNumPartitions()).mapValues(error).collect())
    drop_tables(data.spark, *paths)
    rows = sum(n for _, (_, n) in found)
    return sum(e for _, (e, _) in found) / rows if rows else None


def fit_forest(data: BinnedTable, f: Forest) -> BoostedModel:
    """The forest as a model of ``boosting``: a sum of trees whose values are shares of the mean."""
    trees = []
    for tops, groups in _rounds(data, f):
        own: dict[int, list] = {t: [] for t in tops}
        for t, at, grown, _ in groups.collect():
            own[t].append((at, grown))
        trees += [_joined(top, sorted(own[t], key=lambda v: v[0]), f.numTrees) for t, top in tops.items()]
    return BoostedModel(data.features, data.edges, 0.0, trees)


def _joined(top: _Top, subtrees: Sequence[tuple], share: int) -> Tree:
    """A top and its subtrees as one tree; a subtree's root takes the place of its node."""
    column, cut, left, gain = (list(v) for v in (top.column, top.cut, top.left, top.gain))
    value = [v / share for v in top.value]
    for at, (c, k, child, v, g) in subtrees:
        for own, new in ((left, child + (len(column) - 1) * (c >= 0)), (column, c), (cut, k), (value, v / share), (gain, g)):
            own[at] = new[0].item()
            own.extend(new[1:].tolist())
    return Tree(column, cut, left, [x + 1 for x in left], value, gain)
