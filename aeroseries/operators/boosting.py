"""Boosted regression trees on binned columns.

Squared loss, row sampling per round, column sampling per tree and per level,
L1 and L2 penalties of leaf values, least gain of a split, least rows of a
leaf, and early stopping by patience.

The feature columns are binned once (quantile edges from one aggregate) and
written to the shared folder in blocks of rows, one byte a value, with all
labels beside them.  A fit takes thousands of short jobs: they read the blocks
as an RDD, whose jobs have no query to plan.
A tree grows level by level.  Each level is one Spark job: tasks sum gradients
and rows by node, column and bin; the sums of one column meet in one group,
which finds the best split of every node; the driver gets one line for each
column, whatever the number of rows.  Several fits (labels, folds, settings)
advance in the same jobs, so five labels cost the scans of one.

A round's first job also has the validation error of the trees so far.  A fit
therefore ends ``patience`` rounds after its best one, and nothing is fitted
twice; settings that differ only in the number of rounds are prefixes of one
fit.  Every ``SAVE_EVERY`` rounds the rows are written again with their
predictions so far: a task never replays more trees than that, and a lost
executor costs its own tasks only.
"""

from __future__ import annotations

import json
import math
import pickle
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroseries.session import drop_tables, ensure_checkpoint_dir

# Tasks get this module's functions by value and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 64
SAVE_EVERY = 5
LEAST_GAIN = 1e-6
#: Sums of all tasks up to this size may meet in the driver.
DRIVER_BYTES = 16 << 20
ALL_BLOCKS = 1 << 30


@dataclass(frozen=True)
class Settings:
    rounds: int = 100
    rate: float = 0.3
    depth: int = 6
    min_child: float = 1.0
    rows: float = 1.0
    columns: float = 1.0
    level_columns: float = 1.0
    min_gain: float = 0.0
    l1: float = 0.0
    l2: float = 1.0
    seed: int = 42
    base: float | None = None  # None: mean of the training labels


@dataclass(frozen=True)
class Task:
    """One fit: rows of block <= ``upto`` train, those of the next block validate."""
    label: int
    settings: Settings
    upto: int = ALL_BLOCKS


@dataclass
class Tree:
    """Nodes in order of creation; ``column`` is -1 at a leaf."""
    column: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [0])
    right: list = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])
    gain: list = field(default_factory=lambda: [0.0])

    def arrays(self) -> tuple:
        return np.array(self.column), np.array(self.cut), np.array(self.left), np.array(self.right), np.array(self.value)


def descend(arrays: tuple, bins: np.ndarray) -> np.ndarray:
    """The node that each row ends in."""
    column, cut, left, right, _ = arrays
    node = np.zeros(len(bins), np.int64)
    while True:
        f = column[node]
        inner = np.flatnonzero(f >= 0)
        if not inner.size:
            return node
        at = node[inner]
        node[inner] = np.where(bins[inner, f[inner]] <= cut[at], left[at], right[at])


def binned(columns: Sequence[np.ndarray], edges: Sequence[Sequence[float]]) -> np.ndarray:
    """One byte a value: 0 for a missing one, else one more than the edges below it."""
    out = np.empty((len(columns[0]) if columns else 0, len(columns)), np.uint8)
    for j, (x, e) in enumerate(zip(columns, edges)):
        out[:, j] = np.where(np.isnan(x), 0, np.searchsorted(np.asarray(e, float), x, "left") + 1)
    return out


def _stored(spark: SparkSession, blocks: RDD, name: str) -> tuple[RDD, str]:
    """``blocks`` written in the shared folder and read again, and their path."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    blocks.saveAsPickleFile(path, 1)
    return blocks.context.pickleFile(path, 1), path


@dataclass(frozen=True)
class BinnedTable:
    """Blocks of rows: the part of the table they are from, then arrays of bins, labels (NaN: missing),
    block, a hash for sampling and, of a fit under way, its predictions so far (else None)."""
    spark: SparkSession
    rows: RDD
    path: str
    edges: tuple
    features: tuple
    labels: tuple


def quantile_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """At most ``bins`` - 2 cut values a column, from one aggregate."""
    probs = F.array(*[F.lit(i / (bins - 1)) for i in range(1, bins - 1)])
    row = df.agg(*[F.percentile_approx(F.col(f).cast("double"), probs, 10_000).alias(f"q{i}") for i, f in enumerate(features)]).first()
    return [sorted(set(q or [])) for q in row]


def bin_table(df: DataFrame, features: Sequence[str], labels: Sequence[str], keys: Sequence[str] = ("site_id", "date"), block: str | None = None, bins: int = BINS,
              edges: Sequence[Sequence[float]] | None = None) -> BinnedTable:
    """Bin ``features`` once for any number of fits, by ``edges`` of these columns or their quantiles; rows are sampled by a hash of ``keys``."""
    if not 2 < bins <= 256:
        raise ValueError("bins are bytes")
    features, labels = list(dict.fromkeys(features)), list(labels)
    edges = quantile_edges(df, features, bins) if edges is None else edges
    nf, nl = len(features), len(labels)
    rows = df.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], *[F.col(y).cast("double").alias(f"y{i}") for i, y in enumerate(labels)],
                     (F.col(block).cast("int") if block else F.lit(0)).alias("block"), F.xxhash64(*keys).alias("h"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = [batch.column(i).fill_null(math.nan).to_numpy(zero_copy_only=False) for i in range(nf + nl)]
                y = np.stack(columns[nf:], 1) if nl else np.zeros((batch.num_rows, 0))
                held = binned(columns[:nf], edges), y, batch.column(nf + nl).to_numpy(), batch.column(nf + nl + 1).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(held)], pa.binary())], ["rows"])

    packed = rows.mapInArrow(pack, "rows binary").rdd.mapPartitionsWithIndex(lambda i, own: ((i, *pickle.loads(r[0]), None) for r in own))
    blocks, path = _stored(df.sparkSession, packed, "binned")
    return BinnedTable(df.sparkSession, blocks, path, tuple(map(tuple, edges)), tuple(features), tuple(labels))


def kept_rows(h: np.ndarray, seed: int, n: int, share: float) -> np.ndarray:
    """Which rows a round samples: the same on every attempt of a task."""
    if share >= 1:
        return np.ones(h.size, bool)
    x = h.view(np.uint64) ^ np.uint64((seed * 1_000_003 + n) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x >> np.uint64(11)).astype(float) * 2.0 ** -53 < share


def shrunk(g, l1: float):
    """Soft threshold of a gradient sum."""
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def best_splits(g: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    """Per node the best cut of one column from its sums by bin: (gain, cut, left sum, left rows)."""
    gl, nl = np.cumsum(g, 1)[:, :-1], np.cumsum(n, 1)[:, :-1]
    total, rows = g.sum(1, keepdims=True), n.sum(1, keepdims=True)
    worth = lambda a, b: shrunk(a, s.l1) ** 2 / np.maximum(b + s.l2, 1e-12)
    gain = worth(gl, nl) + worth(total - gl, rows - nl) - worth(total, rows)
    least = max(s.min_child, 1e-12)
    gain[(nl < least) | (rows - nl < least)] = -np.inf
    at = gain.argmax(1)
    pick = np.arange(len(g)), at
    return np.stack([gain[pick], at, gl[pick], nl[pick]], 1)


class _Fit:
    """A fit's state on the driver: done trees, the open tree and its nodes of this level."""

    def __init__(self, task: Task, base: float, columns: int, patience: int | None):
        self.task, self.base, self.columns, self.patience = task, base, columns, patience
        self.trees, self.errors, self.saved, self.over = [], [], 0, False
        self.tree, self.level, self.nodes = None, 0, []

    def begin(self) -> None:
        s, n = self.task.settings, len(self.trees)
        self.tree, self.level, self.nodes, self.sums = Tree(), 0, [0], {}
        rng = np.random.default_rng([s.seed, n])
        self.own = np.sort(rng.permutation(self.columns)[:max(1, round(s.columns * self.columns))]) if self.columns else np.zeros(0, np.int64)

    def picked(self) -> np.ndarray:
        """The columns tried at this level."""
        s = self.task.settings
        if s.level_columns >= 1 or not self.own.size:
            return self.own
        rng = np.random.default_rng([s.seed, len(self.trees), self.level + 1])
        return np.sort(rng.permutation(self.own)[:max(1, round(s.level_columns * self.own.size))])

    def order(self) -> dict:
        """What tasks need for this level."""
        s = self.task.settings
        grow = self.level < s.depth and len(self.trees) < s.rounds
        return {"label": self.task.label, "upto": self.task.upto, "s": s, "base": self.base, "pending": [t.arrays() for t in self.trees[self.saved:]], "tree": self.tree.arrays(),
                "nodes": np.array(self.nodes, np.int64), "columns": self.picked() if grow else np.zeros(0, np.int64), "round": len(self.trees), "first": self.level == 0}

    def leaf(self, node: int) -> None:
        s = self.task.settings
        g, n = self.sums[node]
        self.tree.value[node] = float(-shrunk(g, s.l1) / max(n + s.l2, 1e-12) * s.rate)

    def step(self, totals: np.ndarray | None, found: dict[int, np.ndarray]) -> None:
        """Split this level's nodes; the tree is done when none is left."""
        s, t = self.task.settings, self.tree
        if self.level == 0 and totals is not None:
            self.sums[0] = tuple(totals)
        ready = []
        for i, node in enumerate(self.nodes):
            gain, column = max(((float(x[i][0]), -c) for c, x in found.items()), default=(-math.inf, 0))
            if not gain > max(s.min_gain, LEAST_GAIN):
                self.leaf(node)
                continue
            _, cut, gl, nl = found[-column][i]
            g, n = self.sums[node]
            a = len(t.column)
            t.column[node], t.cut[node], t.left[node], t.right[node], t.gain[node] = -column, int(cut), a, a + 1, gain
            for sums in ((gl, nl), (g - gl, n - nl)):
                for x, v in ((t.column, -1), (t.cut, 0), (t.left, 0), (t.right, 0), (t.value, 0.0), (t.gain, 0.0)):
                    x.append(v)
                self.sums[len(t.column) - 1] = (float(sums[0]), float(sums[1]))
            ready += [a, a + 1]
        self.level += 1
        if ready and self.level >= s.depth:
            for node in ready:
                self.leaf(node)
            ready = []
        self.nodes = ready
        if not ready:
            self.trees.append(t)
            self.tree = None

    def judged(self, sse: float, sae: float, n: float) -> None:
        """Note the validation error of the trees so far; stop when out of patience or rounds."""
        if self.trees and n:
            self.errors.append((float(sse / n), float(sae / n)))
        if len(self.trees) >= self.task.settings.rounds:
            self.over = True
        if self.patience and self.errors:
            mse = [e[0] for e in self.errors]
            self.over |= len(mse) - 1 - int(np.argmin(mse)) >= self.patience


def _margins(margin: np.ndarray | None, orders: Sequence[dict], bins: np.ndarray) -> np.ndarray:
    out = margin.copy() if margin is not None else np.tile([o["base"] for o in orders], (len(bins), 1))
    for m, o in enumerate(orders):
        for arrays in o["pending"]:
            out[:, m] += arrays[4][descend(arrays, bins)]
    return out


def _level(rows: RDD, tasks: int, orders: dict[int, dict], every: Sequence[dict], columns: int, bins: int) -> list[tuple]:
    """One level of several fits: (fit, column, best splits); column -1 has totals and errors.

    The tasks' sums meet by column in one more stage.  Where all of them
    together have a bounded size, that stage is left out and the driver adds
    them up.  Either adds them in the order of the tasks' parts.
    """
    def sums(index: int, blocks: Iterator[tuple]) -> Iterator[tuple]:
        hist = {m: (np.zeros((len(o["nodes"]), len(o["columns"]), bins)), np.zeros((len(o["nodes"]), len(o["columns"]), bins))) for m, o in orders.items()}
        whole = {m: np.zeros(5) for m in orders}
        part = -1
        for part, x, y, block, h, saved in blocks:
            margin = _margins(saved, every, x)
            for m, o in orders.items():
                error = margin[:, m] - y[:, o["label"]]
                known, s = ~np.isnan(error), o["s"]
                if o["first"]:
                    valid = error[known & (block == o["upto"] + 1)]
                    whole[m][2:] += (valid ** 2).sum(), np.abs(valid).sum(), valid.size
                use = np.flatnonzero(known & (block <= o["upto"]) & kept_rows(h, s.seed, o["round"], s.rows))
                g = error[use]
                if o["first"]:
                    whole[m][:2] += g.sum(), g.size
                if not len(o["columns"]):
                    continue
                slot = np.full(len(o["tree"][0]), -1)
                slot[o["nodes"]] = np.arange(len(o["nodes"]))
                node = slot[descend(o["tree"], x[use])]
                here = node >= 0
                node, g, own = node[here] * bins, g[here], x[use[here]]
                size = len(o["nodes"]) * bins
                for j, c in enumerate(o["columns"]):
                    cell = node + own[:, c]
                    hist[m][0][:, j] += np.bincount(cell, g, size).reshape(-1, bins)
                    hist[m][1][:, j] += np.bincount(cell, minlength=size).reshape(-1, bins)
        # The fit and the column as one number.
        for m, w in whole.items():
            yield m * (columns + 1), (part, index, w, None)
        for m, o in orders.items():
            for j, c in enumerate(o["columns"]):
                yield m * (columns + 1) + int(c) + 1, (part, index, hist[m][0][:, j].copy(), hist[m][1][:, j].copy())

    def best(found: tuple[int, Sequence[tuple]]) -> tuple:
        m, c = divmod(found[0], columns + 1)
        parts = sorted(found[1], key=lambda p: p[:2])
        total = sum(p[2] for p in parts)
        return m, c - 1, best_splits(total, sum(p[3] for p in parts), orders[m]["s"]) if c else total

    partial = rows.mapPartitionsWithIndex(sums)
    keys = sum(1 + len(o["columns"]) for o in orders.values())
    if tasks * sum(len(o["nodes"]) * len(o["columns"]) for o in orders.values()) * bins * 16 > DRIVER_BYTES:
        return partial.groupByKey(min(keys, rows.context.defaultParallelism), lambda key: key).map(best).collect()
    parts: dict[int, list] = {}
    for key, own in partial.collect():
        parts.setdefault(key, []).append(own)
    return [best(found) for found in parts.items()]


def _with_margins(spark: SparkSession, rows: RDD, orders: Sequence[dict]) -> tuple[RDD, str]:
    return _stored(spark, rows.map(lambda own: (*own[:5], _margins(own[5], orders, own[1]))), "margins")


def boost(data: BinnedTable, tasks: Sequence[Task], patience: int | None = None) -> list[BoostedModel]:
    """All ``tasks`` in the same jobs; with ``patience`` each ends, and is cut, by its validation error."""
    columns = len(data.features)
    bins = max([3, *(len(e) + 2 for e in data.edges)])
    rows, path, parts = data.rows, None, data.rows.getNumPartitions()

    bases = _means(data, tasks)
    fits = [_Fit(t, bases[i], columns, patience) for i, t in enumerate(tasks)]
    while not all(f.over for f in fits):
        for f in fits:
            if not f.over and f.tree is None:
                f.begin()
        # At the start of a round all open fits judge what they have; later levels concern those whose tree is open.
        while any(f.tree is not None for f in fits):
            every = [{"base": f.base, "pending": [t.arrays() for t in f.trees[f.saved:]]} for f in fits]
            orders = {m: f.order() for m, f in enumerate(fits) if f.tree is not None}
            got: dict[int, dict] = {m: {} for m in orders}
            for m, c, best in _level(rows, parts, orders, every, columns, bins):
                got[m][c] = best
            for m, found in got.items():
                f, whole = fits[m], found.pop(-1, np.zeros(5))
                if f.level == 0:
                    f.judged(*whole[2:])
                    if f.over:
                        f.tree = None
                        continue
                f.step(whole[:2] if f.level == 0 else None, found)
        if max(len(f.trees) - f.saved for f in fits) >= SAVE_EVERY and not all(f.over for f in fits):
            old = path
            rows, path = _with_margins(data.spark, rows, [{"base": f.base, "pending": [t.arrays() for t in f.trees[f.saved:]]} for f in fits])
            parts = rows.getNumPartitions()
            for f in fits:
                f.saved = len(f.trees)
            if old:
                drop_tables(data.spark, old)
    if path:
        drop_tables(data.spark, path)
    return [BoostedModel(data.features, data.edges, f.base, _cut(f), tuple(f.errors), t) for f, t in zip(fits, tasks)]


def _cut(f: _Fit) -> list[Tree]:
    if f.patience and f.errors:
        return f.trees[:int(np.argmin([e[0] for e in f.errors])) + 1]
    return f.trees


def _means(data: BinnedTable, tasks: Sequence[Task]) -> list[float]:
    """Each task's starting value: given, or the mean label of its training rows."""
    if all(t.settings.base is not None for t in tasks):
        return [t.settings.base for t in tasks]
    def add(index: int, blocks: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[int, np.ndarray] = {}
        part = -1
        for part, _, y, block, _, _ in blocks:
            for b in np.unique(block):
                own = y[block == b]
                held[int(b)] = held.get(int(b), 0) + np.stack([np.nansum(own, 0), (~np.isnan(own)).sum(0)])
        yield part, index, held

    sums = sorted(data.rows.mapPartitionsWithIndex(add).collect(), key=lambda p: p[:2])
    out = []
    for t in tasks:
        own = [v[:, t.label] for _, _, held in sums for b, v in held.items() if b <= t.upto]
        total, n = sum(own) if own else (0.0, 0.0)
        out.append(t.settings.base if t.settings.base is not None else float(total / n) if n else 0.0)
    return out


class BoostedModel:
    """Trees over binned columns; ``transform`` adds ``prediction`` as a fitted pipeline does."""

    def __init__(self, features: Sequence[str], edges: Sequence[Sequence[float]], base: float, trees: Sequence[Tree], errors: tuple = (), task: Task | None = None):
        self.features, self.edges, self.base, self.trees, self.errors, self.task = list(features), [list(e) for e in edges], base, list(trees), errors, task

    def prefix(self, rounds: int) -> BoostedModel:
        return BoostedModel(self.features, self.edges, self.base, self.trees[:rounds], self.errors, self.task)

    def transform(self, df: DataFrame) -> DataFrame:
        edges, base, trees = self.edges, self.base, [t.arrays() for t in self.trees]
        used = sorted({int(c) for t in trees for c in t[0] if c >= 0})
        place = {c: i for i, c in enumerate(used)}
        trees = [(np.array([place.get(int(c), -1) for c in t[0]]), *t[1:]) for t in trees]

        def score(*columns: pd.Series) -> pd.Series:
            x = binned([c.to_numpy(dtype=float, na_value=math.nan) for c in columns[1:]], [edges[c] for c in used])
            out = np.full(len(columns[0]), base)
            for t in trees:
                out += t[4][descend(t, x)] if used else t[4][0]
            return pd.Series(out)

        # The first column only carries the number of rows.
        arguments = [F.lit(0), *[F.col(self.features[c]).cast("double") for c in used]]
        return df.withColumn("prediction", F.pandas_udf(score, "double")(*arguments))

    def importances(self) -> list[tuple[str, float]]:
        """Share of the total gain of each column."""
        gain = dict.fromkeys(self.features, 0.0)
        for t in self.trees:
            for c, g in zip(t.column, t.gain):
                if c >= 0:
                    gain[self.features[c]] += g
        total = sum(gain.values()) or 1.0
        return [(f, g / total) for f, g in gain.items()]

    def save(self, spark: SparkSession, path: str) -> None:
        """One row a node, and one row of settings."""
        nodes = [(n, i, *map(int, (t.column[i], t.cut[i], t.left[i], t.right[i])), float(t.value[i]), float(t.gain[i])) for n, t in enumerate(self.trees) for i in range(len(t.column))]
        spark.createDataFrame(nodes, "tree int, node int, col int, cut int, l int, r int, value double, gain double").coalesce(1).write.mode("overwrite").parquet(path + "/nodes")
        head = json.dumps({"features": self.features, "edges": self.edges, "base": self.base})
        spark.createDataFrame([(head,)], "head string").coalesce(1).write.mode("overwrite").parquet(path + "/head")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedModel:
        head = json.loads(spark.read.parquet(path + "/head").first()["head"])
        trees: dict[int, Tree] = {}
        for r in spark.read.parquet(path + "/nodes").orderBy("tree", "node").collect():
            t = trees.setdefault(r["tree"], Tree([], [], [], [], [], []))
            for x, v in zip((t.column, t.cut, t.left, t.right, t.value, t.gain), (r["col"], r["cut"], r["l"], r["r"], r["value"], r["gain"])):
                x.append(v)
        return BoostedModel(head["features"], head["edges"], head["base"], [trees[k] for k in sorted(trees)])
