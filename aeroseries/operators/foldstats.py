"""Linear and ridge fits of all expanding folds from one pass (I8).

A block's sufficient statistics are the products of its columns, the label and
a constant; a fold's are those of its blocks added up, so every fold and every
penalty comes from one aggregate of one matrix a block, whatever the number of
rows.  A second pass scores all of them at once.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tasks get this module's functions by value and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _matrix(batch: pa.RecordBatch, shift: np.ndarray) -> np.ndarray:
    """Columns and label of a batch around ``shift``; the block stands last."""
    return np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns - 1)], 1) - shift


def block_products(rows: DataFrame, shift: np.ndarray) -> dict[int, np.ndarray]:
    """For each block the products of (1, columns, label); ``rows`` are (columns, label, block)."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            block = batch.column(batch.num_columns - 1).to_numpy()
            x = np.hstack([np.ones((batch.num_rows, 1)), _matrix(batch, shift)])
            for b in np.unique(block):
                own = x[block == b]
                held[int(b)] = held.get(int(b), 0) + own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([m.tobytes() for m in held.values()], pa.binary())], ["block", "products"])

    def total(table: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(p.as_py(), float) for p in table.column("products"))
        return pa.table({"block": table.column("block").slice(0, 1), "products": pa.array([whole.tobytes()], pa.binary())})

    sums = rows.mapInArrow(add, "block int, products binary").groupBy("block").applyInArrow(total, "block int, products binary")
    size = len(shift) + 1
    return {r["block"]: np.frombuffer(r["products"], float).reshape(size, size) for r in sums.collect()}


def solve(products: np.ndarray, alpha: float) -> np.ndarray:
    """(intercept, coefficients) with penalty ``alpha`` on the coefficients; least norm where columns depend on each other."""
    n = products[0, 0]
    mean = products[0, 1:] / n
    around = products[1:, 1:] - n * np.outer(mean, mean)
    coefficients = np.linalg.lstsq(around[:-1, :-1] + alpha * np.eye(len(mean) - 1), around[:-1, -1], rcond=1e-10)[0]
    return np.concatenate([[mean[-1] - coefficients @ mean[:-1]], coefficients])


def linear_folds(blocks: DataFrame, features: Sequence[str], label: str, alphas: dict[str, float], n_splits: int = 5, block: str = "block") -> list[tuple]:
    """(spec, fold, MAE) of every penalty on the expanding folds of ``splits.fold_blocks``.

    Rows without one of the columns or the label are left out; a fold without
    training or test rows has a null MAE.
    """
    rows = blocks.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate([*features, label])], F.col(block).cast("int").alias("block")).na.drop()
    means = rows.agg(*[F.avg(c) for c in rows.columns[:-1]]).first()
    if means[0] is None:
        return [(s, f, None) for s in alphas for f in range(n_splits)]
    shift = np.array(means, float)
    products = block_products(rows, shift)
    fits = {}
    for f in range(n_splits):
        own = [m for b, m in products.items() if b <= f]
        if own:
            fits[f] = np.stack([solve(sum(own), a) for a in alphas.values()], 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {f: np.zeros(len(alphas)) for f in fits}
        count = dict.fromkeys(fits, 0)
        for batch in batches:
            where, x = batch.column(batch.num_columns - 1).to_numpy(), _matrix(batch, shift)
            for f, w in fits.items():
                own = x[where == f + 1]
                held[f] += np.abs(own[:, -1:] - (w[0] + own[:, :-1] @ w[1:])).sum(0)
                count[f] += len(own)
        out = [(f, i, float(v), count[f]) for f in fits for i, v in enumerate(held[f])]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.float64(), pa.int64()))], ["fold", "spec", "error", "n"])

    errors = rows.mapInArrow(score, "fold int, spec int, error double, n long").groupBy("fold", "spec").agg(F.sum("error").alias("e"), F.sum("n").alias("n")).collect()
    mae = {(r["spec"], r["fold"]): r["e"] / r["n"] if r["n"] else None for r in errors}
    return [(s, f, mae.get((i, f))) for i, s in enumerate(alphas) for f in range(n_splits)]
