"""Boosted trees and fold statistics against plain NumPy fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroseries.operators import boosting as B
from aeroseries.operators import foldstats as FS
from aeroseries.operators import models as ML


def data(n=600, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(2)
    y = np.where(x[:, 0] > 0.2, 3.0, 0.0) + x[:, 1] + 0.1 * rng.normal(size=n)
    z = -2.0 * x[:, 2] + 0.1 * rng.normal(size=n)
    return x, y, z


def frame(spark, x, y, z, n_blocks=6):
    rows = [(i, *map(float, r), float(a), None if i % 7 == 0 else float(b), i * n_blocks // len(x), i >= 0.8 * len(x)) for i, (r, a, b) in enumerate(zip(x, y, z))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double, z double, block int, is_validation boolean")


def plain(bins, y, s, rounds, base):
    """Level-wise boosting in memory: the predictions after each round."""
    out, seen = np.full(len(y), base), []
    for _ in range(rounds):
        g = out - y

        def grow(rows, depth):
            G, N = g[rows].sum(), len(rows)
            worth = lambda a, n: max(abs(a) - s.l1, 0) ** 2 / (n + s.l2)
            best = (max(s.min_gain, B.LEAST_GAIN), None)
            if depth < s.depth:
                for c in range(bins.shape[1]):
                    for cut in range(bins[:, c].max() + 1):
                        left = bins[rows, c] <= cut
                        n = left.sum()
                        if n < s.min_child or N - n < s.min_child or not 0 < n < N:
                            continue
                        gl = g[rows][left].sum()
                        gain = worth(gl, n) + worth(G - gl, N - n) - worth(G, N)
                        if gain > best[0] + 1e-9:
                            best = (gain, (c, cut))
            if best[1] is None:
                out[rows] -= np.sign(G) * max(abs(G) - s.l1, 0) / (N + s.l2) * s.rate
                return
            left = bins[rows, best[1][0]] <= best[1][1]
            grow(rows[left], depth + 1)
            grow(rows[~left], depth + 1)

        grow(np.arange(len(y)), 0)
        seen.append(out.copy())
    return seen


@pytest.mark.parametrize("driver_bytes", [0, 1 << 24])
def test_rounds_match_a_plain_fit(spark, monkeypatch, driver_bytes):
    # Margins are written again within the fit, too.
    monkeypatch.setattr(B, "SAVE_EVERY", 2)
    monkeypatch.setattr(B, "DRIVER_BYTES", driver_bytes)
    x, y, z = data()
    df = frame(spark, x, y, z)
    s = B.Settings(rounds=5, rate=0.4, depth=3, min_child=4, min_gain=0.05, l1=0.5, l2=1.5)
    binned = B.bin_table(df, ["a", "b", "c"], ["y", "z"], ["id"])
    m, k = B.boost(binned, [B.Task(0, s), B.Task(1, s)])
    bins = B.binned(list(x.T), m.edges)
    got = np.array([r["prediction"] for r in m.transform(df).orderBy("id").collect()])
    assert np.abs(got - plain(bins, y, s, 5, y.mean())[-1]).max() < 1e-9
    known = np.arange(len(y)) % 7 > 0
    got = np.array([r["prediction"] for r in k.transform(df).orderBy("id").collect()])[known]
    assert np.abs(got - plain(bins[known], z[known], s, 5, z[known].mean())[-1]).max() < 1e-9
    alone = B.boost(binned, [B.Task(1, s)])[0]
    assert [t.column for t in alone.trees] == [t.column for t in k.trees]
    assert np.allclose(np.concatenate([t.value for t in alone.trees]), np.concatenate([t.value for t in k.trees]))
    assert dict(k.importances())["c"] > 0.9


def test_stops_at_the_best_round(spark):
    x, y, z = data(300)
    rng = np.random.default_rng(0)
    df = frame(spark, x, y + 3 * rng.normal(size=300), z)
    m = ML.fit_boosted(df, ["a", "b", "c"], "y", patience=4, keys=["id"], rounds=60, rate=0.5, depth=4)
    mse = [e[0] for e in m.errors]
    assert len(m.trees) == ML.best_round(mse, 4) == int(np.argmin(mse)) + 1 < len(mse) <= len(m.trees) + 4
    valid = m.transform(df.where("is_validation")).agg(F.avg(F.pow(F.col("y") - F.col("prediction"), 2))).first()[0]
    assert abs(valid - min(mse)) < 1e-9


def test_sampling_is_by_share_and_repeats(spark):
    h = np.arange(200_000) * 7919
    one = B.kept_rows(h, 42, 3, 0.8)
    assert abs(one.mean() - 0.8) < 0.01 and (one == B.kept_rows(h, 42, 3, 0.8)).all() and (one != B.kept_rows(h, 42, 4, 0.8)).any()
    x, y, z = data(200)
    df = frame(spark, x, y, z)
    fit = lambda: ML.train_all_types(df, ["a", "b", "c"], ["y"], "baseline", None, None, ["id"], rounds=3)["y"]
    assert fit().trees == fit().trees


def test_search_scores_prefixes_of_shared_fits(spark):
    x, y, z = data(240)
    df = frame(spark, x, y, z)
    grid = dict(rounds=[1, 2, 4], rate=[0.3, 0.6], depth=[2])
    draws = ML.sample_grid(grid, 6, 42)
    assert len(ML.search_fits(draws)) == 2
    model, table = ML.random_search(df, ["a", "b", "c"], "y", 6, grid, keys=["id"], n_splits=5)
    rows = table.collect()
    assert len(rows) == 6 and {r["fits"] for r in rows} == {10}
    best = min(rows, key=lambda r: (r["cv_mae"], r["spec"]))
    assert [r["spec"] for r in rows if r["chosen"]] == [best["spec"]]
    assert len(model.trees) == best["rounds"]
    # One draw by hand: each fold's own fit and MAE.
    settings = B.Settings(rounds=int(best["rounds"]), rate=best["rate"], depth=2)
    binned = B.bin_table(df, ["a", "b", "c"], ["y"], ["id"], "block")
    maes = [B.boost(binned, [B.Task(0, settings, f)])[0].transform(df.where(F.col("block") == f + 1)).agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0] for f in range(5)]
    assert abs(np.mean(maes) - best["cv_mae"]) < 1e-9


def test_model_is_stored_whole(spark, tmp_path):
    x, y, z = data(200)
    df = frame(spark, x, y, z).withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a")))
    m = ML.train_all_types(df.na.fill(0.0), ["a", "b", "c"], ["y"], "refined", None, None, ["id"], rounds=4)["y"]
    m.save(spark, str(tmp_path / "m"))
    same = B.BoostedModel.load(spark, str(tmp_path / "m"))
    score = lambda k: [r["prediction"] for r in k.transform(df).orderBy("id").collect()]
    assert score(m) == score(same) and len(set(score(m))) > 1


@pytest.mark.parametrize("alpha", [0.0, 5.0])
def test_folds_match_closed_forms(spark, alpha):
    x, y, z = data(300)
    df = frame(spark, x * [1, 1000, 1] + [0, 1e5, 0], y, z).withColumn("d", F.col("a") * 2)
    got = {f: m for _, f, m in FS.linear_folds(df, ["a", "b", "c", "d"], "y", {"s": alpha})}
    x = np.column_stack([x * [1, 1000, 1] + [0, 1e5, 0], 2 * x[:, 0]])
    block = np.arange(300) * 6 // 300
    for f in range(5):
        tr, te = block <= f, block == f + 1
        c = x[tr] - x[tr].mean(0)
        w = np.linalg.lstsq(c.T @ c + alpha * np.eye(4), c.T @ (y[tr] - y[tr].mean()), rcond=1e-10)[0]
        assert abs(got[f] - np.abs(y[te] - y[tr].mean() - (x[te] - x[tr].mean(0)) @ w).mean()) < 1e-6


def test_empty_folds_and_labels(spark):
    df = spark.createDataFrame([], "id long, a double, y double, block int")
    assert FS.linear_folds(df, ["a"], "y", {"s": 1.0}) == [("s", f, None) for f in range(5)]
    m = B.boost(B.bin_table(df, ["a"], ["y"], ["id"]), [B.Task(0, B.Settings(rounds=2))])[0]
    assert m.transform(spark.createDataFrame([(1, 2.0)], "id long, a double")).first()["prediction"] == 0.0


def test_levels_plan_no_query(spark, monkeypatch):
    """A fit has a job a level, thousands in all: none of them may be a query of its own."""
    x, y, z = data(200)
    binned = B.bin_table(frame(spark, x, y, z), ["a", "b", "c"], ["y"], ["id"])
    asked = []
    whole = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: asked.append(df) or whole(df))
    m = B.boost(binned, [B.Task(0, B.Settings(rounds=2, depth=3))])[0]
    assert len(m.trees) == 2 and max(len(t.column) for t in m.trees) > 3 and not asked
