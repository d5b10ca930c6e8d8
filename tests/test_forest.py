"""Forests on binned columns against a plain recursive tree."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroseries.operators import boosting as B
from aeroseries.operators import forest as FO
from aeroseries.operators import models as ML

COLS = ["a", "b", "c"]


def frame(spark, n=400, seed=5, n_blocks=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(1)
    y = np.where(x[:, 0] > 0.2, 3.0, 0.0) + x[:, 1] + rng.normal(size=n)
    rows = [(i, *map(float, r), float(v), i * n_blocks // n) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double, block int").repartition(3, "id"), x, y


def plain(bins, y, w, depth, least):
    """Prediction of every row by one greedy tree over the rows of weight ``w``."""
    out = np.zeros(len(y))

    def go(rows, level):
        own = rows[w[rows] > 0]
        n, s = w[own].sum(), (w * y)[own].sum()
        best = (FO.LEAST_GAIN, None)
        if level < depth:
            for c in range(bins.shape[1]):
                for cut in range(bins[:, c].max()):
                    left = own[bins[own, c] <= cut]
                    nl, sl = w[left].sum(), (w * y)[left].sum()
                    if nl >= least and n - nl >= least:
                        gain = sl ** 2 / nl + (s - sl) ** 2 / (n - nl) - s ** 2 / n
                        if gain > best[0] + 1e-9:
                            best = (gain, (c, cut))
        if best[1] is None:
            out[rows] = s / n
            return
        left = bins[rows, best[1][0]] <= best[1][1]
        go(rows[left], level + 1)
        go(rows[~left], level + 1)

    go(np.arange(len(y)), 0)
    return out


@pytest.mark.parametrize("group", [1 << 17, 60])
def test_tree_and_fold_equal_a_plain_tree(spark, monkeypatch, group):
    monkeypatch.setattr(FO, "GROUP", group)
    df, x, y = frame(spark)
    edges = B.quantile_edges(df.filter("block <= 2"), COLS, FO.BINS)
    bins, test = B.binned(list(x.T), edges), np.arange(400) >= 300
    want = plain(bins, y, (~test).astype(float), 5, 2)
    f = FO.Forest(1, 5, 2, bootstrap=False, upto=2)
    data = B.bin_table(df, COLS, ["y"], ["id"], "block", FO.BINS, edges)
    assert FO.forest_error(data, f) == pytest.approx(np.abs(want - y)[test].mean(), abs=1e-9)
    got = {r["id"]: r["prediction"] for r in FO.fit_forest(data, f).transform(df).collect()}
    assert np.allclose([got[i] for i in range(400)], want)


def test_samples_rounds_and_groups_change_nothing(spark, monkeypatch):
    df, _, _ = frame(spark)
    data = B.bin_table(df, COLS, ["y"], ["id"], "block", FO.BINS)
    f = FO.Forest(7, 4, 2, upto=2)
    want = FO.forest_error(data, f)
    model = FO.fit_forest(data, f)
    mae = model.transform(df.filter("block = 3")).agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert mae == pytest.approx(want, abs=1e-9) and len(model.trees) == 7
    monkeypatch.setattr(FO, "SHUFFLED", 20_000)
    monkeypatch.setattr(FO, "GROUP", 50)
    assert FO.forest_error(data, f) == pytest.approx(want, abs=1e-9)


def test_sample_is_poisson_and_differs_between_trees():
    h = np.zeros(200_000, np.int64)  # copies of one row
    a, b = (FO.drawn(h, FO.Forest(), t).astype(float) for t in (0, 1))
    assert abs(a.mean() - 1) < 0.01 and abs(a.var() - 1) < 0.02
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.01


def test_odd_rows(spark):
    one = spark.createDataFrame([(0, 1.0, 2.0, 0)], "id long, a double, y double, block int")
    f = FO.Forest(3, 4, 2)
    assert {r["prediction"] for r in FO.fit_forest(B.bin_table(one, ["a"], ["y"], ["id"], "block", FO.BINS), f).transform(one).collect()} == {2.0}
    assert FO.forest_error(B.bin_table(one, ["a"], ["y"], ["id"], "block", FO.BINS), FO.Forest(3, 4, 2, upto=0)) is None
    with pytest.raises(ValueError):
        FO.fit_forest(B.bin_table(one.filter("id > 0"), ["a"], ["y"], ["id"], "block", FO.BINS), f)
    with pytest.raises(Exception, match="null or NaN"):
        FO.fit_forest(B.bin_table(one.withColumn("a", F.lit(None).cast("double")), ["a"], ["y"], ["id"], "block", FO.BINS), f)


def test_choice_grows_its_forests_here_and_near_sparks(spark):
    """Folds of deep forests without Spark's histograms of every node; the errors agree."""
    df, _, _ = frame(spark, 1200)
    spec = ("rf", dict(numTrees=30, maxDepth=6, minInstancesPerNode=2, seed=42))
    got = {r["fold"]: r["mae"] for r in ML.cross_validate(df, COLS, "y", {"rf": spec}, 3).collect()}
    for f in range(3):
        m = ML.pipeline(COLS, "y", *spec[:1], **spec[1]).fit(df.filter(F.col("block") <= f))
        mae = m.transform(df.filter(F.col("block") == f + 1)).agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0]
        assert got[f] == pytest.approx(mae, rel=0.05)
    best, model, _ = ML.select_by_cv(df, df, COLS, "y", {"rf": spec}, 3)
    assert best == "rf" and isinstance(model, B.BoostedModel) and len(model.trees) == 30


def test_cuts_are_sparks(spark):
    """Few values are all told apart, rare ones too; of many, a common one costs no cuts of the others."""
    rows = spark.range(4000).selectExpr("id", "if(id = 7, 9.0, id % 2) AS few", "if(id % 10 < 8, 0.0, cast(id AS double)) AS many", "cast(id AS double) AS even")
    few, many, even = FO.forest_edges(rows.repartition(3), ["few", "many", "even"])
    assert few == [0.5, 5.0]
    assert len(many) == 31 and 0 < many[0] < 100
    assert np.allclose(even, [4000 * i / 32 for i in range(1, 32)], atol=20)
