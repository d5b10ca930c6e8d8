"""Model fitting and selection.

Forests, ridge and linear models are Spark ML; boosted trees are ``boosting``,
linear folds ``foldstats``, forests of a cross-validated choice ``forest``.

Every fit is a distributed Spark ML job over the feature frame; the driver only
starts the (model, fold) fits, a few at a time, and keeps small metric rows.
Before a search the frame is written in the shared folder
(``session.cut_lineage``) so each fit reads the feature table instead of
replaying the window plan, and a lost executor is recovered from the files.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroseries.operators.boosting import ALL_BLOCKS, BoostedModel, Settings, Task, bin_table, boost
from aeroseries.operators.foldstats import linear_folds
from aeroseries.operators.forest import BINS as FOREST_BINS, Forest, fit_forest, forest_edges, forest_error
from aeroseries.operators.metrics import metrics_full
from aeroseries.session import drop_tables

# Reference settings (I5) under Spark's names.  ``small_*`` are for tests.
PRESETS = {
    "rf_baseline": ("rf", dict(numTrees=100, maxDepth=15, minInstancesPerNode=2, seed=42)),
    "rf_weather_only": ("rf", dict(numTrees=200, maxDepth=20, minInstancesPerNode=2, seed=42)),
    "small_rf": ("rf", dict(numTrees=20, maxDepth=8, minInstancesPerNode=2, seed=42)),
    "small_gbt": ("gbt", dict(maxIter=20, stepSize=0.1, maxDepth=5, subsamplingRate=0.8, seed=42)),
    "linear": ("linear", dict(regParam=0.0)),
}

# Reference settings of boosted trees (I9), and their patience.
BOOSTED = {
    "refined": (Settings(rounds=500, rate=0.05, depth=7, min_child=3, rows=0.8, columns=0.8, min_gain=0.1, l1=0.01, l2=1.0), 50),
    "abiotic": (Settings(rounds=1000, rate=0.02, depth=8, min_child=5, rows=0.8, columns=0.8, min_gain=0.2, l1=0.1, l2=1.5), 50),
    "baseline": (Settings(rounds=1000, rate=0.03, depth=6, min_child=5, rows=0.85, columns=0.85, level_columns=0.7, min_gain=0.05, l1=0.05, l2=1.5), 100),
}

# Candidates of the cross-validated choice (I8): forest, ridge, linear.
CV_CANDIDATES = {
    "rf": PRESETS["rf_baseline"],
    "ridge": ("ridge", dict(alpha=1.0)),
    "linear": PRESETS["linear"],
}

# Search grids of boosted trees (I10), by feature set, with the number of draws.
SEARCH_GRIDS = {
    "refined": (dict(rounds=[200, 300, 400], rate=[0.03, 0.05, 0.07], depth=[5, 7, 9], min_child=[1, 3, 5], rows=[0.7, 0.8, 0.9],
                     columns=[0.7, 0.8, 0.9], min_gain=[0, 0.1, 0.2], l1=[0, 0.01, 0.1], l2=[0.5, 1.0, 2.0]), 30),
    "baseline": (dict(rounds=[500, 800, 1000, 1200], rate=[0.01, 0.02, 0.03, 0.05], depth=[5, 6, 7, 8], min_child=[3, 5, 7, 10],
                      rows=[0.75, 0.8, 0.85, 0.9], columns=[0.75, 0.8, 0.85, 0.9], level_columns=[0.6, 0.7, 0.8],
                      min_gain=[0, 0.05, 0.1, 0.15], l1=[0, 0.01, 0.05, 0.1], l2=[1.0, 1.5, 2.0, 2.5]), 50),
}


def estimator(kind: str, label: str, **params):
    common = dict(featuresCol="features", labelCol=label, predictionCol="prediction")
    if kind == "rf":
        return RandomForestRegressor(featureSubsetStrategy="all", **common, **params)
    if kind == "gbt":
        return GBTRegressor(**common, **params)
    if kind in ("linear", "ridge"):
        return LinearRegression(elasticNetParam=0.0, **common, **params)
    raise ValueError(kind)


def pipeline(features: Sequence[str], label: str, kind: str, **params) -> Pipeline:
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return Pipeline(stages=[asm, estimator(kind, label, **params)])


# I5, I7, I9 (single fit) --------------------------------------------------------
def fit(df: DataFrame, features: Sequence[str], label: str, preset: str = "small_gbt",
        **overrides) -> PipelineModel:
    kind, params = PRESETS[preset]
    return pipeline(features, label, kind, **{**params, **overrides}).fit(df)


# I6 ---------------------------------------------------------------------------
def fit_ridge(df: DataFrame, features: Sequence[str], label: str, alpha: float = 1.0) -> PipelineModel:
    """Ridge with penalty ``alpha`` on unscaled features: Spark's objective
    divides the loss by n and scales the penalty by the label's population std,
    so regParam = alpha / n * std_pop(label) gives the closed-form solution."""
    st = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
    reg = alpha / st["n"] * (st["s"] or 1.0)
    return pipeline(features, label, "ridge", regParam=reg, standardization=False,
                    solver="normal").fit(df)


def best_round(errors: Sequence[float], patience: int = 50) -> int:
    """Number of rounds kept by early stopping: the best round seen before
    ``patience`` rounds pass without improvement."""
    best_i, best = 0, math.inf
    for i, e in enumerate(errors):
        if e < best:
            best_i, best = i, e
        elif i - best_i >= patience:
            break
    return best_i + 1


def fit_boosted(df: DataFrame, features: Sequence[str], label: str, preset: str = "refined",
                validation_col: str = "is_validation", patience: int | None = None, keys: Sequence[str] = ("site_id", "date"),
                **overrides) -> BoostedModel:
    """Boosted trees with patience-based early stopping on the rows marked in
    ``validation_col``; the model keeps the rounds up to its best one."""
    return train_all_types(df, features, [label], preset, validation_col, patience, keys, **overrides)[label]


# I8 ---------------------------------------------------------------------------
def _own_forest(spec: tuple[str, dict]) -> bool:
    """Whether ``forest`` has all parameters of a spec; with others it is Spark's."""
    return spec[0] == "rf" and set(spec[1]) <= {"numTrees", "maxDepth", "minInstancesPerNode", "bootstrap", "seed"}


def forest_fold(blocks: DataFrame, features: Sequence[str], label: str, params: dict, f: int) -> float | None:
    """MAE of fold ``f``'s forest; as in a fit by itself, only its training rows say where columns are cut."""
    train = blocks.filter(F.col("block") <= f)
    data = bin_table(blocks.filter(F.col("block") <= f + 1), features, [label], (*features, label), "block", FOREST_BINS, forest_edges(train, features))
    mae = forest_error(data, Forest(**params, upto=f))
    drop_tables(blocks.sparkSession, data.path)
    return mae


def fit_spec(df: DataFrame, features: Sequence[str], label: str, spec: tuple[str, dict]) -> PipelineModel | BoostedModel:
    """Fit a (kind, parameters) pair; ridge takes ``alpha``, scaled to these rows."""
    kind, params = spec
    if _own_forest(spec):
        data = bin_table(df, features, [label], (*features, label), None, FOREST_BINS, forest_edges(df, features))
        m = fit_forest(data, Forest(**params))
        drop_tables(df.sparkSession, data.path)
        return m
    if kind == "ridge" and "alpha" in params:
        return fit_ridge(df, features, label, params["alpha"])
    return pipeline(features, label, kind, **params).fit(df)


def cross_validate(blocks: DataFrame, features: Sequence[str], label: str,
                   specs: dict[str, tuple[str, dict]], n_splits: int = 5, parallelism: int = 4) -> DataFrame:
    """MAE per (spec, fold) on the expanding folds of ``splits.fold_blocks``: all
    linear and ridge folds from two passes, other kinds ``parallelism`` fits at a
    time.  Returns a small table (spec, fold, mae)."""
    def one(task: tuple[str, int]) -> tuple:
        name, f = task
        if _own_forest(specs[name]):
            return name, f, forest_fold(blocks, features, label, specs[name][1], f)
        m = fit_spec(blocks.filter(F.col("block") <= f), features, label, specs[name])
        mae = (m.transform(blocks.filter(F.col("block") == f + 1))
               .agg(F.avg(F.abs(F.col(label) - F.col("prediction"))).alias("mae")).first()["mae"])
        return name, f, float(mae) if mae is not None else None

    alphas = {n: float(p["alpha"]) if k == "ridge" else 0.0 for n, (k, p) in specs.items()
              if k == "ridge" and set(p) == {"alpha"} or k == "linear" and not any(p.values())}
    rows = linear_folds(blocks, features, label, alphas, n_splits) if alphas else []
    with ThreadPoolExecutor(parallelism) as pool:  # the longest fits first
        rows += list(pool.map(one, [(name, f) for f in reversed(range(n_splits)) for name in specs if name not in alphas]))
    return blocks.sparkSession.createDataFrame(rows, "spec string, fold int, mae double")


def select_by_cv(train: DataFrame, blocks: DataFrame, features: Sequence[str], label: str,
                 specs: dict[str, tuple[str, dict]] = CV_CANDIDATES, n_splits: int = 5,
                 parallelism: int = 4) -> tuple[str, PipelineModel | BoostedModel, DataFrame]:
    """Mean and std of fold MAE per spec; the lowest mean wins and is refit on
    all training rows."""
    cv = cross_validate(blocks, features, label, specs, n_splits, parallelism)
    summary = cv.groupBy("spec").agg(F.avg("mae").alias("cv_mae"), F.stddev_samp("mae").alias("cv_std"))
    best = summary.orderBy("cv_mae", "spec").first()["spec"]
    return best, fit_spec(train, features, label, specs[best]), summary


# I10 --------------------------------------------------------------------------
def sample_grid(grid: dict[str, list], n_draws: int, seed: int = 42) -> list[dict]:
    rnd = random.Random(seed)
    keys = sorted(grid)
    seen, out = set(), []
    total = math.prod(len(grid[k]) for k in keys)
    while len(out) < min(n_draws, total):
        combo = tuple(rnd.choice(grid[k]) for k in keys)
        if combo not in seen:
            seen.add(combo)
            out.append(dict(zip(keys, combo)))
    return out


BUNDLE = 3


def search_fits(draws: Sequence[dict]) -> list[tuple[dict, list[int]]]:
    """Draws that differ only in ``rounds`` are prefixes of one fit: (settings with the most rounds, the draws it serves)."""
    groups: dict[tuple, list[int]] = {}
    for i, d in enumerate(draws):
        groups.setdefault(tuple(sorted((k, v) for k, v in d.items() if k != "rounds")), []).append(i)
    return [({**dict(key), "rounds": max(draws[i]["rounds"] for i in own)}, own) for key, own in groups.items()]


def random_search(blocks: DataFrame, features: Sequence[str], label: str, n_draws: int | None = None,
                  grid: str | dict[str, list] = "refined", seed: int = 42, n_splits: int = 5, parallelism: int = 4,
                  keys: Sequence[str] = ("site_id", "date")) -> tuple[BoostedModel, DataFrame]:
    """``n_draws`` points of a grid, each by its mean MAE over the expanding folds
    of ``blocks`` (``splits.fold_blocks``); the best is refit on all rows.

    The folds of a fit advance in the same jobs, and every round's error is known,
    so a smaller number of rounds costs no fit of its own.  Returns the model and
    one row a draw: its settings, cv_mae, cv_std, fits and chosen.
    """
    if isinstance(grid, str):
        grid, n = SEARCH_GRIDS[grid]
        n_draws = n_draws or n
    draws = sample_grid(grid, n_draws or 30, seed)
    data = bin_table(blocks, features, [label], keys, "block")
    fits = search_fits(draws)

    # A few fits of like depth share their jobs; so many that their sums stay small.
    fits.sort(key=lambda x: (x[0].get("depth", 0), x[0]["rounds"]))
    bundles = [fits[i:i + BUNDLE] for i in range(0, len(fits), BUNDLE)]

    def run(bundle: list[tuple[dict, list[int]]]) -> list[tuple]:
        models = boost(data, [Task(0, Settings(**settings, seed=seed), f) for settings, _ in bundle for f in range(n_splits)])
        out = []
        for n, (_, own) in enumerate(bundle):
            errors = [m.errors for m in models[n * n_splits:(n + 1) * n_splits] if m.errors]
            out += [(i, [e[draws[i]["rounds"] - 1][1] for e in errors]) for i in own]
        return out

    with ThreadPoolExecutor(parallelism) as pool:
        found = dict(x for part in pool.map(run, bundles) for x in part)
    axes = sorted(grid)
    rows = [(f"draw_{i:02d}", *[float(draws[i][a]) for a in axes], float(np.mean(e)) if e else None, float(np.std(e, ddof=1)) if len(e) > 1 else None, len(fits) * n_splits) for i, e in sorted(found.items())]
    best = min((r for r in rows if r[-3] is not None), key=lambda r: (r[-3], r[0]))
    table = blocks.sparkSession.createDataFrame([(*r, r is best) for r in rows], "spec string, " + ", ".join(f"{a} double" for a in axes) + ", cv_mae double, cv_std double, fits int, chosen boolean")
    model = boost(data, [Task(0, Settings(**draws[int(best[0][5:])], seed=seed))])[0]
    drop_tables(blocks.sparkSession, data.path)
    return model, table


# I11 --------------------------------------------------------------------------
def train_all_types(df: DataFrame, features: Sequence[str], labels: Sequence[str], preset: str = "abiotic",
                    validation_col: str | None = "is_validation", patience: int | None = None,
                    keys: Sequence[str] = ("site_id", "date"), **overrides) -> dict[str, BoostedModel]:
    """One boosted model per label, each on the rows that have its label: binned
    once, and grown in the same jobs.  Without a ``validation_col`` all rounds
    are kept."""
    settings, own = BOOSTED[preset]
    settings = replace(settings, **overrides)
    data = bin_table(df.na.drop(subset=list(features)), features, labels, keys, validation_col)
    upto = 0 if validation_col else ALL_BLOCKS
    models = boost(data, [Task(i, settings, upto) for i in range(len(labels))], (patience or own) if validation_col else None)
    drop_tables(df.sparkSession, data.path)
    return dict(zip(labels, models))


# F2 helper --------------------------------------------------------------------
def feature_importances(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    spark = SparkSession.getActiveSession()
    if isinstance(model, BoostedModel):
        return spark.createDataFrame(model.importances(), "feature string, importance double")
    est = model.stages[-1]
    if hasattr(est, "featureImportances"):
        vals = est.featureImportances.toArray().tolist()
    else:
        vals = [abs(x) for x in est.coefficients.toArray().tolist()]
    return spark.createDataFrame(list(zip(features, [float(v) for v in vals])),
                                 "feature string, importance double")


def evaluate(model: PipelineModel, df: DataFrame, label: str, by: Sequence[str] = (),
             clip: tuple[float, float] | None = (0.0, 10.0)) -> DataFrame:
    """D18 metrics of a fitted model on ``df`` (predictions clipped)."""
    p = model.transform(df)
    pred = F.col("prediction")
    if clip:
        pred = F.least(F.greatest(pred, F.lit(clip[0])), F.lit(clip[1]))
    p = p.select(*by, F.col(label).alias("actual"), pred.alias("predicted"))
    return metrics_full(p, by=by)


# I16 --------------------------------------------------------------------------
def resolve_model(registry: DataFrame, by: str = "pollen_type") -> DataFrame:
    """First available model per type by priority: registry rows
    (type, model, priority, available)."""
    return (registry.filter(F.col("available"))
            .groupBy(by).agg(F.min_by("model", F.struct("priority", "model")).alias("model"),
                             F.min("priority").alias("priority")))
