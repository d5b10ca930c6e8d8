"""Accuracy metrics and model comparison.

Metrics are single-pass conditional aggregates (``groupBy`` with partial
aggregation), so they scale with any number of models, sites or folds and a
hot group (one model's rows) is combined map-side; R2 takes its total sum of
squares from ``var_pop`` in the same pass (no second pass, no join)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeroseries.functions.scalars import season


def _r2(y: str, e) -> "F.Column":
    """1 - SSE / SST with SST = n * var_pop(y): one pass, numerically stable
    (Welford-style merge) and partially aggregatable, so a hot group is
    combined map-side; null when y has no variance."""
    sst = F.var_pop(F.col(y)) * F.count(F.lit(1))
    return F.lit(1.0) - F.try_divide(F.sum(e * e), F.nullif(sst, F.lit(0.0)))


# D14 --------------------------------------------------------------------------
def metrics_basic(df: DataFrame, y: str = "actual", p: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    d = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
    e = F.col(y) - F.col(p)
    return d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        _r2(y, e).alias("r2"))


# D18 --------------------------------------------------------------------------
def metrics_full(df: DataFrame, y: str = "actual", p: str = "predicted", by: Sequence[str] = (),
                 high: float = 7.0) -> DataFrame:
    """D14 plus weighted MAE (weight 2 where y >= high), share within 1 and 2
    levels, MAE and count of the y >= high rows (MAE null when there are none)."""
    d = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
    e = F.col(y) - F.col(p)
    ae = F.abs(e)
    hi = F.col(y) >= high
    return d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(ae).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        _r2(y, e).alias("r2"),
        F.avg(ae * F.when(hi, 2.0).otherwise(1.0)).alias("weighted_mae"),
        F.avg((ae <= 1).cast("double")).alias("acc_within_1"),
        F.avg((ae <= 2).cast("double")).alias("acc_within_2"),
        F.avg(F.when(hi, ae)).alias("high_mae"),
        F.count_if(hi).alias("high_count"))


# D19 --------------------------------------------------------------------------
def metrics_by_season(df: DataFrame, y: str = "actual", p: str = "predicted", date_col: str = "date",
                      by: Sequence[str] = ()) -> DataFrame:
    """D14 per season with both means, in one aggregate over the rows that have
    both values."""
    d = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull()).withColumn("season", season(F.month(date_col)))
    e = F.col(y) - F.col(p)
    return d.groupBy(*by, "season").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        _r2(y, e).alias("r2"), F.avg(y).alias("mean_actual"), F.avg(p).alias("mean_predicted"))


# D20 --------------------------------------------------------------------------
def macro_average(metrics: DataFrame, by: Sequence[str] = (),
                  cols: Sequence[str] = ("mae", "r2", "acc_within_1")) -> DataFrame:
    """Unweighted mean over pollen types (one row per ``by``)."""
    return metrics.groupBy(*by).agg(*[F.avg(c).alias(f"avg_{c}") for c in cols],
                                    F.count(F.lit(1)).alias("types"))


# D21 --------------------------------------------------------------------------
def model_spread(models: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Over models: range, sample std, mean, median, min, max of MAE and R2."""
    aggs = [F.count(F.lit(1)).alias("models")]
    for c in ("mae", "r2"):
        aggs += [(F.max(c) - F.min(c)).alias(f"{c}_range"), F.stddev_samp(c).alias(f"{c}_std"),
                 F.avg(c).alias(f"{c}_mean"), F.percentile(F.col(c), F.lit(0.5)).alias(f"{c}_median"),
                 F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return models.groupBy(*by).agg(*aggs)


# D22 --------------------------------------------------------------------------
def family_stats(models: DataFrame, families: Sequence[str], model_col: str = "model") -> DataFrame:
    """Per family (models whose name contains the family string): count, best
    and mean MAE, and the percent by which the family's best beats the best of
    the other families (null for a family that is not the overall best)."""
    fam = F.lit(None).cast("string")
    for f in reversed(list(families)):
        fam = F.when(F.col(model_col).contains(f), F.lit(f)).otherwise(fam)
    g = (models.withColumn("family", fam).filter(F.col("family").isNotNull())
         .groupBy("family").agg(F.count(F.lit(1)).alias("models"), F.min("mae").alias("best_mae"),
                                F.avg("mae").alias("mean_mae")))
    # Best of the *other* families without pairing families: a window over the
    # few family rows; the overall best family compares with the second entry,
    # every other family with the first (ties included).
    bests = F.array_sort(F.collect_list("best_mae").over(Window.partitionBy()))
    cmp = g.withColumn("__b", bests)
    first, second = F.element_at("__b", 1), F.try_element_at("__b", F.lit(2))
    cmp = cmp.withColumn("other_best", F.when(F.col("best_mae") == first, second).otherwise(first)).drop("__b")
    wins = F.col("best_mae") < F.col("other_best")
    return cmp.withColumn(
        "pct_better", F.when(wins, (F.col("other_best") - F.col("best_mae")) / F.col("other_best") * 100))


# D23 --------------------------------------------------------------------------
def improvement(worse, better):
    """Percent improvement of ``better`` over ``worse`` (null when worse is 0)."""
    return F.try_divide((worse - better) * 100, F.nullif(worse, F.lit(0.0)))


def best_vs_worst(models: DataFrame, baseline: str | None = None, model_col: str = "model") -> DataFrame:
    """Best vs worst MAE improvement, and vs a named baseline model."""
    g = models.agg(F.min("mae").alias("best_mae"), F.max("mae").alias("worst_mae"),
                   F.max(F.when(F.col(model_col) == F.lit(baseline), F.col("mae"))).alias("baseline_mae"))
    return g.select("best_mae", "worst_mae", "baseline_mae",
                    improvement(F.col("worst_mae"), F.col("best_mae")).alias("improvement_pct"),
                    improvement(F.col("baseline_mae"), F.col("best_mae")).alias("vs_baseline_pct"))


def compare_regimes(a: DataFrame, b: DataFrame, key: str = "pollen_type") -> DataFrame:
    """Per type: MAE / R2 / within-1 of regime a and b, the percent MAE gain of
    b over a, and whether b is better."""
    j = (a.select(key, F.col("mae").alias("mae_a"), F.col("r2").alias("r2_a"),
                  F.col("acc_within_1").alias("acc_a"))
         .join(b.select(key, F.col("mae").alias("mae_b"), F.col("r2").alias("r2_b"),
                        F.col("acc_within_1").alias("acc_b")), key))
    return j.withColumns({
        "mae_improvement_pct": improvement(F.col("mae_a"), F.col("mae_b")),
        "r2_change": F.col("r2_b") - F.col("r2_a"),
        "acc_change_pct": (F.col("acc_b") - F.col("acc_a")) * 100,
        "b_is_better": F.coalesce(F.col("mae_b") < F.col("mae_a"), F.lit(False)),
    })
