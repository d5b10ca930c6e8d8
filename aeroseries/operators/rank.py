"""Sorts, limits and top-k.

Global ``orderBy`` appears only at output; per-site top-k uses ``row_number``
over a per-site window with a ``<= k`` filter, which Spark turns into a
window-group limit (each task keeps at most k rows per site before the sort
completes)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# F1 ---------------------------------------------------------------------------
def time_order(df: DataFrame, partition_by: Sequence[str] = ("site_id",), order_by: str = "date",
               global_sort: bool = False) -> DataFrame:
    """Rows clustered by site and ordered by date inside each partition; range
    partitioning on (site, date) splits a hot site over several tasks.  A
    global sort only when asked (final ordered output)."""
    if global_sort:
        return df.orderBy(*partition_by, order_by)
    return df.repartitionByRange(*partition_by, order_by).sortWithinPartitions(*partition_by, order_by)


# F2 ---------------------------------------------------------------------------
def top_features(importances: DataFrame, k: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Highest importances first (ties by name), top ``k`` per ``by`` group."""
    w = Window.partitionBy(*by).orderBy(F.desc("importance"), F.asc("feature"))
    return (importances.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k))


# F3 ---------------------------------------------------------------------------
def leaderboard(models: DataFrame) -> DataFrame:
    """Models by MAE ascending (ties by name): a range-partitioned global sort,
    no single-partition window."""
    return models.orderBy(F.asc("mae"), F.asc("model"))


# F4 ---------------------------------------------------------------------------
def best_by(models: DataFrame, by: Sequence[str] = (), model_col: str = "model") -> DataFrame:
    """Lowest MAE and highest R2 model; ties go to the first model by name."""
    lo = F.min_by(F.col(model_col), F.struct(F.col("mae"), F.col(model_col)))
    hi = F.min_by(F.col(model_col), F.struct(-F.col("r2"), F.col(model_col)))
    return models.groupBy(*by).agg(lo.alias("best_mae_model"), F.min("mae").alias("best_mae"),
                                   hi.alias("best_r2_model"), F.max("r2").alias("best_r2"))


# F5 ---------------------------------------------------------------------------
def last_n(df: DataFrame, n: int = 100, partition_by: Sequence[str] = ("site_id",),
           order_by: str = "date") -> DataFrame:
    w = Window.partitionBy(*partition_by).orderBy(F.desc(order_by))
    return df.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= n).drop("__r")


# F6 ---------------------------------------------------------------------------
def first_per_month(df: DataFrame, months: Sequence[int] = (3, 6, 9),
                    partition_by: Sequence[str] = ("site_id",), date_col: str = "date") -> DataFrame:
    """First row of each listed month, per site and year."""
    m = F.month(date_col)
    w = Window.partitionBy(*partition_by, F.year(date_col), m).orderBy(date_col)
    return (df.filter(m.isin(*months)).withColumn("__r", F.row_number().over(w))
            .filter(F.col("__r") == 1).drop("__r"))
