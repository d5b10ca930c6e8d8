"""Time-ordered splits and folds.

Positions are per site (``by``): a row's rank comes from a window partitioned
by site, which holds at most one row per calendar day (see ``windows``).  The
global variants (``by=()``) avoid a single-task window over all rows: rows are
counted per date, a running offset is taken over that per-date table (one row
per calendar day, a size bound independent of the number of sites), and the
offset is joined back; within a date rows are ranked by site.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SITE = ("site_id",)


def positions(df: DataFrame, by: Sequence[str] = SITE, order_by: str = "date",
              tie: str = "site_id") -> DataFrame:
    """Adds ``__pos`` (0-based position by date) and ``__n`` (rows) per ``by``."""
    if by:
        w = Window.partitionBy(*by).orderBy(order_by)
        return df.withColumns({"__pos": F.row_number().over(w) - 1,
                               "__n": F.count(F.lit(1)).over(Window.partitionBy(*by))})
    per_date = df.groupBy(order_by).agg(F.count(F.lit(1)).alias("__c"))
    # One row per calendar day: the running offset is computed over the day table only.
    off = per_date.withColumn(
        "__off", F.sum("__c").over(Window.orderBy(order_by).rowsBetween(Window.unboundedPreceding, -1)))
    total = per_date.agg(F.sum("__c").alias("__n"))
    j = df.join(off.select(order_by, F.coalesce("__off", F.lit(0)).alias("__off")), order_by)
    j = j.crossJoin(F.broadcast(total))
    within = F.row_number().over(Window.partitionBy(order_by).orderBy(tie)) - 1
    return j.withColumn("__pos", F.col("__off") + within).drop("__off")


# I1 ---------------------------------------------------------------------------
def split_by_date_quantile(df: DataFrame, frac: float = 0.8, by: Sequence[str] = SITE,
                           date_col: str = "date") -> DataFrame:
    """Cutoff = interpolated ``frac`` quantile of the dates; train <= cutoff < test."""
    d = F.unix_date(F.col(date_col)).cast("double")
    cut = df.groupBy(*by).agg(F.percentile(d, F.lit(frac)).alias("__cut"))
    j = df.crossJoin(F.broadcast(cut)) if not by else df.join(cut, list(by))
    return j.withColumn("role", F.when(d <= F.col("__cut"), "train").otherwise("test")).drop("__cut")


# I2 ---------------------------------------------------------------------------
def split_positional(df: DataFrame, frac: float = 0.8, by: Sequence[str] = SITE,
                     date_col: str = "date") -> DataFrame:
    """First int(frac * n) rows by date are train, the rest test."""
    p = positions(df, by, date_col)
    cut = F.floor(F.col("__n") * F.lit(frac))
    return p.withColumn("role", F.when(F.col("__pos") < cut, "train").otherwise("test")).drop("__pos", "__n")


# I3 ---------------------------------------------------------------------------
def validation_tail(train: DataFrame, keep: float = 0.9, by: Sequence[str] = SITE,
                    date_col: str = "date", out: str = "is_validation") -> DataFrame:
    """Within the training rows, rows after the first int(keep * n) are validation."""
    p = positions(train, by, date_col)
    return p.withColumn(out, F.col("__pos") >= F.floor(F.col("__n") * F.lit(keep))).drop("__pos", "__n")


# I4 ---------------------------------------------------------------------------
def fold_blocks(df: DataFrame, n_splits: int = 5, by: Sequence[str] = SITE,
                date_col: str = "date", out: str = "block") -> DataFrame:
    """Time-series CV without copies of rows: one integer a row.  The last
    ``n_splits`` blocks of n // (n_splits + 1) rows are numbered from 1, all rows
    before them are 0; fold f trains on block <= f and tests on block f + 1."""
    p = positions(df, by, date_col)
    size = F.floor(F.col("__n") / F.lit(n_splits + 1))
    start = F.col("__n") - F.lit(n_splits) * size
    block = F.when(F.col("__pos") < start, F.lit(0)).otherwise(F.floor((F.col("__pos") - start) / size) + 1)
    return p.withColumn(out, block.cast("int")).drop("__pos", "__n")


def expanding_folds(df: DataFrame, n_splits: int = 5, by: Sequence[str] = SITE,
                    date_col: str = "date") -> DataFrame:
    """The folds of ``fold_blocks`` in long form: one output row per (input row,
    fold it takes part in) with ``fold`` and ``role``."""
    b = fold_blocks(df, n_splits, by, date_col, "__block")
    folds = F.sequence(F.greatest(F.col("__block") - 1, F.lit(0)), F.lit(n_splits - 1))
    out = b.withColumn("fold", F.explode(folds))
    role = F.when(F.col("__block") == F.col("fold") + 1, "test").otherwise("train")
    return out.select(*df.columns, "fold", role.alias("role"))


# I17 --------------------------------------------------------------------------
def split_summary(df: DataFrame, label: str, by: Sequence[str] = (), date_col: str = "date") -> DataFrame:
    """Rows, first and last date, label min / max / mean per role (and ``by``)."""
    return df.groupBy(*by, "role").agg(
        F.count(F.lit(1)).alias("rows"), F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"),
        F.min(label).alias("label_min"), F.max(label).alias("label_max"), F.avg(label).alias("label_mean"))
