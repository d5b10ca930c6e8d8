"""Joins and set operations.

Equi-joins name their keys and leave the strategy to the planner: with AQE a
side under ``spark.sql.autoBroadcastJoinThreshold`` (measured at run time) is
broadcast, anything larger is shuffled and sort-merged on the keys, and skewed
key partitions are split (``spark.sql.adaptive.skewJoin.enabled``).  Only
one-row statistic tables are broadcast explicitly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeroseries.operators.clean import suffix_collisions


# C1 ---------------------------------------------------------------------------
def join_daily(pollen: DataFrame, weather: DataFrame, keys: Sequence[str] = ("site_id", "date"),
               suffix: str = "_weather") -> DataFrame:
    """Inner equi-join on (site, date); duplicates on either side multiply.
    Right-hand non-key columns that collide get ``suffix``."""
    weather = suffix_collisions(weather, pollen.columns, keys, suffix)
    return pollen.join(weather, list(keys), "inner")


# C2 ---------------------------------------------------------------------------
def date_overlap(a: DataFrame, b: DataFrame, a_date: str = "date", b_date: str = "date",
                 by: Sequence[str] = ()) -> DataFrame:
    """Each side's range and row count plus the shared range
    [max of mins, min of maxes] (globally, or per ``by``)."""
    sa = a.groupBy(*by).agg(F.min(a_date).alias("a_start"), F.max(a_date).alias("a_end"),
                            F.count(F.lit(1)).alias("a_rows"))
    sb = b.groupBy(*by).agg(F.min(b_date).alias("b_start"), F.max(b_date).alias("b_end"),
                            F.count(F.lit(1)).alias("b_rows"))
    j = sa.crossJoin(sb) if not by else sa.join(sb, list(by))
    return j.withColumns({"overlap_start": F.greatest("a_start", "b_start"),
                          "overlap_end": F.least("a_end", "b_end")})


# C3-C5 ------------------------------------------------------------------------
def common_dates(a: DataFrame, b: DataFrame, cols: Sequence[str] = ("site_id", "date")) -> DataFrame:
    """Distinct keys present in both."""
    return a.select(*cols).intersect(b.select(*cols))


def left_only_dates(a: DataFrame, b: DataFrame, cols: Sequence[str] = ("site_id", "date")) -> DataFrame:
    """Distinct keys of ``a`` absent from ``b`` (anti join on the keys)."""
    return a.select(*cols).distinct().join(b.select(*cols), list(cols), "left_anti")


def right_only_dates(a: DataFrame, b: DataFrame, cols: Sequence[str] = ("site_id", "date")) -> DataFrame:
    return left_only_dates(b, a, cols)


def date_set_summary(a: DataFrame, b: DataFrame, cols: Sequence[str] = ("site_id", "date"),
                     first_n: int = 5) -> DataFrame:
    """Per site: counts of common / left-only / right-only dates and the first
    ``first_n`` sorted dates of each one-sided set (from a full outer join of
    the distinct key sets, one shuffle)."""
    site, d = cols[0], cols[1]
    da = a.select(*cols).distinct().withColumn("__a", F.lit(True))
    db = b.select(*cols).distinct().withColumn("__b", F.lit(True))
    j = da.join(db, list(cols), "full_outer")
    in_a, in_b = F.col("__a").isNotNull(), F.col("__b").isNotNull()
    side = F.when(in_a & in_b, "both").when(in_a, "left").otherwise("right")
    j = j.withColumn("__side", side)
    # rank inside (site, side) so only the first n dates of a side are collected
    r = F.row_number().over(Window.partitionBy(site, "__side").orderBy(d))
    j = j.withColumn("__r", r)
    first = F.col("__r") <= first_n
    return j.groupBy(site).agg(
        F.count_if(F.col("__side") == "both").alias("common"),
        F.count_if(F.col("__side") == "left").alias("left_only"),
        F.count_if(F.col("__side") == "right").alias("right_only"),
        F.array_sort(F.collect_list(F.when(first & (F.col("__side") == "left"), F.col(d)))).alias("left_only_first"),
        F.array_sort(F.collect_list(F.when(first & (F.col("__side") == "right"), F.col(d))))
        .alias("right_only_first"),
    )


# C6 ---------------------------------------------------------------------------
def station_record_counts(weather: DataFrame, matched: DataFrame) -> DataFrame:
    """Record counts of the matched stations, one grouped pass plus a semi join."""
    counts = weather.groupBy("STATION").agg(F.count(F.lit(1)).alias("records"))
    return counts.join(matched.select("STATION").distinct(), "STATION", "left_semi")


# C7 ---------------------------------------------------------------------------
def pair_results(a: DataFrame, b: DataFrame, key: str = "pollen_type",
                 suffixes: tuple[str, str] = ("_a", "_b")) -> DataFrame:
    """Match two result tables on ``key``; only common keys are kept."""
    ra = a.select(key, *[F.col(c).alias(c + suffixes[0]) for c in a.columns if c != key])
    rb = b.select(key, *[F.col(c).alias(c + suffixes[1]) for c in b.columns if c != key])
    return ra.join(rb, key, "inner")


# C8 ---------------------------------------------------------------------------
def broadcast_scalar(df: DataFrame, aggs: dict, by: Sequence[str] = ()) -> DataFrame:
    from aeroseries.operators.clean import attach_stats
    return attach_stats(df, aggs, by)
