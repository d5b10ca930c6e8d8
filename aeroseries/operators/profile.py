"""Profiling aggregates.

All are grouped aggregations with partial (map-side) aggregation, so a hot
station or site is combined inside each input partition before the shuffle.
Percentiles are exact: per group one counter per distinct value (groups of a
site-day table are bounded by the calendar), over the whole table by a
range-partitioned running count.  ``approx=True`` asks for ``percentile_approx``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroseries.functions import scalars as S
from aeroseries.session import cut_lineage

WEATHER_VARS = ["TMAX", "TMIN", "TAVG", "PRCP", "AWND"]
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
POLLEN_TYPES = ["Total_Pollen", "Tree", "Grass", "Weed", "Ragweed"]


def _present(df: DataFrame, cols):
    have = set(df.columns)
    return [c for c in cols if c in have]


def _unpivot(df: DataFrame, ids: Sequence[str], pairs: list[tuple[str, list[Column]]],
             names: Sequence[str]) -> DataFrame:
    """Long form: one row per (ids, label) with the given value columns."""
    arr = F.array(*[F.struct(F.lit(lbl).alias("__k"), *[c.alias(n) for c, n in zip(vals, names)])
                    for lbl, vals in pairs])
    e = df.select(*ids, F.inline(arr))
    return e


# D1 ---------------------------------------------------------------------------
def profile(df: DataFrame, date_col: str = "DATE", station_col: str = "STATION",
            approx: bool = False) -> DataFrame:
    distinct = (F.approx_count_distinct(station_col) if approx else F.countDistinct(station_col))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min(date_col).alias("date_min"),
                  F.max(date_col).alias("date_max"), distinct.alias("stations"))


# D2 ---------------------------------------------------------------------------
def station_counts(df: DataFrame, k: int = 10, station_col: str = "STATION") -> DataFrame:
    """Records per station, most first (ties by station), top ``k``."""
    return (df.groupBy(station_col).agg(F.count(F.lit(1)).alias("records"))
            .orderBy(F.desc("records"), F.asc(station_col)).limit(k))


# D3 ---------------------------------------------------------------------------
def station_summary(df: DataFrame, station: str, station_col: str = "STATION",
                    date_col: str = "DATE") -> DataFrame:
    """Name, count, date range and share of all rows for one station (one pass)."""
    hit = F.col(station_col) == F.lit(station)
    return df.agg(
        F.lit(station).alias("station"),
        F.min(F.when(hit, F.col("NAME"))).alias("name"),
        F.count_if(hit).alias("records"),
        F.min(F.when(hit, F.col(date_col))).alias("date_min"),
        F.max(F.when(hit, F.col(date_col))).alias("date_max"),
        (F.count_if(hit) * 100.0 / F.count(F.lit(1))).alias("share_pct"))


# D4 ---------------------------------------------------------------------------
def completeness(df: DataFrame, cols: Sequence[str] = WEATHER_VARS, by: Sequence[str] = ()) -> DataFrame:
    """Percent non-null per variable: rows (by..., variable, pct)."""
    cols = _present(df, cols)
    g = df.groupBy(*by).agg(*[(F.count(c) * 100.0 / F.count(F.lit(1))).alias(c) for c in cols])
    return g.unpivot(list(by), cols, "variable", "pct") if cols else g


def completeness_change(before: DataFrame, after: DataFrame, cols: Sequence[str] = WEATHER_VARS,
                        by: Sequence[str] = ()) -> DataFrame:
    b = completeness(before, cols, by).withColumnRenamed("pct", "pct_before")
    a = completeness(after, cols, by).withColumnRenamed("pct", "pct_after")
    return (b.join(a, [*by, "variable"], "full_outer")
            .withColumn("change", F.col("pct_after") - F.col("pct_before")))


# D5 ---------------------------------------------------------------------------
def daily_completeness(df: DataFrame, cols: Sequence[str] = WEATHER_VARS, date_col: str = "DATE",
                       by: Sequence[str] = ()) -> DataFrame:
    """Per date the non-null share over stations, then the mean of the daily
    shares (not the pooled share): rows (by..., variable, pct)."""
    cols = _present(df, cols)
    daily = df.groupBy(*by, date_col).agg(
        *[(F.count(c) * 100.0 / F.count(F.lit(1))).alias(c) for c in cols])
    g = daily.groupBy(*by).agg(*[F.avg(c).alias(c) for c in cols])
    return g.unpivot(list(by), cols, "variable", "pct")


# D6 ---------------------------------------------------------------------------
def recommend_strategy(target: DataFrame, all_stations: DataFrame) -> DataFrame:
    """Per variable: target station's completeness (D4 over the station) vs the
    mean daily completeness over all stations (D5).  'single' if target >= 80,
    else 'aggregate' if all >= 80, else 'single_limited' if target > all, else
    'aggregate_limited'.  ``overall`` is the majority of single-vs-aggregate;
    ties go to aggregate."""
    t = target.withColumnRenamed("pct", "target_pct")
    a = all_stations.withColumnRenamed("pct", "all_pct")
    j = t.join(a, "variable", "full_outer")
    tp, ap = F.coalesce(F.col("target_pct"), F.lit(0.0)), F.coalesce(F.col("all_pct"), F.lit(0.0))
    strat = (F.when(tp >= 80, "single").when(ap >= 80, "aggregate")
             .when(tp > ap, "single_limited").otherwise("aggregate_limited"))
    j = j.withColumn("strategy", strat)
    # One row a variable: a window over the few rows, not a second pass.
    w = Window.partitionBy()
    single = F.count_if(F.col("strategy").startswith("single")).over(w)
    agg = F.count_if(F.col("strategy").startswith("aggregate")).over(w)
    return j.withColumn("overall", F.when(single > agg, "single").otherwise("aggregate"))


# D7 ---------------------------------------------------------------------------
def aggregate_stations(df: DataFrame, cols: Sequence[str] = ("TMAX", "TMIN", "TAVG", "PRCP", "AWND"),
                       by: Sequence[str] = ("site_id",), date_col: str = "DATE",
                       out_date: str = "date") -> DataFrame:
    """Mean of each variable per (site, day) over stations, nulls skipped.
    Partial aggregation combines a hot site inside each map task first."""
    cols = _present(df, cols)
    return df.groupBy(*by, F.col(date_col).alias(out_date)).agg(*[F.avg(c).alias(c) for c in cols])


# D8 ---------------------------------------------------------------------------
def range_stats(df: DataFrame, cols: Sequence[str] = WEATHER_VARS, by: Sequence[str] = ()) -> DataFrame:
    cols = _present(df, cols)
    aggs = []
    for c in cols:
        aggs += [F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max"),
                 F.avg(c).alias(f"{c}__mean")]
    g = df.groupBy(*by).agg(*aggs)
    pairs = [(c, [F.col(f"{c}__min"), F.col(f"{c}__max"), F.col(f"{c}__mean")]) for c in cols]
    return _unpivot(g, by, pairs, ["min", "max", "mean"]).withColumnRenamed("__k", "variable")


# D9 ---------------------------------------------------------------------------
def duplicate_dates(df: DataFrame, keys: Sequence[str] = ("site_id", "date"),
                    by: Sequence[str] = ("site_id",)) -> DataFrame:
    """Rows beyond the first per key, summed per ``by``."""
    per = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return per.groupBy(*by).agg(F.sum("extra").cast("bigint").alias("duplicate_rows"))


def drop_duplicate_dates(df: DataFrame, keys: Sequence[str] = ("site_id", "date")) -> DataFrame:
    return df.dropDuplicates(list(keys))


# D10 --------------------------------------------------------------------------
def month_counts(df: DataFrame, date_col: str = "date", by: Sequence[str] = ()) -> DataFrame:
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    return (df.groupBy(*by, F.month(date_col).alias("month")).agg(F.count(F.lit(1)).alias("days"))
            .withColumn("month_name", F.element_at(names, F.col("month"))))


# D11 --------------------------------------------------------------------------
def correlations(df: DataFrame, target: str = "Total_Pollen", cols: Sequence[str] = WEATHER_VARS,
                 by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of each variable with ``target``, pairwise complete;
    null when either side is constant in the group."""
    cols = _present(df, cols)
    tgt = F.col(target)
    aggs = []
    for c in cols:
        both = F.col(c).isNotNull() & tgt.isNotNull()
        x, y = F.when(both, F.col(c)), F.when(both, tgt)
        # ANSI-safe Pearson: null (not an error) when a side has no variance.
        aggs.append(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias(c))
    g = df.groupBy(*by).agg(*aggs)
    return g.unpivot(list(by), cols, "variable", "corr")


# D12 --------------------------------------------------------------------------
def monthly_pollen(df: DataFrame, col: str = "Total_Pollen", date_col: str = "date",
                   by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.month(date_col).alias("month")).agg(
        F.avg(col).alias("mean"), F.max(col).alias("max"), F.count(col).alias("count"))


# D13 --------------------------------------------------------------------------
def pollen_presence(df: DataFrame, cols: Sequence[str] = POLLEN_TYPES, by: Sequence[str] = ()) -> DataFrame:
    cols = _present(df, cols)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in cols:
        aggs.append(F.count_if(F.col(c) > 0).alias(f"{c}__days"))
    g = df.groupBy(*by).agg(*aggs)
    pairs = [(c, [F.col(f"{c}__days"), F.col(f"{c}__days") * 100.0 / F.col("__n")]) for c in cols]
    return _unpivot(g, by, pairs, ["days_present", "pct"]).withColumnRenamed("__k", "pollen_type")


# Exact whole-table percentiles ---------------------------------------------------
def exact_percentiles(df: DataFrame, cols: Sequence[str], fractions: Sequence[float]) -> dict[str, list | None]:
    """Interpolated percentiles of whole columns, exact at any size.

    Each column's value counts are range-partitioned and written once; a value's
    rank is its running count inside its partition plus the counts of the
    partitions before it.  Only those totals and the two neighbours of each
    wanted rank reach the driver.  None for a column without values.
    """
    out: dict[str, list | None] = {}
    for c in cols:
        counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        placed = cut_lineage(counts.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "value-counts")
        totals = sorted(placed.groupBy("part").agg(F.sum("n").alias("n")).collect())
        size = sum(t["n"] for t in totals)
        if not size:
            out[c] = None
            continue
        before = {t["part"]: sum(x["n"] for x in totals[:i]) for i, t in enumerate(totals)}
        ranks = sorted({r for f in fractions for r in (math.floor(f * (size - 1)), math.ceil(f * (size - 1)))})
        parts = [p for p, b in before.items() if any(b <= r < b + dict(totals)[p] for r in ranks)]
        upto = F.sum("n").over(Window.partitionBy("part").orderBy("v"))
        base = F.element_at(F.create_map(*[F.lit(x) for p in parts for x in (p, before[p])]), F.col("part"))
        rows = placed.where(F.col("part").isin(parts)).select("v", "n", (upto + base).alias("end"))
        hit = F.exists(F.array(*[F.lit(r) for r in ranks]), lambda r: (r < F.col("end")) & (r >= F.col("end") - F.col("n")))
        found = rows.where(hit).collect()
        value = {r: next(x["v"] for x in found if x["end"] - x["n"] <= r < x["end"]) for r in ranks}

        def at(f: float) -> float:
            place = f * (size - 1)
            lo, hi = value[math.floor(place)], value[math.ceil(place)]
            return lo if lo == hi else (math.ceil(place) - place) * lo + (place - math.floor(place)) * hi

        out[c] = [at(f) for f in fractions]
    return out


def _cuts(df: DataFrame, cols: Sequence[str], fractions: Sequence[float], approx: bool, accuracy: int) -> dict[str, Column]:
    """Whole-table percentiles of ``cols`` as literal array columns."""
    if approx:
        r = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(fractions), accuracy).alias(c) for c in cols]).first()
        found = {c: r[c] for c in cols}
    else:
        found = exact_percentiles(df, cols, fractions)
    null = F.lit(None).cast("array<double>")
    return {c: null if found[c] is None else F.array(*[F.lit(float(x)) for x in found[c]]) for c in cols}


# D15 --------------------------------------------------------------------------
def severity_thresholds(df: DataFrame, col: str = "Total_Pollen", by: Sequence[str] = (),
                        percentiles: Sequence[float] = S.SEVERITY_PERCENTILES,
                        approx: bool = False, accuracy: int = 100000) -> DataFrame:
    """Percentile cut points of the positive values (linear interpolation), as
    an array column ``thresholds`` per ``by`` group.  Exact unless ``approx``:
    groups of a site-day table are bounded by the calendar, the whole table goes
    through ``exact_percentiles``."""
    fr = [p / 100.0 for p in percentiles]
    pos = df.select(*by, F.when(F.col(col) > 0, F.col(col)).alias("__v"))
    if by:
        arr = F.array(*[F.lit(f) for f in fr])
        pct = F.percentile_approx("__v", arr, accuracy) if approx else F.percentile("__v", arr)
        return pos.groupBy(*by).agg(pct.alias("thresholds"))
    return df.sparkSession.range(1).select(_cuts(pos, ["__v"], fr, approx, accuracy)["__v"].alias("thresholds"))


def label_percentile_severity(df: DataFrame, col: str = "Total_Pollen", by: Sequence[str] = (),
                              out: str = "Pollen_Severity", approx: bool = False,
                              window: bool = False) -> DataFrame:
    """G18 with D15 cut points attached per ``by`` group (whole table by default).
    ``window=True`` computes per-group cut points as a window over ``by``
    (site-day tables: one exchange, no second pass and join)."""
    fr = [p / 100.0 for p in S.SEVERITY_PERCENTILES]
    pos = F.when(F.col(col) > 0, F.col(col))
    if not by:
        cuts = _cuts(df.select(pos.alias("__v")), ["__v"], fr, approx, 100000)["__v"]
        return df.withColumn(out, S.severity_percentile(F.col(col), cuts))
    if window:
        thr_w = F.percentile(pos, F.array(*[F.lit(f) for f in fr])).over(Window.partitionBy(*by))
        return df.withColumn(out, S.severity_percentile(F.col(col), thr_w))
    j = df.join(severity_thresholds(df, col, by, approx=approx), list(by), "left")
    return j.withColumn(out, S.severity_percentile(F.col(col), F.col("thresholds"))).drop("thresholds")


# D16 --------------------------------------------------------------------------
def severity_distribution(df: DataFrame, col: str = "Pollen_Severity", by: Sequence[str] = ()) -> DataFrame:
    """Days, share and name of each severity; the total is a sum of the grouped
    counts, so the input is read once."""
    names = F.array(*[F.lit(x) for x in S.SEVERITY_NAMES])
    g = df.groupBy(*by, F.col(col).alias("severity")).agg(F.count(F.lit(1)).alias("days"))
    tot = F.sum("days").over(Window.partitionBy(*by))
    lvl = F.when(F.col("severity") < 10, F.element_at(names, F.col("severity").cast("int") + 1)) \
        .otherwise(F.concat(F.lit("Level "), F.col("severity").cast("int").cast("string")))
    return g.select(*by, "severity", "days", (F.col("days") * 100.0 / tot).alias("pct"), lvl.alias("label"))


# D17 --------------------------------------------------------------------------
def upper_quartile_flag(df: DataFrame, col: str, out: str, q: float = 0.75,
                        by: Sequence[str] = (), fit_on: DataFrame | None = None,
                        window: bool = False, approx: bool = False) -> DataFrame:
    """``col > quantile(col, q)`` over the whole table (or ``fit_on``), null is 0."""
    if fit_on is None:
        return upper_quartile_flags(df, {col: out}, q, by, window, approx)
    if not by:
        cut = F.element_at(_cuts(fit_on.select(col), [col], [q], approx, 100000)[col], 1)
        return df.withColumn(out, S.flag(F.col(col) > cut))
    pct = F.percentile_approx(F.col(col), F.lit(q), 100000) if approx else F.percentile(F.col(col), F.lit(q))
    j = df.join(fit_on.groupBy(*by).agg(pct.cast("double").alias("__q")), list(by), "left")
    return j.withColumn(out, S.flag(F.col(col) > F.col("__q"))).drop("__q")


def upper_quartile_flags(df: DataFrame, flags: dict[str, str], q: float = 0.75, by: Sequence[str] = (),
                         window: bool = False, approx: bool = False) -> DataFrame:
    """Several D17 flags (``{column: output}``).  ``window=True`` (per-``by``
    groups of a site-day table that is windowed by site anyway) computes the
    quantiles as windows over ``by``: they share the site exchange instead of a
    second pass over the input plus a join."""
    if not by:
        cuts = _cuts(df.select(*flags), list(flags), [q], approx, 100000)
        return df.withColumns({o: S.flag(F.col(c) > F.element_at(cuts[c], 1)) for c, o in flags.items()})
    if window:
        w = Window.partitionBy(*by)
        return df.withColumns({o: S.flag(F.col(c) > F.percentile(F.col(c), F.lit(q)).over(w))
                               for c, o in flags.items()})
    qt = df.groupBy(*by).agg(*[(F.percentile_approx(F.col(c), F.lit(q), 100000) if approx
                                else F.percentile(F.col(c), F.lit(q))).cast("double").alias(f"__q_{c}") for c in flags])
    j = df.join(qt, list(by), "left")
    return j.withColumns({o: S.flag(F.col(c) > F.col(f"__q_{c}")) for c, o in flags.items()}) \
        .drop(*[f"__q_{c}" for c in flags])


# D24 --------------------------------------------------------------------------
def distribution_histogram(df: DataFrame, cols: Sequence[str] = ("actual", "predicted"),
                           bins: int = 11, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over each series' own [min, max]; the max falls in the
    last bin.  Density = count / (n * width).  Rows (by..., series, bin, lo, hi,
    count, density).  One aggregate finds all bounds, one counts all bins."""
    stacked = df.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("series"), F.col(c).cast("double").alias("__v"))
                                                 for c in cols])).alias("__x")).select(*by, "__x.*").filter("__v is not null")
    keys = [*by, "series"]
    st = stacked.groupBy(*keys).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.count("__v").alias("__n"))
    w = (F.col("__hi") - F.col("__lo")) / F.lit(bins)
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(1)).otherwise(
        F.least(F.floor((F.col("__v") - F.col("__lo")) / w) + 1, F.lit(bins)))
    g = (stacked.join(st, keys).withColumn("bin", b.cast("int"))
         .groupBy(*keys, "bin", "__lo", "__hi", "__n").agg(F.count(F.lit(1)).alias("count")))
    return g.select(*keys, "bin", (F.col("__lo") + (F.col("bin") - 1) * w).alias("lo"),
                    (F.col("__lo") + F.col("bin") * w).alias("hi"), "count",
                    F.when(w > 0, F.col("count") / (F.col("__n") * w)).alias("density"))
