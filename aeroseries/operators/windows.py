"""Window operators over daily series.

All windows are ``Window.partitionBy(*partition_by).orderBy(order_by)``; frames
count rows, not calendar days (gaps are not filled).  Each operator takes the
partition keys so every window of a feature set shares one exchange on
``site_id``: Spark's distribution check accepts a hash partitioning on a subset
of the window keys, so the streak windows keyed ``(site_id, k)`` and the yearly
running sums keyed ``(site_id, year)`` reuse the same shuffle and only add sorts.

Size bound: operators require the series to be unique on
``partition_by + order_by`` (aggregate stations to sites first); a site's
window partition then holds at most one row per calendar day, so the largest
task is bounded by the calendar span, not by the table size.

Frames are bounded (at most 30 rows back) or running (unbounded preceding to
current row), both evaluated in one pass by Spark; no frame reaches
``unboundedFollowing``, which Spark re-evaluates per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroseries.functions.scalars import f_to_c, flag

SITE = ("site_id",)


def ordered(partition_by: Sequence[str] = SITE, order_by: str = "date"):
    return Window.partitionBy(*partition_by).orderBy(order_by)


def rows(n: int, partition_by: Sequence[str] = SITE, order_by: str = "date",
         exclude_current: bool = False):
    """Trailing frame of the last ``n`` rows including the current one, or the
    ``n`` rows before it (``exclude_current``: no leak of the day's target)."""
    o = ordered(partition_by, order_by)
    return o.rowsBetween(-n, -1) if exclude_current else o.rowsBetween(-(n - 1), 0)


def fill_calendar(df: DataFrame, partition_by: Sequence[str] = SITE, order_by: str = "date") -> DataFrame:
    """One row per calendar day between each site's first and last day (missing
    days get null measures), so row-based lags and frames become day-based.
    The day list per site is bounded by its calendar span."""
    span = df.groupBy(*partition_by).agg(F.min(order_by).alias("__lo"), F.max(order_by).alias("__hi"))
    days = span.select(*partition_by, F.explode(F.sequence("__lo", "__hi")).alias(order_by))
    return days.join(df, [*partition_by, order_by], "left")


def running(partition_by: Sequence[str] = SITE, order_by: str = "date"):
    return ordered(partition_by, order_by).rowsBetween(Window.unboundedPreceding, 0)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# E1 ---------------------------------------------------------------------------
def lag(c, n: int, partition_by=SITE, order_by="date") -> Column:
    return F.lag(_c(c), n).over(ordered(partition_by, order_by))


def lead(c, n: int = 1, partition_by=SITE, order_by="date") -> Column:
    """Next row's value (label for next-day forecasting)."""
    return F.lead(_c(c), n).over(ordered(partition_by, order_by))


def lag_features(df: DataFrame, cols: dict[str, str], lags: Sequence[int],
                 partition_by=SITE, order_by="date") -> DataFrame:
    """``cols`` maps output prefix -> source column: ``{prefix}_lag_{n}``.
    Columns are created lag-major (all columns of lag 1, then lag 3, ...)."""
    out = {}
    for n in lags:
        for prefix, src in cols.items():
            out[f"{prefix}_lag_{n}"] = lag(src, n, partition_by, order_by)
    return df.withColumns(out)


# E2-E5, E9 --------------------------------------------------------------------
def rolling_mean(c, n: int, min_periods: int = 1, partition_by=SITE, order_by="date",
                 exclude_current: bool = False) -> Column:
    w = rows(n, partition_by, order_by, exclude_current)
    avg = F.avg(_c(c)).over(w)
    if min_periods <= 1:
        return avg
    return F.when(F.count(_c(c)).over(w) >= min_periods, avg)


def rolling_sum(c, n: int, min_periods: int = 1, partition_by=SITE, order_by="date",
                exclude_current: bool = False) -> Column:
    w = rows(n, partition_by, order_by, exclude_current)
    s = F.sum(_c(c)).over(w)
    if min_periods <= 1:
        return s
    return F.when(F.count(_c(c)).over(w) >= min_periods, s)


def rolling_sum_strict(c, n: int = 5, partition_by=SITE, order_by="date") -> Column:
    """Sum only when all ``n`` rows of the frame are present and non-null."""
    return rolling_sum(c, n, n, partition_by, order_by)


def rolling_max(c, n: int, partition_by=SITE, order_by="date") -> Column:
    return F.max(_c(c)).over(rows(n, partition_by, order_by))


def rolling_std(c, n: int, partition_by=SITE, order_by="date") -> Column:
    """Sample std; null with fewer than two non-null values."""
    return F.stddev_samp(_c(c)).over(rows(n, partition_by, order_by))


# E6, E8 -----------------------------------------------------------------------
def diff(c, partition_by=SITE, order_by="date") -> Column:
    return _c(c) - lag(c, 1, partition_by, order_by)


def anomaly(c, n: int = 30, min_periods: int = 1, partition_by=SITE, order_by="date") -> Column:
    return _c(c) - rolling_mean(c, n, min_periods, partition_by, order_by)


# E10 --------------------------------------------------------------------------
def share_of_max(c, n: int = 30, partition_by=SITE, order_by="date") -> Column:
    """current / frame max x 100; 0 when the max is <= 0; null when the frame
    has no value, or when the current value is null and the max is positive."""
    mx = rolling_max(c, n, partition_by, order_by)
    return F.when(mx > 0, _c(c) / mx * 100).when(mx.isNotNull(), F.lit(0.0))


# E11 --------------------------------------------------------------------------
def window_rank_pct(c, n: int = 30, min_periods: int = 7, partition_by=SITE,
                    order_by="date") -> Column:
    """Share (x100) of the frame's rows whose value is >= the current value.

    The denominator counts every row of the frame, nulls included; a null
    current value scores 0; fewer than ``min_periods`` non-null values give null.
    Built from ``n`` offset lags evaluated in one window pass (no per-row arrays).
    """
    cur = _c(c)
    o = ordered(partition_by, order_by)
    hits = flag(cur >= cur)  # the current row itself (0 when null)
    for k in range(1, n):
        hits = hits + flag(F.lag(cur, k).over(o) >= cur)
    frame_rows = F.least(F.row_number().over(o), F.lit(n))
    nn = F.count(cur).over(rows(n, partition_by, order_by))
    return F.when(nn >= min_periods, hits * F.lit(100.0) / frame_rows)


# E12-E14 ----------------------------------------------------------------------
def cumsum_within(c, keys: Sequence, partition_by=SITE, order_by="date") -> Column:
    """Running sum inside ``partition_by + keys``; null rows stay null but do
    not interrupt the sum."""
    w = Window.partitionBy(*partition_by, *keys).orderBy(order_by).rowsBetween(
        Window.unboundedPreceding, 0)
    return F.when(_c(c).isNotNull(), F.sum(_c(c)).over(w))


def ytd_cumsum(c, partition_by=SITE, order_by="date") -> Column:
    return cumsum_within(c, [F.year(order_by)], partition_by, order_by)


def season_cumsum(c, season_col, partition_by=SITE, order_by="date") -> Column:
    """Per (year, season); December continues January-February of its own year."""
    return cumsum_within(c, [F.year(order_by), _c(season_col)], partition_by, order_by)


# E15 --------------------------------------------------------------------------
def frost_event(tmin="TMIN", partition_by=SITE, order_by="date") -> Column:
    return flag((_c(tmin) < 0) & (lag(tmin, 1, partition_by, order_by) >= 0))


def gdd_since_frost(df: DataFrame, gdd_col: str = "GDD", tmin: str = "TMIN",
                    out: str = "GDD_since_frost", partition_by=SITE, order_by="date") -> DataFrame:
    """Running GDD since the last frost event (gaps and islands)."""
    k = "__frost_k"
    df = df.withColumn(k, F.sum(frost_event(tmin, partition_by, order_by)).over(
        running(partition_by, order_by)))
    return df.withColumn(out, cumsum_within(gdd_col, [F.col(k)], partition_by, order_by)).drop(k)


# E16-E19 ----------------------------------------------------------------------
def _streak(df: DataFrame, reset: Column, counted: Column | None, out: str,
            partition_by, order_by) -> DataFrame:
    k = "__streak_k"
    df = df.withColumn(k, F.sum(reset).over(running(partition_by, order_by)))
    w = Window.partitionBy(*partition_by, k).orderBy(order_by)
    if counted is None:
        val = F.row_number().over(w) - 1
    else:
        val = F.sum(counted).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(out, val.cast("int")).drop(k)


def dry_streak(df: DataFrame, prcp: str = "PRCP", out: str = "Consecutive_Dry_Days",
               partition_by=SITE, order_by="date") -> DataFrame:
    """Consecutive rain = 0 rows; any other row, null included, resets."""
    p = F.col(prcp)
    return _streak(df, F.coalesce((p != 0).cast("int"), F.lit(1)), flag(p == 0), out,
                   partition_by, order_by)


def wet_count(df: DataFrame, prcp: str = "PRCP", out: str = "Consecutive_Wet_Days",
              partition_by=SITE, order_by="date") -> DataFrame:
    """Rain > 0 rows since the last rain = 0 row; null neither counts nor resets."""
    p = F.col(prcp)
    return _streak(df, flag(p == 0), flag(p > 0), out, partition_by, order_by)


def days_since_rain_dry(df: DataFrame, prcp: str = "PRCP", out: str = "Days_Since_Rain",
                        partition_by=SITE, order_by="date") -> DataFrame:
    """rain = 0 rows since the last rain > 0 row; null neither counts nor resets."""
    p = F.col(prcp)
    return _streak(df, flag(p > 0), flag(p == 0), out, partition_by, order_by)


def days_since_rain_rows(df: DataFrame, prcp: str = "PRCP", out: str = "Days_Since_Rain",
                         partition_by=SITE, order_by="date") -> DataFrame:
    """Rows since the last rain > 0 row, nulls counted; the first row is 0."""
    p = F.col(prcp)
    return _streak(df, flag(p > 0), None, out, partition_by, order_by)


# B16 / E20 --------------------------------------------------------------------
def edge_impute(c, partition_by=SITE, order_by="date") -> Column:
    """Backfill from the next non-null row, then 0.  Evaluated as a running
    ``last(ignorenulls)`` in reverse order, which Spark computes in one pass."""
    rev = Window.partitionBy(*partition_by).orderBy(F.col(order_by).desc()).rowsBetween(
        Window.unboundedPreceding, 0)
    return F.coalesce(_c(c), F.last(_c(c), ignorenulls=True).over(rev), F.lit(0.0))


def lag_roll_bundle(df: DataFrame, cols: Sequence[str], lags: Sequence[int] = (1, 2, 3),
                    window: int = 7, partition_by=SITE, order_by="date") -> DataFrame:
    """Lags, rolling mean and rolling std (null std is 0) for each column, then
    every column (inputs included) is backfilled and zero-filled."""
    new = {}
    for c in cols:
        for n in lags:
            new[f"{c}_lag{n}"] = lag(c, n, partition_by, order_by)
        new[f"{c}_roll_mean{window}"] = rolling_mean(c, window, 1, partition_by, order_by)
        new[f"{c}_roll_std{window}"] = F.coalesce(rolling_std(c, window, partition_by, order_by),
                                                  F.lit(0.0))
    df = df.withColumns(new)
    fill = list(cols) + list(new)
    return df.withColumns({c: edge_impute(c, partition_by, order_by) for c in fill})


# E21 --------------------------------------------------------------------------
def trailing_arrays(df: DataFrame, temp="TAVG", rain="PRCP", wind="AWND",
                    n_temp: int = 30, n_rain: int = 90, n_wind: int = 30,
                    partition_by=SITE, order_by="date") -> DataFrame:
    """Per day, the arrays of earlier values (current day excluded) that form a
    scoring request's history: up to 30 temperatures, 90 rain values, 30 winds.
    Missing values are left out of the arrays."""
    o = ordered(partition_by, order_by)
    return df.withColumns({
        "historical_temps": F.collect_list(_c(temp)).over(o.rowsBetween(-n_temp, -1)),
        "historical_precip": F.collect_list(_c(rain)).over(o.rowsBetween(-n_rain, -1)),
        "historical_wind": F.collect_list(_c(wind)).over(o.rowsBetween(-n_wind, -1)),
    })


# E22 --------------------------------------------------------------------------
def forecast_lags(df: DataFrame, lags: Sequence[int] = (1, 2, 3, 7), request: str = "request_id",
                  pos: str = "pos") -> DataFrame:
    """Inside one forecast, lag k of a day comes from the forecast's earlier days
    (the average temperature stands in for the maximum), converted to metric
    units; days without k earlier days use their own value.  Expects
    ``temp_avg_f`` (filled), ``temp_max_c``, ``precipitation`` (in), ``wind_mph``
    (filled) and the metric ``PRCP`` (mm), ``AWND`` (km/h) of the day."""
    o = Window.partitionBy(request).orderBy(pos)
    out = {}
    for k in lags:
        out[f"TMAX_lag_{k}"] = F.coalesce(f_to_c(F.lag("temp_avg_f", k).over(o)), F.col("TMAX"))
        out[f"PRCP_lag_{k}"] = F.coalesce(F.lag("precipitation", k).over(o) * F.lit(25.4),
                                          F.col("PRCP"))
        out[f"AWND_lag_{k}"] = F.coalesce(F.lag("wind_mph", k).over(o) * F.lit(1.609), F.col("AWND"))
    return df.withColumns(out)
