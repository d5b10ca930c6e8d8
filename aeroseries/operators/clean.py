"""Projections, filters and cleaning.

Unit rules decide from a whole-table (or per-site) statistic.  The statistic is
one aggregate job: globally a one-row table attached with a broadcast cross
join (size bound: one row); per site a grouped table joined on the site key
(planner picks broadcast or shuffle from its size).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroseries.functions import scalars as S

KEY_VARIABLES = ["STATION", "NAME", "DATE", "TMAX", "TMIN", "TAVG", "PRCP", "AWND", "WSF2", "WSF5"]
TEMPERATURE_VARS = ["TMAX", "TMIN", "TAVG"]
WIND_VARS = ["AWND", "WSF2", "WSF5"]


def available(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """A4: the given columns that exist, in the given order (metadata only)."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*available(df, cols))


# B1 ---------------------------------------------------------------------------
def filter_station(df: DataFrame, station: str, col: str = "STATION", check: bool = True) -> DataFrame:
    """Keep one station; with ``check`` a one-row probe raises when none matches."""
    out = df.filter(F.col(col) == F.lit(station))
    if check and not out.limit(1).take(1):
        raise ValueError(f"station {station!r} not found")
    return out


# B2 ---------------------------------------------------------------------------
def select_key_variables(df: DataFrame, extra: Sequence[str] = ("TAVG_calculated",)) -> DataFrame:
    return df.select(*available(df, KEY_VARIABLES + list(extra)))


# B3 ---------------------------------------------------------------------------
def search_stations(df: DataFrame, pattern: str) -> DataFrame:
    """Distinct (STATION, NAME) whose name matches the case-insensitive regex."""
    return (df.select("STATION", "NAME").filter(F.col("NAME").rlike(f"(?i){pattern}"))
            .distinct())


# C8-style statistic attachment -------------------------------------------------
def attach_stats(df: DataFrame, stats: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Attach whole-table (``by=()``) or per-group statistics to every row."""
    if not by:
        one = df.agg(*[c.alias(n) for n, c in stats.items()])
        return df.crossJoin(F.broadcast(one))
    grp = df.groupBy(*by).agg(*[c.alias(n) for n, c in stats.items()])
    return df.join(grp, list(by), "left")


def _convert_if(df: DataFrame, cols: Sequence[str], stat, test, convert, by) -> DataFrame:
    cols = available(df, cols)
    if not cols:
        return df
    stats = {f"__s_{c}": stat(F.col(c)) for c in cols}
    df = attach_stats(df, stats, by)
    df = df.withColumns({c: F.when(F.coalesce(test(F.col(f"__s_{c}")), F.lit(False)),
                                   convert(F.col(c))).otherwise(F.col(c)) for c in cols})
    return df.drop(*stats.keys())


# B4 ---------------------------------------------------------------------------
def fix_temperature_unit(df: DataFrame, cols: Sequence[str] = TEMPERATURE_VARS,
                         threshold: float = 30.0, by: Sequence[str] = ()) -> DataFrame:
    """Per column: if the mean of its non-null values exceeds ``threshold``
    the column is Fahrenheit and becomes Celsius (profiling variant: 50)."""
    return _convert_if(df, cols, F.avg, lambda m: m > threshold, S.f_to_c, by)


# B5 ---------------------------------------------------------------------------
def fix_wind_unit(df: DataFrame, cols: Sequence[str] = WIND_VARS, threshold: float = 20.0,
                  by: Sequence[str] = ()) -> DataFrame:
    """Mean above ``threshold``: mph to m/s (profiling variant: 10, AWND only)."""
    return _convert_if(df, cols, F.avg, lambda m: m > threshold, S.mph_to_ms, by)


# B6 ---------------------------------------------------------------------------
def fix_precip_unit(df: DataFrame, col: str = "PRCP", threshold: float = 20.0,
                    by: Sequence[str] = ()) -> DataFrame:
    """Maximum below ``threshold``: inches to mm."""
    return _convert_if(df, [col], F.max, lambda m: m < threshold, S.inch_to_mm, by)


# B7 ---------------------------------------------------------------------------
def fill_tavg(df: DataFrame) -> DataFrame:
    """Null TAVG with both extremes becomes their midpoint; TAVG_calculated is
    always emitted (True on filled rows)."""
    if not {"TAVG", "TMAX", "TMIN"} <= set(df.columns):
        return df
    can = F.col("TAVG").isNull() & F.col("TMAX").isNotNull() & F.col("TMIN").isNotNull()
    return df.withColumns({
        "TAVG": F.when(can, (F.col("TMAX") + F.col("TMIN")) / 2).otherwise(F.col("TAVG")),
        "TAVG_calculated": F.coalesce(can, F.lit(False)),
    })


def clean_weather(df: DataFrame, by: Sequence[str] = (), temp_threshold: float = 30.0,
                  wind_threshold: float = 20.0, precip_threshold: float = 20.0) -> DataFrame:
    """The cleaning sequence: temperatures, TAVG fill, wind, precipitation.

    Every unit rule looks at its own raw column, so all statistics come from
    one aggregate pass attached once (not one pass per rule)."""
    temps, winds = available(df, TEMPERATURE_VARS), available(df, WIND_VARS)
    has_p = "PRCP" in df.columns
    stats = {f"__s_{c}": F.avg(c) for c in temps + winds}
    if has_p:
        stats["__s_PRCP"] = F.max("PRCP")
    if not stats:
        return fill_tavg(df)
    df = attach_stats(df, stats, by)

    def conv(c, test, fn):
        return F.when(F.coalesce(test(F.col(f"__s_{c}")), F.lit(False)), fn(F.col(c))).otherwise(F.col(c))

    df = df.withColumns({c: conv(c, lambda m: m > temp_threshold, S.f_to_c) for c in temps})
    df = fill_tavg(df)
    upd = {c: conv(c, lambda m: m > wind_threshold, S.mph_to_ms) for c in winds}
    if has_p:
        upd["PRCP"] = conv("PRCP", lambda m: m < precip_threshold, S.inch_to_mm)
    return df.withColumns(upd).drop(*stats.keys())


# B8 ---------------------------------------------------------------------------
def filter_overlap(df: DataFrame, overlap: DataFrame, date_col: str = "date",
                   by: Sequence[str] = ()) -> DataFrame:
    """Keep rows inside [overlap_start, overlap_end] (inclusive).  ``overlap`` is
    the one-row (or per-``by``) result of ``joins.date_overlap``."""
    o = overlap.select(*by, "overlap_start", "overlap_end")
    j = df.crossJoin(F.broadcast(o)) if not by else df.join(o, list(by))
    return (j.filter(F.col(date_col).between(F.col("overlap_start"), F.col("overlap_end")))
            .drop("overlap_start", "overlap_end"))


# B9 ---------------------------------------------------------------------------
def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(cols))


# B10 --------------------------------------------------------------------------
def align_features(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the model's columns in order; absent ones are 0; extras dropped."""
    have = set(df.columns)
    cols = [F.col(c) for c in keep]
    cols += [F.col(n).cast("double").alias(n) if n in have else F.lit(0.0).alias(n) for n in names]
    return df.select(*cols)


# B11 --------------------------------------------------------------------------
def quality_checks(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One-pass checks over the joined table; rows (by..., check, value, ok).

    Temperatures: min >= -40 and max <= 45 per column; TMAX >= TMIN and
    TMIN <= TAVG <= TMAX on every row (a null makes the row fail, value = the
    number of failing rows); PRCP: count of negative values; winds: max <= 50.
    """
    have = set(df.columns)
    aggs, rows_ = [], []
    for c in [x for x in TEMPERATURE_VARS if x in have]:
        aggs += [F.min(c).cast("double").alias(f"{c}_min"), F.max(c).cast("double").alias(f"{c}_max")]
        rows_ += [(f"{c}_min", f"{c}_min", f"{c}_min >= -40"), (f"{c}_max", f"{c}_max", f"{c}_max <= 45")]
    if {"TMAX", "TMIN", "TAVG"} <= have:
        tmax, tmin, tavg = F.col("TMAX"), F.col("TMIN"), F.col("TAVG")
        aggs += [F.count_if(~F.coalesce(tmax >= tmin, F.lit(False))).cast("double").alias("c_mm"),
                 F.count_if(~F.coalesce((tavg >= tmin) & (tavg <= tmax), F.lit(False)))
                 .cast("double").alias("c_avg")]
        rows_ += [("TMAX_ge_TMIN", "c_mm", "c_mm = 0"), ("TMIN_le_TAVG_le_TMAX", "c_avg", "c_avg = 0")]
    if "PRCP" in have:
        aggs.append(F.count_if(F.col("PRCP") < 0).cast("double").alias("c_neg"))
        rows_.append(("PRCP_negative", "c_neg", "c_neg = 0"))
    for c in [x for x in WIND_VARS if x in have]:
        aggs.append(F.max(c).cast("double").alias(f"{c}_max"))
        rows_.append((f"{c}_max", f"{c}_max", f"coalesce({c}_max <= 50, true)"))
    g = df.groupBy(*by).agg(*aggs)
    body = ", ".join(f"'{n}', {v}, {ok}" for n, v, ok in rows_)
    return g.select(*by, F.expr(f"stack({len(rows_)}, {body}) AS (check, value, ok)"))


# B12 --------------------------------------------------------------------------
def validate_requests(df: DataFrame, require_max_ge_min: bool = True) -> DataFrame:
    """Request checks: temperatures in [-50, 150], rain >= 0, wind >= 0, date
    and extremes present (the app also rejects max < min).  Adds
    ``is_valid`` and ``reasons`` (array of failed checks)."""
    tmax, tmin, tavg = F.col("temp_max"), F.col("temp_min"), F.col("temp_avg")
    rain, wind = F.col("precipitation"), F.col("wind_speed")

    def bad_range(c):
        return c.isNotNull() & ((c < -50) | (c > 150))

    checks = [
        ("date_missing", F.col("date").isNull()),
        ("temp_max_missing", tmax.isNull()),
        ("temp_min_missing", tmin.isNull()),
        ("temp_max_range", bad_range(tmax)),
        ("temp_min_range", bad_range(tmin)),
        ("temp_avg_range", bad_range(tavg)),
        ("precipitation_negative", F.coalesce(rain < 0, F.lit(False))),
        ("wind_negative", F.coalesce(wind < 0, F.lit(False))),
    ]
    if require_max_ge_min:
        checks.append(("max_below_min", F.coalesce(tmax < tmin, F.lit(False))))
    reasons = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks]))
    return df.withColumn("reasons", reasons).withColumn("is_valid", F.size("reasons") == 0)


def split_requests(df: DataFrame, require_max_ge_min: bool = True) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): the valid rows as they are, and the rejected rows with
    their ``reasons``; no row is lost."""
    v = validate_requests(df, require_max_ge_min)
    return v.filter("is_valid").drop("is_valid", "reasons"), v.filter("not is_valid").drop("is_valid")


# B13 --------------------------------------------------------------------------
def select_by_pattern(columns: Sequence[str], literal: Sequence[str] = (),
                      contains: Sequence[str] = (), ban: str | None = None) -> list[str]:
    """Feature list: literal names, then names containing any pattern (in
    column order), optional ban on a substring; duplicates kept as listed."""
    out = [c for c in literal if c in columns]
    for pat in contains:
        out += [c for c in columns if pat in c]
    if ban:
        out = [c for c in out if ban not in c]
    return out


# B15 --------------------------------------------------------------------------
def suffix_collisions(right: DataFrame, left_cols: Sequence[str], keys: Sequence[str],
                      suffix: str = "_weather") -> DataFrame:
    """Rename right-hand columns that collide with the left side (keys excepted)."""
    clash = [c for c in right.columns if c in set(left_cols) and c not in set(keys)]
    return right.withColumnsRenamed({c: c + suffix for c in clash})


# B17 re-exported ---------------------------------------------------------------
clip = S.clip
