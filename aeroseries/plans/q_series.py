"""Queries for window operators (E) and sorts / top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeroseries.functions import scalars as S
from aeroseries.operators import features as H
from aeroseries.operators import rank as R
from aeroseries.operators import windows as W
from aeroseries.plans import sqlgen as Q
from aeroseries.plans.catalog import query
from aeroseries.plans.views_sql import with_views
from aeroseries.sources import fixtures as FX

WS = ("weather_site",)


def _ws(spark, sf_dir):
    return FX.weather_site(spark, sf_dir)


# E1 ---------------------------------------------------------------------------
@query("lag_features", "E1", with_views(
    "SELECT site_id, date, " + ", ".join(
        f"{Q.lag(c, n)} AS {c}_lag_{n}" for n in (1, 3, 7) for c in ("TMAX", "PRCP")) + " FROM weather_site",
    *WS))
def q_lags(spark, sf_dir):
    w = _ws(spark, sf_dir)
    return W.lag_features(w, {"TMAX": "TMAX", "PRCP": "PRCP"}, (1, 3, 7)).drop("TMIN", "TAVG", "PRCP", "AWND",
                                                                                 "TMAX")


# E2, E3, E5, E9 -----------------------------------------------------------------
@query("rolling_stats", "E2,E3,E5,E9", with_views(f"""
SELECT site_id, date,
       {Q.rolling_mean('TAVG', 7)} AS tavg_mean_7, {Q.rolling_mean('TAVG', 30)} AS tavg_mean_30,
       {Q.rolling_sum('PRCP', 3)} AS prcp_sum_3, {Q.rolling_sum('PRCP', 14)} AS prcp_sum_14,
       {Q.rolling_mean('TAVG', 30, 7)} AS tavg_mean_30_min7,
       max(PRCP) OVER {Q.rows(7)} AS prcp_max_7
FROM weather_site""", *WS))
def q_rolling(spark, sf_dir):
    w = _ws(spark, sf_dir)
    return w.select("site_id", "date",
                    W.rolling_mean("TAVG", 7).alias("tavg_mean_7"), W.rolling_mean("TAVG", 30).alias("tavg_mean_30"),
                    W.rolling_sum("PRCP", 3).alias("prcp_sum_3"), W.rolling_sum("PRCP", 14).alias("prcp_sum_14"),
                    W.rolling_mean("TAVG", 30, 7).alias("tavg_mean_30_min7"),
                    W.rolling_max("PRCP", 7).alias("prcp_max_7"))


# E4 ---------------------------------------------------------------------------
@query("rolling_sum_strict", "E4", with_views(
    f"SELECT site_id, date, {Q.rolling_sum('PRCP', 5, 5)} AS prcp_sum_5_strict FROM weather_site", *WS))
def q_rolling_strict(spark, sf_dir):
    return _ws(spark, sf_dir).select("site_id", "date", W.rolling_sum_strict("PRCP", 5).alias("prcp_sum_5_strict"))


# E6-E8 ------------------------------------------------------------------------
@query("diff_volatility_anomaly", "E6,E7,E8", with_views(f"""
SELECT site_id, date, chg AS TAVG_change, stddev_samp(chg) OVER {Q.rows(7)} AS volatility_7,
       TAVG - {Q.rolling_mean('TAVG', 30)} AS anomaly_30, TAVG - {Q.rolling_mean('TAVG', 30, 7)} AS anomaly_30_min7
FROM (SELECT *, TAVG - {Q.lag('TAVG', 1)} AS chg FROM weather_site) t""", *WS))
def q_dynamics(spark, sf_dir):
    w = _ws(spark, sf_dir).withColumn("TAVG_change", W.diff("TAVG"))
    return w.select("site_id", "date", "TAVG_change", W.rolling_std("TAVG_change", 7).alias("volatility_7"),
                    W.anomaly("TAVG", 30).alias("anomaly_30"), W.anomaly("TAVG", 30, 7).alias("anomaly_30_min7"))


# E10, E11 ---------------------------------------------------------------------
_RANK_HITS = " + ".join(
    ["cast(coalesce(AWND >= AWND, false) AS integer)"]
    + [f"cast(coalesce(lag(AWND, {k}) OVER (PARTITION BY site_id ORDER BY date) >= AWND, false) AS integer)"
       for k in range(1, 30)])


@query("share_and_rank", "E10,E11", with_views(f"""
SELECT site_id, date,
       CASE WHEN max(AWND) OVER {Q.rows(30)} > 0 THEN AWND / max(AWND) OVER {Q.rows(30)} * 100
            WHEN max(AWND) OVER {Q.rows(30)} IS NOT NULL THEN 0.0E0 END AS AWND_30d_pct,
       CASE WHEN count(AWND) OVER {Q.rows(30)} >= 7
            THEN ({_RANK_HITS}) * 100.0E0 / least(row_number() OVER (PARTITION BY site_id ORDER BY date), 30) END
         AS Wind_Percentile
FROM weather_site""", *WS))
def q_share_rank(spark, sf_dir):
    return _ws(spark, sf_dir).select("site_id", "date", W.share_of_max("AWND", 30).alias("AWND_30d_pct"),
                                     W.window_rank_pct("AWND", 30, 7).alias("Wind_Percentile"))


# E12-E14 ----------------------------------------------------------------------
@query("running_sums", "E12,E13,E14", with_views(f"""
SELECT site_id, date,
       {Q.cumsum_within('PRCP', 'site_id, year(date)')} AS PRCP_YTD,
       {Q.cumsum_within('PRCP', 'site_id, year(date), ' + Q.season('month(date)'))} AS PRCP_season,
       {Q.cumsum_within(Q.gdd('TAVG', 5), 'site_id, year(date)')} AS GDD_cumsum,
       {Q.cumsum_within(Q.gdd('TAVG', 10), 'site_id, year(date)')} AS GDD_Grass_cumsum,
       {Q.cumsum_within(Q.gdd('TAVG', 8), 'site_id, year(date)')} AS GDD_Weed_cumsum
FROM weather_site""", *WS))
def q_running(spark, sf_dir):
    w = _ws(spark, sf_dir).withColumns({"season": S.season(F.month("date")),
                                        "g5": S.gdd(F.col("TAVG"), 5), "g10": S.gdd(F.col("TAVG"), 10),
                                        "g8": S.gdd(F.col("TAVG"), 8)})
    return w.select("site_id", "date", W.ytd_cumsum("PRCP").alias("PRCP_YTD"),
                    W.season_cumsum("PRCP", "season").alias("PRCP_season"),
                    W.ytd_cumsum("g5").alias("GDD_cumsum"), W.ytd_cumsum("g10").alias("GDD_Grass_cumsum"),
                    W.ytd_cumsum("g8").alias("GDD_Weed_cumsum"))


# E15 --------------------------------------------------------------------------
@query("gdd_since_frost", "E15", with_views(f"""
SELECT site_id, date, Frost_Event, {Q.cumsum_within('GDD', 'site_id, k')} AS GDD_since_frost
FROM (SELECT *, sum(Frost_Event) OVER {Q.running()} AS k FROM (
        SELECT site_id, date, {Q.gdd('TAVG', 5)} AS GDD,
               {Q.flag('TMIN < 0 AND ' + Q.lag('TMIN', 1) + ' >= 0')} AS Frost_Event
        FROM weather_site) a) b""", *WS))
def q_frost(spark, sf_dir):
    w = _ws(spark, sf_dir).withColumns({"GDD": S.gdd(F.col("TAVG"), 5), "Frost_Event": W.frost_event("TMIN")})
    return W.gdd_since_frost(w, "GDD", "TMIN").select("site_id", "date", "Frost_Event", "GDD_since_frost")


# E16-E19 ----------------------------------------------------------------------
def _streak_sql(reset: str, counted: str | None, out: str) -> str:
    val = ("row_number() OVER (PARTITION BY site_id, k ORDER BY date) - 1" if counted is None
           else f"sum({counted}) OVER {Q.running('site_id, k')}")
    return (f"SELECT site_id, date, cast({val} AS integer) AS {out} FROM "
            f"(SELECT *, sum({reset}) OVER {Q.running()} AS k FROM weather_site) t")


_STREAKS = [
    ("dry_streak", "E16", W.dry_streak, "coalesce(cast(PRCP <> 0 AS integer), 1)", Q.flag("PRCP = 0")),
    ("wet_count", "E17", W.wet_count, Q.flag("PRCP = 0"), Q.flag("PRCP > 0")),
    ("days_since_rain_dry", "E18", W.days_since_rain_dry, Q.flag("PRCP > 0"), Q.flag("PRCP = 0")),
    ("days_since_rain_rows", "E19", W.days_since_rain_rows, Q.flag("PRCP > 0"), None),
]
for _name, _op, _fn, _reset, _cnt in _STREAKS:
    def _q(spark, sf_dir, _fn=_fn, _name=_name):
        return _fn(_ws(spark, sf_dir), "PRCP", _name).select("site_id", "date", _name)
    query(_name, _op, with_views(_streak_sql(_reset, _cnt, _name), *WS))(_q)


# E20 --------------------------------------------------------------------------
def _bundle_sql():
    gen = []
    for c in ("TMAX", "PRCP"):
        for n in (1, 2, 3):
            gen.append((f"{c}_lag{n}", Q.lag(c, n)))
        gen.append((f"{c}_roll_mean7", Q.rolling_mean(c, 7)))
        gen.append((f"{c}_roll_std7", f"coalesce(stddev_samp({c}) OVER {Q.rows(7)}, 0.0E0)"))
    inner = ", ".join(f"{e} AS {n}" for n, e in gen)
    cols = ["TMAX", "PRCP"] + [n for n, _ in gen]
    outer = ", ".join(
        f"coalesce({c}, first_value({c} IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY date ROWS BETWEEN "
        f"CURRENT ROW AND UNBOUNDED FOLLOWING), 0.0E0) AS {c}" for c in cols)
    return f"SELECT site_id, date, {outer} FROM (SELECT site_id, date, TMAX, PRCP, {inner} FROM weather_site) t"


@query("lag_roll_bundle", "E20", with_views(_bundle_sql(), *WS))
def q_bundle(spark, sf_dir):
    w = _ws(spark, sf_dir).select("site_id", "date", "TMAX", "PRCP")
    return W.lag_roll_bundle(w, ["TMAX", "PRCP"], (1, 2, 3), 7)


# E21 --------------------------------------------------------------------------
def _arr_sql(c, n, name):
    lst = (f"list_filter(list({c}) OVER (PARTITION BY site_id ORDER BY date ROWS BETWEEN {n} PRECEDING AND "
           f"1 PRECEDING), lambda x: x IS NOT NULL)")
    return (f"coalesce(len({lst}), 0) AS {name}_n, coalesce(list_sum({lst}), 0.0E0) AS {name}_sum, "
            f"{lst}[-1] AS {name}_last")


@query("trailing_arrays", "E21", with_views(
    f"SELECT site_id, date, {_arr_sql('TAVG', 30, 'temps')}, {_arr_sql('PRCP', 90, 'precip')}, "
    f"{_arr_sql('AWND', 30, 'wind')} FROM weather_site", *WS))
def q_trailing(spark, sf_dir):
    t = W.trailing_arrays(_ws(spark, sf_dir))
    out = ["site_id", "date"]
    for a, name in (("historical_temps", "temps"), ("historical_precip", "precip"), ("historical_wind", "wind")):
        out += [F.size(a).cast("bigint").alias(f"{name}_n"),
                F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x).alias(f"{name}_sum"),
                F.try_element_at(a, F.lit(-1)).alias(f"{name}_last")]
    return t.select(*out)


# E22 --------------------------------------------------------------------------
def _fl_sql():
    parts = []
    for k in (1, 2, 3, 7):
        lw = f"OVER (PARTITION BY request_id ORDER BY pos)"
        parts.append(f"coalesce({Q.f_to_c(f'lag(temp_avg_f, {k}) {lw}')}, TMAX) AS TMAX_lag_{k}")
        parts.append(f"coalesce(lag(precipitation, {k}) {lw} * 25.4E0, PRCP) AS PRCP_lag_{k}")
        parts.append(f"coalesce(lag(wind_mph, {k}) {lw} * 1.609E0, AWND) AS AWND_lag_{k}")
    return f"""
SELECT request_id, pos, {', '.join(parts)} FROM (
  SELECT request_id, pos, temp_avg_f, precipitation, wind_mph, {Q.f_to_c('temp_max')} AS TMAX,
         precipitation * 25.4E0 AS PRCP, wind_mph * 1.609E0 AS AWND
  FROM (SELECT *, coalesce(temp_avg, (temp_max + temp_min) / 2) AS temp_avg_f,
               coalesce(nullif(wind_speed, 0.0E0), 5.0E0) AS wind_mph FROM requests) r) t"""


@query("forecast_lags", "E22", with_views(_fl_sql(), "requests"))
def q_forecast_lags(spark, sf_dir):
    r = H.request_inputs(FX.requests(spark, sf_dir))
    out = W.forecast_lags(r)
    return out.select("request_id", "pos", *[f"{c}_lag_{k}" for k in (1, 2, 3, 7) for c in ("TMAX", "PRCP", "AWND")])


# E23 --------------------------------------------------------------------------
@query("next_day_target", "E23", with_views(
    "SELECT site_id, date, Total_Pollen, lead(Total_Pollen, 1) OVER (PARTITION BY site_id ORDER BY date) "
    "AS next_day_pollen FROM joined", "joined"))
def q_next_day(spark, sf_dir):
    j = FX.joined(spark, sf_dir)
    return j.select("site_id", "date", "Total_Pollen", W.lead("Total_Pollen").alias("next_day_pollen"))


# F1 ---------------------------------------------------------------------------
@query("time_order", "F1", with_views("SELECT * FROM weather_site", *WS))
def q_time_order(spark, sf_dir):
    return R.time_order(_ws(spark, sf_dir))


# F5 ---------------------------------------------------------------------------
@query("last_n", "F5", with_views("""
SELECT site_id, date, actual, predicted FROM (
  SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY date DESC) AS r FROM predictions) t WHERE r <= 100""",
    "predictions"))
def q_last_n(spark, sf_dir):
    return R.last_n(FX.predictions(spark, sf_dir), 100)


# F6 ---------------------------------------------------------------------------
@query("first_per_month", "F6", with_views("""
SELECT site_id, date, Total_Pollen, TMAX, TMIN, PRCP FROM (
  SELECT *, row_number() OVER (PARTITION BY site_id, year(date), month(date) ORDER BY date) AS r
  FROM joined WHERE month(date) IN (3, 6, 9)) t WHERE r = 1""", "joined"))
def q_first_per_month(spark, sf_dir):
    j = FX.joined(spark, sf_dir).select("site_id", "date", "Total_Pollen", "TMAX", "TMIN", "PRCP")
    return R.first_per_month(j)


# E1 on calendar days -----------------------------------------
@query("calendar_day_lags", "E1", with_views("""
SELECT d.site_id, d.date, w.TMAX, lag(w.TMAX, 1) OVER (PARTITION BY d.site_id ORDER BY d.date) AS TMAX_prev_day,
       lag(w.PRCP, 7) OVER (PARTITION BY d.site_id ORDER BY d.date) AS PRCP_week_ago
FROM (SELECT site_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS date) AS date
      FROM (SELECT site_id, min(date) AS lo, max(date) AS hi FROM weather_site GROUP BY site_id) s) d
LEFT JOIN weather_site w ON d.site_id = w.site_id AND d.date = w.date""", *WS))
def q_calendar_lags(spark, sf_dir):
    w = W.fill_calendar(_ws(spark, sf_dir).select("site_id", "date", "TMAX", "PRCP"))
    return w.select("site_id", "date", "TMAX", W.lag("TMAX", 1).alias("TMAX_prev_day"),
                    W.lag("PRCP", 7).alias("PRCP_week_ago"))


# E2 without the current day --------------------------------
@query("rolling_exclude_current", "E2,E3", with_views("""
SELECT site_id, date,
       avg(Total_Pollen) OVER (PARTITION BY site_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
         AS pollen_prior_mean_7,
       sum(PRCP) OVER (PARTITION BY site_id ORDER BY date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
         AS prcp_prior_sum_3
FROM joined""", "joined"))
def q_rolling_exclude(spark, sf_dir):
    j = FX.joined(spark, sf_dir)
    return j.select("site_id", "date",
                    W.rolling_mean("Total_Pollen", 7, exclude_current=True).alias("pollen_prior_mean_7"),
                    W.rolling_sum("PRCP", 3, exclude_current=True).alias("prcp_prior_sum_3"))
