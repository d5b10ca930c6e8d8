"""Queries for profiling aggregates (D) and model-comparison tables (D, F3, F4, C7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeroseries.functions import scalars as S
from aeroseries.operators import clean as B
from aeroseries.operators import joins as C
from aeroseries.operators import metrics as M
from aeroseries.operators import profile as D
from aeroseries.operators import rank as R
from aeroseries.plans.catalog import query
from aeroseries.plans.views_sql import with_views
from aeroseries.sources import fixtures as FX

VARS = ["TMAX", "TMIN", "TAVG", "PRCP", "AWND"]


def _union(parts):
    return "\nUNION ALL ".join(parts)


# D1 ---------------------------------------------------------------------------
@query("profile", "D1", with_views("""
SELECT count(*) AS rows, min(DATE) AS date_min, max(DATE) AS date_max, count(DISTINCT STATION) AS stations
FROM weather_raw""", "weather_raw"))
def q_profile(spark, sf_dir):
    return D.profile(FX.weather_raw(spark, sf_dir))


# D2 ---------------------------------------------------------------------------
@query("station_counts_top10", "D2", with_views("""
SELECT STATION, count(*) AS records FROM weather_raw GROUP BY STATION
ORDER BY records DESC, STATION ASC LIMIT 10""", "weather_raw"))
def q_station_counts(spark, sf_dir):
    return D.station_counts(FX.weather_raw(spark, sf_dir), 10)


# D3 ---------------------------------------------------------------------------
@query("station_summary", "D3", with_views("""
SELECT 'STN000001' AS station, min(CASE WHEN STATION = 'STN000001' THEN NAME END) AS name,
       cast(count_if(STATION = 'STN000001') AS bigint) AS records,
       min(CASE WHEN STATION = 'STN000001' THEN DATE END) AS date_min,
       max(CASE WHEN STATION = 'STN000001' THEN DATE END) AS date_max,
       count_if(STATION = 'STN000001') * 100.0E0 / count(*) AS share_pct
FROM weather_raw""", "weather_raw"))
def q_station_summary(spark, sf_dir):
    return D.station_summary(FX.weather_raw(spark, sf_dir), "STN000001")


# D4 ---------------------------------------------------------------------------
def _compl_sql(src, by=""):
    sel = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    return _union([f"SELECT {sel}'{v}' AS variable, count({v}) * 100.0E0 / count(*) AS pct FROM {src}{grp}"
                   for v in VARS])


@query("completeness", "D4", with_views(_compl_sql("weather_raw", "site_id"), "weather_raw"))
def q_completeness(spark, sf_dir):
    return D.completeness(FX.weather_raw(spark, sf_dir), by=("site_id",))


@query("completeness_change", "D4", with_views(f"""
SELECT coalesce(b.variable, a.variable) AS variable, b.pct AS pct_before, a.pct AS pct_after,
       a.pct - b.pct AS change
FROM ({_compl_sql('weather_raw')}) b FULL OUTER JOIN ({_compl_sql('filled')}) a ON a.variable = b.variable""",
    "weather_raw", extra=[("filled", """
SELECT STATION, DATE, TMAX, TMIN, PRCP, AWND,
       CASE WHEN TAVG IS NULL AND TMAX IS NOT NULL AND TMIN IS NOT NULL THEN (TMAX + TMIN) / 2 ELSE TAVG END AS TAVG
FROM weather_raw""")]))
def q_completeness_change(spark, sf_dir):
    w = FX.weather_raw(spark, sf_dir)
    return D.completeness_change(w, B.fill_tavg(w)).select("variable", "pct_before", "pct_after", "change")


# D5 ---------------------------------------------------------------------------
@query("daily_completeness", "D5", with_views(_union([
    f"SELECT '{v}' AS variable, avg(p) AS pct FROM (SELECT DATE, count({v}) * 100.0E0 / count(*) AS p "
    f"FROM weather_raw GROUP BY DATE) t" for v in VARS]), "weather_raw"))
def q_daily_completeness(spark, sf_dir):
    return D.daily_completeness(FX.weather_raw(spark, sf_dir))


# D6 ---------------------------------------------------------------------------
_D6 = with_views(f"""
SELECT variable, target_pct, all_pct, strategy,
       CASE WHEN count_if(strategy LIKE 'single%') OVER () > count_if(strategy LIKE 'aggregate%') OVER ()
            THEN 'single' ELSE 'aggregate' END AS overall
FROM (
  SELECT coalesce(t.variable, a.variable) AS variable, t.pct AS target_pct, a.pct AS all_pct,
         CASE WHEN coalesce(t.pct, 0) >= 80 THEN 'single' WHEN coalesce(a.pct, 0) >= 80 THEN 'aggregate'
              WHEN coalesce(t.pct, 0) > coalesce(a.pct, 0) THEN 'single_limited'
              ELSE 'aggregate_limited' END AS strategy
  FROM ({_compl_sql('one')}) t FULL OUTER JOIN (
    {_union([f"SELECT '{v}' AS variable, avg(p) AS pct FROM (SELECT DATE, count({v}) * 100.0E0 / count(*) AS p FROM weather_raw GROUP BY DATE) x" for v in VARS])}
  ) a ON t.variable = a.variable
) s""", "weather_raw", extra=[("one", "SELECT * FROM weather_raw WHERE STATION = 'STN000001'")])


@query("recommend_strategy", "D6", _D6)
def q_recommend(spark, sf_dir):
    w = FX.weather_raw(spark, sf_dir)
    tgt = D.completeness(B.filter_station(w, "STN000001", check=False))
    r = D.recommend_strategy(tgt, D.daily_completeness(w))
    return r.select("variable", "target_pct", "all_pct", "strategy", "overall")


# D7 ---------------------------------------------------------------------------
@query("aggregate_stations", "D7", with_views("""
SELECT site_id, DATE AS date, avg(TMAX) AS TMAX, avg(TMIN) AS TMIN, avg(TAVG) AS TAVG, avg(PRCP) AS PRCP,
       avg(AWND) AS AWND FROM weather_raw GROUP BY site_id, DATE""", "weather_raw"))
def q_aggregate_stations(spark, sf_dir):
    return D.aggregate_stations(FX.weather_raw(spark, sf_dir))


# D8 ---------------------------------------------------------------------------
@query("range_stats", "D8", with_views(_union([
    f"SELECT site_id, '{v}' AS variable, cast(min({v}) AS double) AS min, cast(max({v}) AS double) AS max, "
    f"avg({v}) AS mean FROM joined GROUP BY site_id" for v in VARS]), "joined"))
def q_range_stats(spark, sf_dir):
    return D.range_stats(FX.joined(spark, sf_dir), by=("site_id",))


# D9 ---------------------------------------------------------------------------
@query("duplicate_dates", "D9", with_views("""
SELECT site_id, cast(sum(n - 1) AS bigint) AS duplicate_rows
FROM (SELECT site_id, DATE, count(*) AS n FROM weather_raw GROUP BY site_id, DATE) t GROUP BY site_id""",
    "weather_raw"))
def q_duplicate_dates(spark, sf_dir):
    return D.duplicate_dates(FX.weather_raw(spark, sf_dir), keys=("site_id", "DATE"))


# D10 --------------------------------------------------------------------------
_MONTHS = ", ".join(f"'{m}'" for m in D.MONTH_NAMES)


@query("month_counts", "D10", with_views(f"""
SELECT month(date) AS month, count(*) AS days, ([{_MONTHS}])[month(date)] AS month_name
FROM joined GROUP BY month(date)""", "joined"))
def q_month_counts(spark, sf_dir):
    return D.month_counts(FX.joined(spark, sf_dir))


# D11 --------------------------------------------------------------------------
@query("correlations", "D11", with_views(_union([
    f"SELECT site_id, '{v}' AS variable, corr(CASE WHEN {v} IS NOT NULL AND Total_Pollen IS NOT NULL THEN {v} END, "
    f"CASE WHEN {v} IS NOT NULL AND Total_Pollen IS NOT NULL THEN Total_Pollen END) AS corr "
    f"FROM joined GROUP BY site_id" for v in VARS]), "joined"))
def q_correlations(spark, sf_dir):
    return D.correlations(FX.joined(spark, sf_dir), by=("site_id",))


# D12 --------------------------------------------------------------------------
@query("monthly_pollen", "D12", with_views("""
SELECT site_id, month(date) AS month, avg(Total_Pollen) AS mean, max(Total_Pollen) AS max,
       count(Total_Pollen) AS count FROM joined GROUP BY site_id, month(date)""", "joined"))
def q_monthly_pollen(spark, sf_dir):
    return D.monthly_pollen(FX.joined(spark, sf_dir), by=("site_id",))


# D13 --------------------------------------------------------------------------
@query("pollen_presence", "D13", with_views(_union([
    f"SELECT site_id, '{t}' AS pollen_type, cast(count_if({t} > 0) AS bigint) AS days_present, "
    f"count_if({t} > 0) * 100.0E0 / count(*) AS pct FROM pollen GROUP BY site_id"
    for t in D.POLLEN_TYPES]), "pollen"))
def q_pollen_presence(spark, sf_dir):
    return D.pollen_presence(FX.pollen(spark, sf_dir), by=("site_id",))


# D15 --------------------------------------------------------------------------
# The oracle states its values itself, so a wrong constant can't pass on both sides.
_PCTS = [0, 10, 25, 40, 55, 70, 80, 85, 90, 95, 100]


@query("severity_thresholds", "D15", with_views(
    "SELECT site_id, " + ", ".join(
        f"quantile_cont(CASE WHEN Total_Pollen > 0 THEN Total_Pollen END, {p / 100.0!r}) AS p{p}" for p in _PCTS)
    + " FROM joined GROUP BY site_id", "joined"))
def q_thresholds(spark, sf_dir):
    t = D.severity_thresholds(FX.joined(spark, sf_dir), by=("site_id",))
    return t.select("site_id", *[F.element_at("thresholds", i + 1).alias(f"p{p}") for i, p in enumerate(_PCTS)])


def _pct_severity_sql():
    thr = ", ".join(f"quantile_cont(CASE WHEN Total_Pollen > 0 THEN Total_Pollen END, {p / 100.0!r}) AS t{i}"
                    for i, p in enumerate(_PCTS))
    case = "CASE WHEN Total_Pollen = 0 THEN 0 " + " ".join(
        f"WHEN Total_Pollen >= t{i} THEN {i}" for i in range(10, 0, -1)) + " ELSE 0 END"
    return thr, case


_THR, _CASE = _pct_severity_sql()
_LABELED = ("labeled", f"""
SELECT j.site_id, j.date, j.Total_Pollen, {_CASE} AS Pollen_Severity
FROM joined j LEFT JOIN (SELECT site_id, {_THR} FROM joined GROUP BY site_id) t ON j.site_id = t.site_id""")


@query("percentile_severity", "D15,G18", with_views(
    "SELECT site_id, date, Total_Pollen, Pollen_Severity FROM labeled", "joined", extra=[_LABELED]))
def q_percentile_severity(spark, sf_dir):
    j = FX.joined(spark, sf_dir).select("site_id", "date", "Total_Pollen")
    return D.label_percentile_severity(j, by=("site_id",), window=True)


# D16 --------------------------------------------------------------------------
_LVL = ", ".join(f"'{x}'" for x in ["None", "Very Low", "Low", "Low-Mod", "Moderate", "Mod-High",
                                      "High", "Very High", "Extreme", "Severe"])


@query("severity_distribution", "D16", with_views(f"""
SELECT g.site_id, severity, days, days * 100.0E0 / tot AS pct,
       CASE WHEN severity < 10 THEN ([{_LVL}])[severity + 1] ELSE 'Level ' || cast(severity AS varchar) END AS label
FROM (SELECT site_id, Pollen_Severity AS severity, count(*) AS days FROM labeled GROUP BY site_id, Pollen_Severity) g
JOIN (SELECT site_id, count(*) AS tot FROM labeled GROUP BY site_id) t ON g.site_id = t.site_id""",
    "joined", extra=[_LABELED]))
def q_severity_distribution(spark, sf_dir):
    j = FX.joined(spark, sf_dir).select("site_id", "date", "Total_Pollen")
    return D.severity_distribution(D.label_percentile_severity(j, by=("site_id",)), by=("site_id",))


# D17 --------------------------------------------------------------------------
@query("upper_quartile_flag", "D17", with_views("""
SELECT j.site_id, j.date, j.AWND, cast(coalesce(j.AWND > q, false) AS integer) AS High_Wind
FROM joined j LEFT JOIN (SELECT site_id, quantile_cont(AWND, 0.75) AS q FROM joined GROUP BY site_id) t
ON j.site_id = t.site_id""", "joined"))
def q_upper_quartile(spark, sf_dir):
    j = FX.joined(spark, sf_dir).select("site_id", "date", "AWND")
    return D.upper_quartile_flag(j, "AWND", "High_Wind", by=("site_id",), window=True)


# D15, G18, D17 over the whole table (no site) -----------------------------------
_ALL = ("labeled_all", f"""
SELECT j.site_id, j.date, j.Total_Pollen, {_CASE} AS Pollen_Severity FROM joined j, (SELECT {_THR} FROM joined) t""")


@query("severity_thresholds_all", "D15", with_views(
    "SELECT " + ", ".join(f"quantile_cont(CASE WHEN Total_Pollen > 0 THEN Total_Pollen END, {p / 100.0!r}) AS p{p}" for p in _PCTS)
    + " FROM joined", "joined"))
def q_thresholds_all(spark, sf_dir):
    t = D.severity_thresholds(FX.joined(spark, sf_dir))
    return t.select(*[F.element_at("thresholds", i + 1).alias(f"p{p}") for i, p in enumerate(_PCTS)])


@query("percentile_severity_all", "D15,G18", with_views("SELECT * FROM labeled_all", "joined", extra=[_ALL]))
def q_percentile_severity_all(spark, sf_dir):
    j = FX.joined(spark, sf_dir).select("site_id", "date", "Total_Pollen")
    return D.label_percentile_severity(j)


@query("upper_quartile_flags_all", "D17", with_views("""
SELECT site_id, date, cast(coalesce(AWND > qa, false) AS integer) AS High_Wind,
       cast(coalesce(PRCP > qp, false) AS integer) AS Is_Heavy_Rain
FROM joined, (SELECT quantile_cont(AWND, 0.75) AS qa, quantile_cont(PRCP, 0.75) AS qp FROM joined) q""", "joined"))
def q_upper_quartile_all(spark, sf_dir):
    j = FX.joined(spark, sf_dir).select("site_id", "date", "AWND", "PRCP")
    return D.upper_quartile_flags(j, {"AWND": "High_Wind", "PRCP": "Is_Heavy_Rain"}).drop("AWND", "PRCP")


# D24 --------------------------------------------------------------------------
def _hist_sql(c):
    return f"""
SELECT '{c}' AS series, bin, lo + (bin - 1) * w AS lo, lo + bin * w AS hi, count(*) AS count,
       CASE WHEN w > 0 THEN count(*) / (n * w) END AS density
FROM (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor(({c} - lo) / ((hi - lo) / 11.0E0)) + 1, 11) END AS integer) AS bin,
             lo, (hi - lo) / 11.0E0 AS w, n
      FROM predictions, (SELECT min({c}) AS lo, max({c}) AS hi, count({c}) AS n FROM predictions) s
      WHERE {c} IS NOT NULL) t
GROUP BY bin, lo, w, n"""


@query("distribution_histogram", "D24", with_views(_union([_hist_sql("actual"), _hist_sql("predicted")]),
                                                   "predictions"))
def q_histogram(spark, sf_dir):
    return D.distribution_histogram(FX.predictions(spark, sf_dir))


# D14, D18, D19 ---------------------------------------------------------------
def metrics_sql(src: str, by: list[str], full: bool = True, where: str = "") -> str:
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    sel = ", ".join(by) + ", " if by else ""
    grp = f"GROUP BY {', '.join(by)}" if by else ""
    extra = """,
       avg(abs(e) * CASE WHEN actual >= 7 THEN 2.0E0 ELSE 1.0E0 END) AS weighted_mae,
       avg(CASE WHEN abs(e) <= 1 THEN 1.0E0 ELSE 0.0E0 END) AS acc_within_1,
       avg(CASE WHEN abs(e) <= 2 THEN 1.0E0 ELSE 0.0E0 END) AS acc_within_2,
       avg(CASE WHEN actual >= 7 THEN abs(e) END) AS high_mae,
       cast(count_if(actual >= 7) AS bigint) AS high_count""" if full else ""
    cond = "actual IS NOT NULL AND predicted IS NOT NULL" + (f" AND {where}" if where else "")
    return f"""
SELECT {sel}count(*) AS n, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse,
       1 - sum(e * e) / nullif(sum((actual - ybar) * (actual - ybar)), 0) AS r2{extra}
FROM (SELECT *, actual - predicted AS e, avg(actual) OVER ({part}) AS ybar FROM {src} WHERE {cond}) t
{grp}"""


@query("metrics_basic", "D14", with_views(metrics_sql("predictions", ["site_id"], full=False), "predictions"))
def q_metrics_basic(spark, sf_dir):
    return M.metrics_basic(FX.predictions(spark, sf_dir), by=("site_id",))


@query("metrics_full", "D18", with_views(metrics_sql("predictions", ["site_id"]), "predictions"))
def q_metrics_full(spark, sf_dir):
    return M.metrics_full(FX.predictions(spark, sf_dir), by=("site_id",))


@query("metrics_full_global", "D18", with_views(metrics_sql("predictions", []), "predictions"))
def q_metrics_full_global(spark, sf_dir):
    return M.metrics_full(FX.predictions(spark, sf_dir))


_SEASONED = ("seasoned", """
SELECT *, CASE WHEN month(date) IN (3, 4, 5) THEN 'Spring' WHEN month(date) IN (6, 7, 8) THEN 'Summer'
               WHEN month(date) IN (9, 10, 11) THEN 'Fall' ELSE 'Winter' END AS season FROM predictions""")


@query("metrics_by_season", "D19", with_views(f"""
SELECT m.*, mean_actual, mean_predicted FROM ({metrics_sql('seasoned', ['season'], full=False)}) m
JOIN (SELECT season, avg(actual) AS mean_actual, avg(predicted) AS mean_predicted FROM seasoned
      WHERE actual IS NOT NULL AND predicted IS NOT NULL GROUP BY season) s
ON m.season = s.season""", "predictions", extra=[_SEASONED]))
def q_metrics_by_season(spark, sf_dir):
    return M.metrics_by_season(FX.predictions(spark, sf_dir))


# Model comparison tables over the data-derived stand-in models ---------------
_MODELS = ("models", metrics_sql("model_predictions", ["model"]))


def _models(spark, sf_dir):
    return M.metrics_full(FX.model_predictions(spark, sf_dir), by=("model",))


@query("model_metrics", "D18,A6", with_views("SELECT * FROM models", "model_predictions", extra=[_MODELS]))
def q_model_metrics(spark, sf_dir):
    return _models(spark, sf_dir)


@query("macro_average", "D20", with_views(f"""
SELECT model, avg(mae) AS avg_mae, avg(r2) AS avg_r2, avg(acc_within_1) AS avg_acc_within_1, count(*) AS types
FROM ({metrics_sql('model_predictions', ['model', 'site_id'])}) t GROUP BY model""", "model_predictions"))
def q_macro(spark, sf_dir):
    per = M.metrics_full(FX.model_predictions(spark, sf_dir), by=("model", "site_id"))
    return M.macro_average(per, by=("model",))


@query("model_spread", "D21", with_views("""
SELECT count(*) AS models,
       max(mae) - min(mae) AS mae_range, stddev_samp(mae) AS mae_std, avg(mae) AS mae_mean,
       quantile_cont(mae, 0.5) AS mae_median, min(mae) AS mae_min, max(mae) AS mae_max,
       max(r2) - min(r2) AS r2_range, stddev_samp(r2) AS r2_std, avg(r2) AS r2_mean,
       quantile_cont(r2, 0.5) AS r2_median, min(r2) AS r2_min, max(r2) AS r2_max
FROM models""", "model_predictions", extra=[_MODELS]))
def q_spread(spark, sf_dir):
    return M.model_spread(_models(spark, sf_dir))


_FAMILIES = ("families", """
SELECT family, count(*) AS models, min(mae) AS best_mae, avg(mae) AS mean_mae FROM (
  SELECT *, CASE WHEN contains(model, 'Rolling') THEN 'Rolling' WHEN contains(model, 'Persistence')
                 THEN 'Persistence' END AS family FROM models) m
WHERE family IS NOT NULL GROUP BY family""")


@query("family_stats", "D22", with_views("""
SELECT f.family, f.models, f.best_mae, f.mean_mae, min(o.best_mae) AS other_best,
       CASE WHEN f.best_mae < min(o.best_mae) THEN (min(o.best_mae) - f.best_mae) / min(o.best_mae) * 100 END
         AS pct_better
FROM families f LEFT JOIN families o ON o.family <> f.family
GROUP BY f.family, f.models, f.best_mae, f.mean_mae""", "model_predictions", extra=[_MODELS, _FAMILIES]))
def q_family(spark, sf_dir):
    return M.family_stats(_models(spark, sf_dir), ["Rolling", "Persistence"])


@query("best_vs_worst", "D23", with_views("""
SELECT min(mae) AS best_mae, max(mae) AS worst_mae,
       max(CASE WHEN model = 'Persistence Lag 1' THEN mae END) AS baseline_mae,
       (max(mae) - min(mae)) * 100 / nullif(max(mae), 0) AS improvement_pct,
       (max(CASE WHEN model = 'Persistence Lag 1' THEN mae END) - min(mae)) * 100
         / nullif(max(CASE WHEN model = 'Persistence Lag 1' THEN mae END), 0) AS vs_baseline_pct
FROM models""", "model_predictions", extra=[_MODELS]))
def q_best_vs_worst(spark, sf_dir):
    return M.best_vs_worst(_models(spark, sf_dir), baseline="Persistence Lag 1")


_PER_SITE = ("per_site", metrics_sql("model_predictions", ["model", "site_id"]))


@query("pair_results", "C7", with_views("""
SELECT a.site_id, a.mae AS mae_a, a.r2 AS r2_a, b.mae AS mae_b, b.r2 AS r2_b
FROM (SELECT * FROM per_site WHERE model = 'Rolling Mean 7') a
JOIN (SELECT * FROM per_site WHERE model = 'Persistence Lag 1') b ON a.site_id = b.site_id""",
    "model_predictions", extra=[_PER_SITE]))
def q_pair(spark, sf_dir):
    per = M.metrics_full(FX.model_predictions(spark, sf_dir), by=("model", "site_id"))
    a = per.filter(F.col("model") == "Rolling Mean 7").select("site_id", "mae", "r2")
    b = per.filter(F.col("model") == "Persistence Lag 1").select("site_id", "mae", "r2")
    return C.pair_results(a, b, key="site_id")


@query("compare_regimes", "D23,G25", with_views("""
SELECT a.site_id, a.mae AS mae_a, a.r2 AS r2_a, a.acc_within_1 AS acc_a,
       b.mae AS mae_b, b.r2 AS r2_b, b.acc_within_1 AS acc_b,
       (a.mae - b.mae) * 100 / nullif(a.mae, 0) AS mae_improvement_pct,
       b.r2 - a.r2 AS r2_change, (b.acc_within_1 - a.acc_within_1) * 100 AS acc_change_pct,
       coalesce(b.mae < a.mae, false) AS b_is_better,
       CASE WHEN (a.mae - b.mae) * 100 / nullif(a.mae, 0) > 5 THEN 'Significant benefit'
            WHEN (a.mae - b.mae) * 100 / nullif(a.mae, 0) > 0 THEN 'Modest benefit'
            WHEN (a.mae - b.mae) * 100 / nullif(a.mae, 0) > -5 THEN 'Similar'
            ELSE 'Other regime better' END AS benefit
FROM (SELECT * FROM per_site WHERE model = 'Persistence Lag 1') a
JOIN (SELECT * FROM per_site WHERE model = 'Rolling Mean 7') b ON a.site_id = b.site_id""",
    "model_predictions", extra=[_PER_SITE]))
def q_compare_regimes(spark, sf_dir):
    per = M.metrics_full(FX.model_predictions(spark, sf_dir), by=("model", "site_id"))
    a = per.filter(F.col("model") == "Persistence Lag 1").withColumnRenamed("site_id", "pollen_type")
    b = per.filter(F.col("model") == "Rolling Mean 7").withColumnRenamed("site_id", "pollen_type")
    out = M.compare_regimes(a, b).withColumnRenamed("pollen_type", "site_id")
    return out.withColumn("benefit", S.benefit_tier(F.col("mae_improvement_pct")))


# F3, F4 -----------------------------------------------------------------------
@query("leaderboard", "F3", with_views("SELECT model, mae, rmse, r2 FROM models ORDER BY mae, model",
                                       "model_predictions", extra=[_MODELS]))
def q_leaderboard(spark, sf_dir):
    return R.leaderboard(_models(spark, sf_dir)).select("model", "mae", "rmse", "r2")


@query("best_by", "F4", with_views("""
SELECT arg_min(model, (mae, model)) AS best_mae_model, min(mae) AS best_mae,
       arg_min(model, (-r2, model)) AS best_r2_model, max(r2) AS best_r2 FROM models""",
    "model_predictions", extra=[_MODELS]))
def q_best_by(spark, sf_dir):
    return R.best_by(_models(spark, sf_dir))
