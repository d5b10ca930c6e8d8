"""Queries for batch scoring.

Exact oracles use the deterministic stand-in index (``fixtures.STANDIN``); the
``*_model`` variants score with Spark ML models trained on the joined table
(rows-only check)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeroseries.functions import scalars as S
from aeroseries.operators import features as H
from aeroseries.operators import models as ML
from aeroseries.operators import score as J
from aeroseries.operators import windows as W
from aeroseries.plans import sqlgen as Q
from aeroseries.plans.catalog import query
from aeroseries.plans.q_features import _H5
from aeroseries.plans.views_sql import with_views
from aeroseries.session import cut_lineage
from aeroseries.sources import fixtures as FX

KEYS = ("request_id", "pos")
VALID = ("temp_max IS NOT NULL AND temp_min IS NOT NULL AND date IS NOT NULL "
         "AND coalesce(NOT (temp_max < -50 OR temp_max > 150), true) "
         "AND coalesce(NOT (temp_min < -50 OR temp_min > 150), true) "
         "AND coalesce(NOT (temp_avg < -50 OR temp_avg > 150), true) "
         "AND coalesce(precipitation >= 0, true) AND coalesce(wind_speed >= 0, true) "
         "AND coalesce(temp_max >= temp_min, true)")


def _scored_sql(weekly: bool) -> str:
    """Stand-in prediction per valid request row (columns request_id, pos, date, temp_avg_f, p)."""
    lw = "OVER (PARTITION BY request_id ORDER BY pos)"
    lag_t = f"coalesce({Q.f_to_c(f'lag(temp_avg_f, 1) {lw}')}, TMAX)" if weekly else "TMAX"
    lag_p = f"coalesce(lag(precipitation, 1) {lw} * 25.4E0, PRCP)" if weekly else "PRCP"
    doy = "dayofyear(date)"
    feats = {
        "GDD_General": "greatest(TAVG - 5.0E0, 0.0E0)",
        "Tree_Peak_Prox": Q.peak_prox(doy, 110), "Grass_Peak_Prox": Q.peak_prox(doy, 175),
        "Weed_Peak_Prox": Q.peak_prox(doy, 255),
        "Rain_Heavy": "CASE WHEN PRCP = 0 THEN 0 WHEN PRCP <= 2.5 THEN 0 ELSE 1 END",
        "Ventilation_Index": "AWND * (TMAX - TMIN)",
        "TMAX_lag_1": lag_t, "PRCP_lag_1": lag_p,
    }
    pred = f"{FX.STANDIN.intercept!r}" + "".join(
        f" + ({feats[c]}) * {float(w)!r}" for c, w in FX.STANDIN.weights.items())
    base = f"""
SELECT request_id, pos, date, temp_avg_f, precipitation, {Q.f_to_c('temp_max')} AS TMAX,
       {Q.f_to_c('temp_min')} AS TMIN, {Q.f_to_c('temp_avg_f')} AS TAVG, precipitation * 25.4E0 AS PRCP,
       wind_mph * 1.609E0 AS AWND
FROM (SELECT *, coalesce(temp_avg, (temp_max + temp_min) / 2) AS temp_avg_f,
             coalesce(nullif(wind_speed, 0.0E0), 5.0E0) AS wind_mph FROM requests WHERE {VALID}) r"""
    return f"SELECT request_id, pos, date, temp_avg_f, {Q.clip(pred, 0, 10)} AS s FROM ({base}) b"


def _daily_sql(weekly=False):
    conf = J.WEEKLY_CONFIDENCE if weekly else J.DAILY_CONFIDENCE
    rec = "" if weekly else f", {Q.recommendation('s')} AS recommendation"
    return (f"SELECT request_id, pos, date, round(s, 2) AS severity_score, s AS raw_score, "
            f"{Q.severity_level('s')} AS severity_level, {conf!r}E0 AS confidence{rec} FROM ({_scored_sql(weekly)}) t")


# J1 ---------------------------------------------------------------------------
@query("score_daily", "J1", with_views(_daily_sql(), "requests"))
def q_daily(spark, sf_dir):
    return J.score_daily(FX.requests(spark, sf_dir), FX.STANDIN)


def _trained(spark, sf_dir, labels):
    j = H.biological_labels(FX.joined(spark, sf_dir))
    f = H.abiotic_features(j).select(*H.H5_COLUMNS, *labels)
    f = cut_lineage(f.na.drop(subset=list(H.H5_COLUMNS)))
    return {lab: ML.fit(f.na.drop(subset=[lab]), H.H5_COLUMNS, lab, "small_gbt", maxIter=10) for lab in labels}


@query("score_daily_model", "J1")
def q_daily_model(spark, sf_dir):
    m = _trained(spark, sf_dir, ["Total_Pollen_Severity"])["Total_Pollen_Severity"]
    return J.score_daily(FX.requests(spark, sf_dir), m, H.H5_COLUMNS)


# J2 ---------------------------------------------------------------------------
@query("score_weekly", "J2", with_views(_daily_sql(weekly=True), "requests"))
def q_weekly(spark, sf_dir):
    return J.score_weekly(FX.requests(spark, sf_dir), FX.STANDIN)


# J3 ---------------------------------------------------------------------------
_W = J.WEEKLY_SUMMARIES


@query("weekly_summary", "J3", with_views(f"""
SELECT request_id, count(*) AS days, avg(severity_score) AS avg_severity,
       CASE WHEN max(raw_score) > 0 THEN arg_min(date, (-raw_score, pos)) END AS peak_day,
       CASE WHEN avg(severity_score) <= 3 THEN '{_W[0]}' WHEN avg(severity_score) <= 5 THEN '{_W[1]}'
            WHEN avg(severity_score) <= 7 THEN '{_W[2]}' ELSE '{_W[3]}' END AS summary
FROM ({_daily_sql(weekly=True)}) w GROUP BY request_id""", "requests"))
def q_weekly_summary(spark, sf_dir):
    return J.weekly_summary(J.score_weekly(FX.requests(spark, sf_dir), FX.STANDIN))


# J4 ---------------------------------------------------------------------------
@query("score_allergens_model", "J4")
def q_allergens_model(spark, sf_dir):
    labs = {t: f"{t}_Severity" for t in J.ALLERGENS_MODEL_ORDER}
    trained = _trained(spark, sf_dir, list(labs.values()))
    models = {t: trained[lab] for t, lab in labs.items()}
    return J.score_allergens(FX.requests(spark, sf_dir), models, H.H5_COLUMNS)


# J4 with fixed scorers ----------------------------------------------------------
def _fixed(i):
    return FX.LinearIndexScorer({"GDD_General": 0.25 * (i + 1), "Rain_Heavy": -0.5}, intercept=0.5 * i)


_J4 = "\nUNION ALL ".join(
    f"SELECT request_id, pos, date, '{t}' AS allergen_type, {i} AS idx, "
    + Q.clip(f"{0.5 * i!r} + greatest(TAVG - 5.0E0, 0.0E0) * {0.25 * (i + 1)!r} + "
             "(CASE WHEN PRCP = 0 THEN 0 WHEN PRCP <= 2.5 THEN 0 ELSE 1 END) * -0.5E0", 0, 10) + " AS score FROM inputs"
    for i, t in enumerate(["Tree", "Grass", "Weed", "Ragweed"]))


@query("score_allergens_fixed", "J4", with_views(_J4, "requests", extra=[("inputs", f"""
SELECT request_id, pos, date, {Q.f_to_c('temp_avg_f')} AS TAVG, precipitation * 25.4E0 AS PRCP
FROM (SELECT *, coalesce(temp_avg, (temp_max + temp_min) / 2) AS temp_avg_f FROM requests WHERE {VALID}) r""")]))
def q_allergens_fixed(spark, sf_dir):
    models = {t: _fixed(i) for i, t in enumerate(J.ALLERGENS_MODEL_ORDER)}
    return J.score_allergens(FX.requests(spark, sf_dir), models)


# J5 ---------------------------------------------------------------------------
def _alloc_sql():
    m = "month(date)"
    share = {}
    for months, shares in J.SEASON_SHARES.values():
        for i, t in enumerate(J.ALLERGENS_SEASON_ORDER):
            share.setdefault(t, []).append((months, shares[i]))
    factor = "CASE WHEN temp_avg_f > 75 THEN 1.2E0 WHEN temp_avg_f < 50 THEN 0.7E0 ELSE 1.0E0 END"
    return ", ".join(
        "s * CASE " + " ".join(f"WHEN {m} IN ({', '.join(map(str, ms))}) THEN {v!r}" for ms, v in share[t])
        + f" END * {factor} AS s{i}" for i, t in enumerate(J.ALLERGENS_SEASON_ORDER))


_SCORED = ("scored", _scored_sql(False))
_WIDE = ("wide", f"SELECT *, s0 + s1 + s2 + s3 AS total FROM (SELECT request_id, pos, date, {_alloc_sql()} FROM scored) a")
_ALLOC = ("alloc", "\nUNION ALL ".join(
    f"SELECT request_id, pos, date, '{t}' AS allergen_type, {i} AS idx, s{i} AS score, total FROM wide"
    for i, t in enumerate(J.ALLERGENS_SEASON_ORDER)))


@query("allocate_by_season", "J5", with_views(
    "SELECT request_id, pos, date, allergen_type, idx, score FROM alloc", "requests", extra=[_SCORED, _WIDE, _ALLOC]))
def q_alloc(spark, sf_dir):
    return J.allocate_by_season(J.score_daily(FX.requests(spark, sf_dir), FX.STANDIN, with_inputs=True))


# J6 ---------------------------------------------------------------------------
_BREAKDOWN = ("breakdown", f"""
SELECT request_id, pos, date, allergen_type,
       row_number() OVER (PARTITION BY request_id, pos ORDER BY round(score, 2) DESC, idx) AS rank,
       round(score, 2) AS severity_score, {Q.severity_level('score')} AS severity_level,
       CASE WHEN total > 0 THEN round(score / total * 100, 1) ELSE 0.0E0 END AS contribution_pct,
       round(total, 2) AS total_severity,
       CASE WHEN max(score) OVER (PARTITION BY request_id, pos) > 0
            THEN arg_min(allergen_type, (-score, idx)) OVER (PARTITION BY request_id, pos) ELSE 'Grass' END
         AS primary_allergen,
       {Q.alert_level('total')} AS alert_level
FROM alloc""")


@query("allergen_breakdown", "J6", with_views("SELECT * FROM breakdown", "requests",
                                              extra=[_SCORED, _WIDE, _ALLOC, _BREAKDOWN]))
def q_breakdown(spark, sf_dir):
    daily = J.score_daily(FX.requests(spark, sf_dir), FX.STANDIN, with_inputs=True)
    return J.allergen_breakdown(J.season_entries(daily))


# J7 ---------------------------------------------------------------------------
@query("dominant_allergen", "J7", with_views("""
SELECT site_id, date, CASE WHEN greatest(Tree, Grass, Weed, Ragweed) IS NULL OR greatest(Tree, Grass, Weed, Ragweed) <= 0
            THEN 'None' WHEN Tree = greatest(Tree, Grass, Weed, Ragweed) THEN 'Tree'
            WHEN Grass = greatest(Tree, Grass, Weed, Ragweed) THEN 'Grass'
            WHEN Weed = greatest(Tree, Grass, Weed, Ragweed) THEN 'Weed'
            WHEN Ragweed = greatest(Tree, Grass, Weed, Ragweed) THEN 'Ragweed' END AS dominant_allergen
FROM pollen""", "pollen"))
def q_dominant(spark, sf_dir):
    p = FX.pollen(spark, sf_dir)
    return p.select("site_id", "date", J.dominant_allergen(p).alias("dominant_allergen"))


# J8 ---------------------------------------------------------------------------
@query("high_risk_days", "J8", with_views(f"""
SELECT j.site_id, j.date, j.Total_Pollen, sev AS Total_Pollen_Severity,
       {Q.flag('j.Total_Pollen > q')} AS high_risk_quantile, {Q.flag('sev >= 7')} AS high_risk_severity
FROM (SELECT *, {Q.severity_biological('Total_Pollen', 'Total_Pollen')} AS sev FROM joined) j
LEFT JOIN (SELECT site_id, quantile_cont(Total_Pollen, 0.75) AS q FROM joined GROUP BY site_id) t
ON j.site_id = t.site_id""", "joined"))
def q_high_risk(spark, sf_dir):
    j = H.biological_labels(FX.joined(spark, sf_dir)).select("site_id", "date", "Total_Pollen",
                                                             "Total_Pollen_Severity")
    return J.high_risk_days(j, severity_col="Total_Pollen_Severity")


# J9 ---------------------------------------------------------------------------
@query("expand_sparse_history", "J9", with_views(f"""
SELECT site_id, date,
       CASE WHEN p1 IS NULL THEN NULL WHEN p7 IS NOT NULL THEN 7 WHEN p3 IS NOT NULL THEN 3 ELSE 1 END AS n_pollen,
       CASE WHEN p1 IS NULL THEN NULL WHEN p7 IS NOT NULL AND p3 IS NOT NULL THEN 4 * p7 + 2 * p3 + p1
            WHEN p7 IS NOT NULL THEN 6 * p7 + p1 WHEN p3 IS NOT NULL THEN 2 * p3 + p1 ELSE p1 END AS sum_pollen,
       CASE WHEN p1 IS NULL THEN NULL WHEN p7 IS NOT NULL THEN p7 WHEN p3 IS NOT NULL THEN p3 ELSE p1 END AS first_pollen,
       CASE WHEN t30 IS NOT NULL THEN 30 END AS n_temps, t30 * 30 AS sum_temps,
       CASE WHEN r IS NOT NULL THEN 1 END AS n_precip, r AS precip_total,
       CASE WHEN w30 IS NOT NULL THEN 30 END AS n_wind
FROM (SELECT site_id, date, {Q.lag('Total_Pollen', 1)} AS p1, {Q.lag('Total_Pollen', 3)} AS p3,
             {Q.lag('Total_Pollen', 7)} AS p7, {Q.rolling_mean('TAVG', 30)} AS t30,
             {Q.cumsum_within('PRCP', 'site_id, year(date)')} AS r, {Q.rolling_mean('AWND', 30)} AS w30
      FROM joined) t""", "joined"))
def q_sparse_history(spark, sf_dir):
    j = FX.joined(spark, sf_dir)
    x = j.select("site_id", "date", W.lag("Total_Pollen", 1).alias("pollen_1"),
                 W.lag("Total_Pollen", 3).alias("pollen_3"), W.lag("Total_Pollen", 7).alias("pollen_7"),
                 W.rolling_mean("TAVG", 30).alias("avg_temp_30"), W.ytd_cumsum("PRCP").alias("rain_season"),
                 W.rolling_mean("AWND", 30).alias("avg_wind_30"))
    e = J.expand_sparse_history(x)

    def total(a):
        return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v)

    return e.select("site_id", "date", F.size("historical_pollen").alias("n_pollen"),
                    total("historical_pollen").alias("sum_pollen"),
                    F.try_element_at("historical_pollen", F.lit(1)).alias("first_pollen"),
                    F.size("historical_temps").alias("n_temps"), total("historical_temps").alias("sum_temps"),
                    F.size("historical_precip").alias("n_precip"),
                    F.try_element_at("historical_precip", F.lit(1)).alias("precip_total"),
                    F.size("historical_wind").alias("n_wind"))


# J10 --------------------------------------------------------------------------
@query("full_report", "J10,J5,J6", with_views(f"""
SELECT d.*, b.total_severity, b.primary_allergen, b.alert_level
FROM ({_daily_sql()}) d
LEFT JOIN (SELECT DISTINCT request_id, pos, total_severity, primary_allergen, alert_level FROM breakdown) b
ON d.request_id = b.request_id AND d.pos = b.pos""", "requests", extra=[_SCORED, _WIDE, _ALLOC, _BREAKDOWN]))
def q_full_report(spark, sf_dir):
    daily = J.score_daily(FX.requests(spark, sf_dir), FX.STANDIN, with_inputs=True)
    return J.full_report(J.season_entries(daily)).drop("temp_avg_f")


@query("allergen_response", "J6", with_views("""
SELECT request_id, pos, any_value(date) AS date, any_value(total_severity) AS total_severity,
       any_value(primary_allergen) AS primary_allergen, any_value(alert_level) AS alert_level, count(*) AS n_allergens,
       string_agg(rank || ':' || allergen_type || ':' || severity_level, ';' ORDER BY rank) AS ranking
FROM breakdown GROUP BY request_id, pos""", "requests", extra=[_SCORED, _WIDE, _ALLOC, _BREAKDOWN]))
def q_response(spark, sf_dir):
    daily = J.score_daily(FX.requests(spark, sf_dir), FX.STANDIN, with_inputs=True)
    r = J.allergen_response(J.season_entries(daily))
    text = F.transform("allergens", lambda a: F.concat_ws(":", a["rank"].cast("string"), a["allergen_type"], a["severity_level"]))
    return r.select("request_id", "pos", "date", "total_severity", "primary_allergen", "alert_level",
                    F.size("allergens").cast("bigint").alias("n_allergens"), F.array_join(text, ";").alias("ranking"))


# J1 from true history -------------------------------------
def _history_sql():
    pred = f"{FX.STANDIN.intercept!r}" + "".join(f" + {c} * {float(w)!r}" for c, w in FX.STANDIN.weights.items())
    complete = " AND ".join(f"{c} IS NOT NULL" for c in H.H5_COLUMNS)
    s = Q.clip(pred, 0, 10)
    return (f"SELECT site_id, date, round({s}, 2) AS severity_score, {s} AS raw_score, "
            f"{Q.severity_level(s)} AS severity_level, {Q.recommendation(s)} AS recommendation "
            f"FROM h5 WHERE {complete}")


@query("score_from_history", "J1,H5,E21", with_views(_history_sql(), "joined", extra=[("h5", _H5)]))
def q_score_history(spark, sf_dir):
    j = FX.joined(spark, sf_dir)
    f = H.abiotic_features(j).na.drop(subset=list(H.H5_COLUMNS))
    return J.score_history_features(f, FX.STANDIN)
