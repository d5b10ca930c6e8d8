"""Queries for scalar functions (G)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from aeroseries.functions import scalars as S
from aeroseries.operators import metrics as M
from aeroseries.operators import windows as W
from aeroseries.plans import sqlgen as Q
from aeroseries.plans.catalog import query
from aeroseries.plans.q_profile import metrics_sql
from aeroseries.plans.views_sql import with_views
from aeroseries.sources import fixtures as FX

_ms, _mc = Q.cyc("month(date)", 12)
_ds, _dc = Q.cyc("dayofyear(date)", 365)


# G1-G3 ------------------------------------------------------------------------
@query("calendar_cyclical_season", "G1,G2,G3", with_views(f"""
SELECT site_id, date, year(date) AS Year, month(date) AS Month, dayofyear(date) AS Day_of_Year,
       {Q.weekday('date')} AS Day_of_Week, weekofyear(date) AS Week_of_Year,
       {_ms} AS Month_sin, {_mc} AS Month_cos, {_ds} AS DOY_sin, {_dc} AS DOY_cos,
       {Q.season('month(date)')} AS Season
FROM weather_site""", "weather_site"))
def q_calendar(spark, sf_dir):
    w = FX.weather_site(spark, sf_dir)
    parts = S.calendar_parts(F.col("date"))
    ms, mc = S.cyclical(F.month("date"), 12)
    ds, dc = S.cyclical(F.dayofyear("date"), 365)
    return w.select("site_id", "date", *[c.alias(n) for n, c in parts.items()],
                    ms.alias("Month_sin"), mc.alias("Month_cos"), ds.alias("DOY_sin"), dc.alias("DOY_cos"),
                    S.season(F.month("date")).alias("Season"))


# G4-G11 -----------------------------------------------------------------------
@query("weather_scalars", "G4,G5,G6,G7,G8,G9,G10,G11", with_views(f"""
SELECT site_id, date, TMAX - TMIN AS Temp_Range, {Q.flag('PRCP > 0')} AS Is_Rainy,
       {Q.rain_intensity('PRCP')} AS Rain_Intensity,
       {Q.flag(Q.rain_intensity('PRCP') + ' = 1')} AS Rain_Light,
       {Q.flag(Q.rain_intensity('PRCP') + ' = 2')} AS Rain_Heavy,
       {Q.flag('TAVG > 20')} AS Above_20C, {Q.flag('TAVG < 5')} AS Below_5C, {Q.flag('TMIN < 0')} AS Freezing,
       {Q.gdd('TAVG', 5)} AS GDD_General, {Q.gdd('TAVG', 10)} AS GDD_Grass, {Q.gdd('TAVG', 8)} AS GDD_Weed,
       {Q.vpd('TAVG', 'TMIN')} AS VPD,
       AWND * (TMAX - TMIN) AS Ventilation_Index,
       {Q.flag(Q.rain_intensity('PRCP') + ' = 1')} * AWND * {Q.vpd('TAVG', 'TMIN')} AS Shock_Index
FROM weather_site""", "weather_site"))
def q_weather_scalars(spark, sf_dir):
    w = FX.weather_site(spark, sf_dir)
    tmax, tmin, tavg, p, a = (F.col(c) for c in ("TMAX", "TMIN", "TAVG", "PRCP", "AWND"))
    vpd = S.vpd(tavg, tmin)
    return w.select(
        "site_id", "date", S.temp_range(tmax, tmin).alias("Temp_Range"), S.is_rainy(p).alias("Is_Rainy"),
        S.rain_intensity(p).alias("Rain_Intensity"), S.rain_light(p).alias("Rain_Light"),
        S.rain_heavy(p).alias("Rain_Heavy"), S.above(tavg, 20).alias("Above_20C"),
        S.below(tavg, 5).alias("Below_5C"), S.below(tmin, 0).alias("Freezing"),
        S.gdd(tavg, 5).alias("GDD_General"), S.gdd(tavg, 10).alias("GDD_Grass"), S.gdd(tavg, 8).alias("GDD_Weed"),
        vpd.alias("VPD"), S.ventilation_index(a, S.temp_range(tmax, tmin)).alias("Ventilation_Index"),
        S.shock_index(S.rain_light(p), a, vpd).alias("Shock_Index"))


# G12-G17 ----------------------------------------------------------------------
def _phen_sql():
    doy = "dayofyear(date)"
    cols = []
    for t, pk in S.PEAK_PROXIMITY_DOY.items():
        cols.append(f"{Q.peak_prox(doy, pk)} AS {t}_Peak_Prox")
    for t, pk in S.DAYS_TO_PEAK_DOY.items():
        lo, hi = S.SEASON_WINDOWS[t]
        cols.append(f"abs({doy} - {pk}) AS Days_to_{t}_Peak")
        cols.append(f"{Q.flag(f'{doy} >= {lo} AND {doy} <= {hi}')} AS In_{t}_Season")
        cols.append(f"{Q.clip(f'({doy} - {lo}) / 90.0E0', 0, 1)} AS {t}_Season_Progress")
    cols.append(f"GDD_cumsum * {Q.flag(f'{doy} >= 60 AND {doy} <= 150')} AS GDD_x_Tree_Season")
    cols.append(f"TAVG * {Q.flag(f'{doy} >= 120 AND {doy} <= 210')} AS Temp_x_Grass_Season")
    cols.append(f"TAVG * {Q.flag('month(date) IN (3, 4, 5)')} AS Temp_x_Spring")
    cols.append("PRCP * AWND AS Rain_x_Wind")
    for lvl in (100, 200, 500):
        cols.append(f"{Q.flag(f'round(GDD_cumsum, 9) > {lvl}')} AS GDD_cumsum_above_{lvl}")
    return f"""
SELECT site_id, date, {', '.join(cols)} FROM (
  SELECT *, {Q.cumsum_within(Q.gdd('TAVG', 5), 'site_id, year(date)')} AS GDD_cumsum FROM weather_site) t"""


@query("phenology", "G12,G13,G14,G15,G16,G17", with_views(_phen_sql(), "weather_site"))
def q_phenology(spark, sf_dir):
    w = FX.weather_site(spark, sf_dir).withColumn("GDD", S.gdd(F.col("TAVG"), 5))
    w = w.withColumn("GDD_cumsum", W.ytd_cumsum("GDD"))
    doy, gc, tavg = F.dayofyear("date"), F.col("GDD_cumsum"), F.col("TAVG")
    cols = [S.peak_proximity(doy, pk).alias(f"{t}_Peak_Prox") for t, pk in S.PEAK_PROXIMITY_DOY.items()]
    for t, pk in S.DAYS_TO_PEAK_DOY.items():
        lo, hi = S.SEASON_WINDOWS[t]
        cols += [S.days_to_peak(doy, pk).alias(f"Days_to_{t}_Peak"), S.in_season(doy, lo, hi).alias(f"In_{t}_Season"),
                 S.season_progress(doy, lo).alias(f"{t}_Season_Progress")]
    cols += [(gc * S.in_season(doy, 60, 150)).alias("GDD_x_Tree_Season"),
             (tavg * S.in_season(doy, 120, 210)).alias("Temp_x_Grass_Season"),
             (tavg * S.flag(F.month("date").isin(3, 4, 5))).alias("Temp_x_Spring"),
             (F.col("PRCP") * F.col("AWND")).alias("Rain_x_Wind")]
    cols += [S.gdd_trigger(gc, lvl).alias(f"GDD_cumsum_above_{lvl}") for lvl in (100, 200, 500)]
    return w.select("site_id", "date", *cols)


# G19-G24, G26 -----------------------------------------------------------------
_TYPES = ["Tree", "Grass", "Weed", "Ragweed", "Total_Pollen"]


def _sev_sql():
    cols = [f"{Q.severity_biological(t, t)} AS {t}_Severity" for t in _TYPES]
    for t in _TYPES:
        base, names = S.BIO_THRESHOLDS[t], S.BIO_LEVEL_NAMES[t]
        case = "CASE " + " ".join(f"WHEN {t} >= {float(base[i])!r} THEN '{names[i]}'"
                                  for i in range(len(base) - 1, -1, -1)) + f" ELSE '{names[0]}' END"
        cols.append(f"{case} AS {t}_Level_Name")
    tot = Q.severity_biological("Total_Pollen", "Total_Pollen")
    cols += [f"{Q.severity_fixed('Total_Pollen')} AS Fixed_Severity",
             f"{Q.severity_level(tot)} AS Severity_Level",
             f"{Q.recommendation(tot)} AS Recommendation",
             f"CASE WHEN {tot} <= 2 THEN 'Low' WHEN {tot} <= 4 THEN 'Moderate' WHEN {tot} <= 6 THEN 'High' "
             f"WHEN {tot} <= 8 THEN 'Very High' ELSE 'Severe' END AS Display_Band"]
    alls = " + ".join(Q.severity_biological(t, t) for t in _TYPES[:4])
    cols.append(f"{Q.alert_level(alls)} AS Alert_Level")
    return f"SELECT site_id, date, {', '.join(cols)} FROM pollen"


@query("severity_scales", "G19,G20,G21,G22,G23,G24,G26", with_views(_sev_sql(), "pollen"))
def q_severity(spark, sf_dir):
    p = FX.pollen(spark, sf_dir)
    cols = [S.severity_biological(F.col(t), t).alias(f"{t}_Severity") for t in _TYPES]
    cols += [S.level_name_biological(F.col(t), t).alias(f"{t}_Level_Name") for t in _TYPES]
    tot = S.severity_biological(F.col("Total_Pollen"), "Total_Pollen")
    alls = sum((S.severity_biological(F.col(t), t) for t in _TYPES[1:4]),
               S.severity_biological(F.col(_TYPES[0]), _TYPES[0]))
    cols += [S.severity_fixed(F.col("Total_Pollen")).alias("Fixed_Severity"),
             S.severity_level(tot).alias("Severity_Level"), S.recommendation(tot).alias("Recommendation"),
             S.display_band(tot).alias("Display_Band"), S.alert_level(alls).alias("Alert_Level")]
    return p.select("site_id", "date", *cols)


# G25 --------------------------------------------------------------------------
def _tier_sql(col, scale):
    cuts, names = S.TIER_SCALES[scale]
    return ("CASE " + " ".join(f"WHEN {col} <= {c!r} THEN '{n}'" for c, n in zip(cuts, names))
            + f" ELSE '{names[-1]}' END")


@query("performance_tier", "G25", with_views(
    "SELECT model, mae, " + ", ".join(f"{_tier_sql('mae', s)} AS tier_{s}" for s in S.TIER_SCALES)
    + ", CASE WHEN (mae - best) / best * 100 < 50 THEN 'Weather captures most signal' "
      "WHEN (mae - best) / best * 100 < 100 THEN 'History matters' ELSE 'History dominates' END AS relative_tier"
    + " FROM models, (SELECT min(mae) AS best FROM models) b",
    "model_predictions", extra=[("models", metrics_sql("model_predictions", ["model"]))]))
def q_tier(spark, sf_dir):
    m = M.metrics_full(FX.model_predictions(spark, sf_dir), by=("model",))
    # A window over the rows of the models, one each: the metrics are computed once.
    m = m.withColumn("best", F.min("mae").over(Window.partitionBy()))
    return m.select("model", "mae", *[S.performance_tier(F.col("mae"), s).alias(f"tier_{s}") for s in S.TIER_SCALES],
                    S.relative_change_tier(S.relative_change(F.col("mae"), F.col("best"))).alias("relative_tier"))


# G27, G28, G30 ----------------------------------------------------------------
_SEAS_T = "CASE " + " ".join(f"WHEN month(date) = {m} THEN {float(t)!r}"
                             for m, t in S.SEASONAL_TEMPERATURE_F.items()) + " ELSE 60.0E0 END"


@query("request_units", "G27,G28,G30", with_views(f"""
SELECT request_id, pos, {Q.f_to_c('temp_max')} AS temp_max_c, precipitation * 25.4E0 AS precipitation_mm,
       wind_speed * 0.44704E0 AS wind_ms, wind_speed * 1.609E0 AS wind_kmh,
       CASE WHEN precipitation > 0 THEN 0 WHEN month(date) IN (6, 7, 8) THEN 3
            WHEN month(date) IN (12, 1, 2) THEN 1 ELSE 2 END AS est_days_since_rain,
       {_SEAS_T} AS seasonal_temp_f
FROM requests""", "requests"))
def q_units(spark, sf_dir):
    r = FX.requests(spark, sf_dir)
    return r.select("request_id", "pos", S.f_to_c(F.col("temp_max")).alias("temp_max_c"),
                    S.inch_to_mm(F.col("precipitation")).alias("precipitation_mm"),
                    S.mph_to_ms(F.col("wind_speed")).alias("wind_ms"),
                    S.mph_to_kmh(F.col("wind_speed")).alias("wind_kmh"),
                    S.estimate_days_since_rain(F.month("date"), F.col("precipitation")).alias("est_days_since_rain"),
                    S.seasonal_temperature(F.month("date")).alias("seasonal_temp_f"))
