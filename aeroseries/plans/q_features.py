"""Queries for the composite feature sets (H1-H6) and biological labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeroseries.functions import scalars as S
from aeroseries.operators import features as H
from aeroseries.plans import sqlgen as Q
from aeroseries.plans.catalog import query
from aeroseries.plans.views_sql import with_views
from aeroseries.sources import fixtures as FX

_ms, _mc = Q.cyc("month(date)", 12)
_ds, _dc = Q.cyc("dayofyear(date)", 365)
DOY = "dayofyear(date)"


def _peaks(progress=False):
    out = []
    for t in ("Tree", "Grass", "Ragweed"):
        lo, hi = S.SEASON_WINDOWS[t]
        out.append(f"abs({DOY} - {S.DAYS_TO_PEAK_DOY[t]}) AS Days_to_{t}_Peak")
        out.append(f"{Q.flag(f'{DOY} >= {lo} AND {DOY} <= {hi}')} AS In_{t}_Season")
        if progress:
            out.append(f"{Q.clip(f'({DOY} - {lo}) / 90.0E0', 0, 1)} AS {t}_Season_Progress")
    return ", ".join(out)


def _prox():
    return ", ".join(f"{Q.peak_prox(DOY, pk)} AS {t}_Peak_Prox" for t, pk in S.PEAK_PROXIMITY_DOY.items())


def _gdd_species():
    return ", ".join(f"{Q.gdd('TAVG', b)} AS GDD_{k}" for k, b in S.GDD_BASES.items())


def _q75(col, name):
    return (f"LEFT JOIN (SELECT site_id AS {name}_site, quantile_cont({col}, 0.75) AS {name}_q FROM joined "
            f"GROUP BY site_id) {name} ON {name}.{name}_site = b.site_id")


def _sel(cols):
    return "SELECT site_id, date, " + ", ".join(cols)


def _build(name):
    def run(spark, sf_dir):
        return H.build(FX.joined(spark, sf_dir), name)
    return run


# H1 ---------------------------------------------------------------------------
_H1 = f"""
{_sel(H.H1_COLUMNS)} FROM (
  SELECT b.*, {Q.flag('AWND > hw_q')} AS High_Wind,
         {', '.join(f"{Q.lag(c, n)} AS {p}_lag_{n}" for n in (1, 3, 7) for p, c in (('Pollen', 'Total_Pollen'), ('TMAX', 'TMAX'), ('PRCP', 'PRCP')))},
         {', '.join(f"{e} AS {p}_{n}" for n in (3, 7, 14) for p, e in (('Pollen_roll_mean', Q.rolling_mean('Total_Pollen', n)), ('Temp_roll_mean', Q.rolling_mean('TAVG', n)), ('Precip_roll_sum', Q.rolling_sum('PRCP', n))))},
         {Q.cumsum_within('GDD', 'site_id, year(date)')} AS GDD_cumsum
  FROM (SELECT *, month(date) AS Month, {DOY} AS Day_of_Year, {Q.weekday('date')} AS Day_of_Week,
               {_ms} AS Month_sin, {_mc} AS Month_cos, {_ds} AS Day_of_Year_sin, {_dc} AS Day_of_Year_cos,
               TMAX - TMIN AS Temp_Range, {Q.flag('PRCP > 0')} AS Is_Rainy, {Q.gdd('TAVG', 5)} AS GDD
        FROM joined) b {_q75('AWND', 'hw')}
) t"""
query("features_baseline", "H1", with_views(_H1, "joined"))(_build("baseline"))


# H2 ---------------------------------------------------------------------------
_H2_S1 = f"""
SELECT *, {Q.rolling_mean('TAVG', 30)} AS TAVG_30d_mean,
       {Q.cumsum_within('PRCP', 'site_id, year(date)')} AS PRCP_YTD, {Q.rolling_sum('PRCP', 30)} AS PRCP_30d_sum,
       {Q.cumsum_within('GDD', 'site_id, year(date)')} AS GDD_cumsum,
       {Q.rolling_sum('GDD', 7)} AS GDD_7d, {Q.rolling_sum('GDD', 14)} AS GDD_14d, {Q.rolling_sum('GDD', 30)} AS GDD_30d,
       {Q.flag('TMIN < 0 AND ' + Q.lag('TMIN', 1) + ' >= 0')} AS Frost_Event,
       TAVG - {Q.lag('TAVG', 1)} AS TAVG_change,
       {', '.join(f"{Q.lag(c, n)} AS {p}_lag_{n}" for n in (1, 3, 7) for p, c in (('Pollen', 'Total_Pollen'), ('TMAX', 'TMAX'), ('PRCP', 'PRCP')))},
       {', '.join(f"{e} AS {p}_{n}" for n in (3, 7, 14) for p, e in (('Pollen_roll_mean', Q.rolling_mean('Total_Pollen', n)), ('Temp_roll_mean', Q.rolling_mean('TAVG', n)), ('Precip_roll_sum', Q.rolling_sum('PRCP', n))))},
       sum(coalesce(cast(PRCP <> 0 AS integer), 1)) OVER {Q.running()} AS k_dry,
       sum({Q.flag('PRCP = 0')}) OVER {Q.running()} AS k_wet
FROM (SELECT *, {DOY} AS Day_of_Year, {Q.weekday('date')} AS Day_of_Week,
             {_ms} AS Month_sin, {_mc} AS Month_cos, {_ds} AS DOY_sin, {_dc} AS DOY_cos,
             TMAX - TMIN AS Temp_Range, {Q.flag('PRCP > 0')} AS Is_Rainy, {Q.gdd('TAVG', 5)} AS GDD,
             {Q.flag('TMIN < 0')} AS Below_Freezing, {_peaks()}
      FROM joined) b"""
_H2 = f"""
{_sel(H.H2_COLUMNS)} FROM (
  SELECT *, TAVG - TAVG_30d_mean AS Temp_Anomaly,
         stddev_samp(TAVG_change) OVER {Q.rows(7)} AS TAVG_volatility_7d,
         {Q.cumsum_within('GDD', 'site_id, k_frost')} AS GDD_since_frost,
         cast(sum({Q.flag('PRCP = 0')}) OVER {Q.running('site_id, k_dry')} AS integer) AS Consecutive_Dry_Days,
         cast(sum({Q.flag('PRCP > 0')}) OVER {Q.running('site_id, k_wet')} AS integer) AS Consecutive_Wet_Days
  FROM (SELECT *, sum(Frost_Event) OVER {Q.running()} AS k_frost FROM ({_H2_S1}) s1) s2
) t"""
query("features_enhanced", "H2", with_views(_H2, "joined"))(_build("enhanced"))


# H3 ---------------------------------------------------------------------------
_H3_S1 = f"""
SELECT b.*, {Q.flag('PRCP > hr_q')} AS Is_Heavy_Rain, {Q.flag('AWND > hw_q')} AS High_Wind,
       {Q.rolling_mean('TAVG', 30)} AS TAVG_30d_mean, TAVG - {Q.lag('TAVG', 1)} AS TAVG_change,
       {Q.cumsum_within('PRCP', 'site_id, year(date)')} AS PRCP_YTD,
       {Q.rolling_sum('PRCP', 30)} AS PRCP_30d_sum, {Q.rolling_sum('PRCP', 7)} AS PRCP_7d_sum,
       {Q.rolling_mean('AWND', 7)} AS AWND_7d_mean,
       CASE WHEN max(AWND) OVER {Q.rows(30)} > 0 THEN AWND / max(AWND) OVER {Q.rows(30)} * 100
            WHEN max(AWND) OVER {Q.rows(30)} IS NOT NULL THEN 0.0E0 END AS AWND_30d_pct,
       {Q.cumsum_within('GDD', 'site_id, year(date)')} AS GDD_cumsum,
       {Q.rolling_sum('GDD', 7)} AS GDD_7d, {Q.rolling_sum('GDD', 14)} AS GDD_14d, {Q.rolling_sum('GDD', 30)} AS GDD_30d,
       {Q.flag('TMIN < 0 AND ' + Q.lag('TMIN', 1) + ' >= 0')} AS Frost_Event,
       {', '.join(f"{Q.lag(c, n)} AS {c}_lag_{n}" for n in (1, 3, 7) for c in ('TMAX', 'TMIN', 'PRCP', 'AWND', 'GDD'))},
       {', '.join(f"{e} AS {c}_roll_{n}" for n in (3, 7, 14) for c, e in (('TAVG', Q.rolling_mean('TAVG', n)), ('PRCP', Q.rolling_sum('PRCP', n)), ('AWND', Q.rolling_mean('AWND', n))))},
       sum({Q.flag('PRCP > 0')}) OVER {Q.running()} AS k_rain
FROM (SELECT *, {DOY} AS Day_of_Year, {Q.weekday('date')} AS Day_of_Week,
             {_ms} AS Month_sin, {_mc} AS Month_cos, {_ds} AS DOY_sin, {_dc} AS DOY_cos,
             TMAX - TMIN AS Temp_Range, {Q.flag('PRCP > 0')} AS Is_Rainy,
             {Q.flag('TAVG > 20')} AS Above_20C, {Q.flag('TAVG < 5')} AS Below_5C, {Q.flag('TMIN < 0')} AS Freezing,
             {Q.gdd('TAVG', 5)} AS GDD, {_peaks(True)}
      FROM joined) b {_q75('PRCP', 'hr')} {_q75('AWND', 'hw')}"""
_H3_S2 = f"""
SELECT *, TAVG - TAVG_30d_mean AS Temp_Anomaly,
       stddev_samp(TAVG_change) OVER {Q.rows(7)} AS Temp_Volatility_7d,
       {', '.join(f"{Q.flag(f'round(GDD_cumsum, 9) > {v}')} AS GDD_cumsum_above_{v}" for v in (100, 200, 500))},
       GDD_cumsum * In_Tree_Season AS GDD_x_Tree_Season, GDD_cumsum * In_Grass_Season AS GDD_x_Grass_Season,
       GDD_cumsum * In_Ragweed_Season AS GDD_x_Ragweed_Season,
       TAVG * In_Tree_Season AS Temp_x_Tree_Season, TAVG * In_Grass_Season AS Temp_x_Grass_Season,
       sum(Frost_Event) OVER {Q.running()} AS k_frost,
       cast(sum({Q.flag('PRCP = 0')}) OVER {Q.running('site_id, k_rain')} AS integer) AS Days_Since_Rain
FROM ({_H3_S1}) s1"""
_H3 = f"""
{_sel(H.H3_COLUMNS)} FROM (
  SELECT *, {Q.cumsum_within('GDD', 'site_id, k_frost')} AS GDD_since_frost,
         max(Days_Since_Rain) OVER {Q.rows(7)} AS Consecutive_Dry_Days
  FROM ({_H3_S2}) s2
) t"""
query("features_weather_only", "H3", with_views(_H3, "joined"))(_build("weather_only"))


# H4 ---------------------------------------------------------------------------
_RANK_HITS = " + ".join(
    ["cast(coalesce(AWND >= AWND, false) AS integer)"]
    + [f"cast(coalesce(lag(AWND, {k}) OVER (PARTITION BY site_id ORDER BY date) >= AWND, false) AS integer)"
       for k in range(1, 30)])
_H4 = f"""
{_sel(H.H4_COLUMNS)} FROM (
  SELECT *, TAVG - {Q.rolling_mean('TAVG', 30, 7)} AS Temp_Anomaly,
         {Q.cumsum_within('PRCP', 'site_id, year(date), ' + Q.season('month(date)'))} AS Rainfall_Season_Cumsum,
         CASE WHEN count(AWND) OVER {Q.rows(30)} >= 7
              THEN ({_RANK_HITS}) * 100.0E0 / least(row_number() OVER (PARTITION BY site_id ORDER BY date), 30) END
           AS Wind_Percentile,
         {Q.lag('Total_Pollen', 1)} AS Pollen_lag_1, {Q.lag('TMAX', 1)} AS TMAX_lag_1, {Q.lag('PRCP', 1)} AS PRCP_lag_1,
         {Q.lag('Total_Pollen', 3)} AS Pollen_lag_3, {Q.lag('TMAX', 3)} AS TMAX_lag_3, {Q.lag('PRCP', 3)} AS PRCP_lag_3,
         {Q.lag('Total_Pollen', 7)} AS Pollen_lag_7,
         {', '.join(f"{e} AS {p}_roll_{n}" for n in (3, 7) for p, e in (('Pollen', Q.rolling_mean('Total_Pollen', n)), ('Temp', Q.rolling_mean('TAVG', n)), ('Rain', Q.rolling_sum('PRCP', n))))},
         {Q.cumsum_within('GDD_General', 'site_id, year(date)')} AS GDD_cumsum,
         {Q.cumsum_within('GDD_Tree', 'site_id, year(date)')} AS GDD_Tree_cumsum,
         {Q.cumsum_within('GDD_Grass', 'site_id, year(date)')} AS GDD_Grass_cumsum,
         {Q.cumsum_within('GDD_Weed', 'site_id, year(date)')} AS GDD_Weed_cumsum
  FROM (SELECT *, {Q.weekday('date')} AS Day_of_Week, month(date) AS Month_Numeric, year(date) AS Year_Numeric,
               {_ms} AS Month_sin, {_mc} AS Month_cos, {_ds} AS DOY_sin, {_dc} AS DOY_cos,
               TMAX - TMIN AS Temp_Range, {Q.flag('PRCP > 0')} AS Is_Rainy, {_gdd_species()}, {_prox()},
               TAVG * {Q.flag('month(date) IN (3, 4, 5)')} AS Temp_x_Spring,
               TAVG * {Q.flag('month(date) IN (6, 7, 8)')} AS Temp_x_Summer, PRCP * AWND AS Rain_x_Wind
        FROM joined) b
) t"""
query("features_refined", "H4", with_views(_H4, "joined"))(_build("refined"))


# H5 ---------------------------------------------------------------------------
_RI = Q.rain_intensity("PRCP")
_H5 = f"""
{_sel(H.H5_COLUMNS)} FROM (
  SELECT *, cast(row_number() OVER (PARTITION BY site_id, k_rain ORDER BY date) - 1 AS integer) AS Days_Since_Rain,
         (row_number() OVER (PARTITION BY site_id, k_rain ORDER BY date) - 1) * AWND AS Dry_x_Wind
  FROM (
    SELECT *, AWND * Temp_Range AS Ventilation_Index, Rain_Light * AWND * VPD AS Shock_Index,
           {Q.rolling_sum('GDD_General', 5, 5)} AS GDD_Burst_5d,
           {Q.cumsum_within('GDD_General', 'site_id, year(date)')} AS GDD_cumsum,
           {', '.join(f"{Q.lag(c, n)} AS {c}_lag_{n}" for n in (1, 2, 3, 7) for c in ('TMAX', 'PRCP', 'AWND', 'VPD'))},
           {', '.join(f"{e} AS {p}_roll_{n}" for n in (3, 7, 14) for p, e in (('Temp', Q.rolling_mean('TAVG', n)), ('Rain', Q.rolling_sum('PRCP', n)), ('VPD', Q.rolling_mean('VPD', n))))},
           sum({Q.flag('PRCP > 0')}) OVER {Q.running()} AS k_rain
    FROM (SELECT *, {Q.weekday('date')} AS Day_of_Week, month(date) AS Month_Numeric, year(date) AS Year_Numeric,
                 {_ms} AS Month_sin, {_mc} AS Month_cos, {_ds} AS DOY_sin, {_dc} AS DOY_cos,
                 TMAX - TMIN AS Temp_Range, {Q.flag('PRCP > 0')} AS Is_Rainy, {Q.vpd('TAVG', 'TMIN')} AS VPD,
                 {Q.flag(_RI + ' = 1')} AS Rain_Light, {Q.flag(_RI + ' = 2')} AS Rain_Heavy,
                 {_gdd_species()}, {_prox()}
          FROM joined) b
  ) s1
) t"""
query("features_abiotic", "H5", with_views(_H5, "joined"))(_build("abiotic"))


# G19 labels on the joined table ------------------------------------------------
@query("biological_labels", "G19", with_views(
    "SELECT site_id, date, " + ", ".join(f"{Q.severity_biological(t, t)} AS {t}_Severity"
                                         for t in H.POLLEN_TYPES) + " FROM joined", "joined"))
def q_bio_labels(spark, sf_dir):
    j = H.biological_labels(FX.joined(spark, sf_dir))
    return j.select("site_id", "date", *[f"{t}_Severity" for t in H.POLLEN_TYPES])


# H6 ---------------------------------------------------------------------------
def _h6_sql():
    tavg_f = "coalesce(temp_avg, (temp_max + temp_min) / 2)"
    wind = "coalesce(nullif(wind_speed, 0.0E0), 5.0E0)"
    base = f"""
SELECT request_id, pos, date, {Q.f_to_c('temp_max')} AS TMAX, {Q.f_to_c('temp_min')} AS TMIN,
       {Q.f_to_c(tavg_f)} AS TAVG, coalesce(precipitation, 0.0E0) * 25.4E0 AS PRCP, {wind} * 1.609E0 AS AWND
FROM requests"""
    vpd = f"greatest(0.0E0, {Q.sat_vp('TAVG')} - {Q.sat_vp('TMIN')})"
    s1 = f"""
SELECT *, TMAX - TMIN AS Temp_Range, CASE WHEN PRCP > 0 THEN 1 ELSE 0 END AS Is_Rainy, {vpd} AS VPD,
       CASE WHEN PRCP > 0 THEN 0 WHEN month(date) IN (6, 7, 8) THEN 3 WHEN month(date) IN (12, 1, 2) THEN 1 ELSE 2 END
         AS Days_Since_Rain,
       CASE WHEN PRCP = 0 THEN 0 WHEN PRCP <= 2.5 THEN 1 ELSE 0 END AS Rain_Light,
       CASE WHEN PRCP = 0 THEN 0 WHEN PRCP <= 2.5 THEN 0 ELSE 1 END AS Rain_Heavy,
       {Q.weekday('date')} AS Day_of_Week, {_ms} AS Month_sin, {_mc} AS Month_cos, {_ds} AS DOY_sin,
       {_dc} AS DOY_cos, year(date) AS Year_Numeric, month(date) AS Month_Numeric,
       {', '.join(f"greatest(TAVG - {b!r}, 0.0E0) AS GDD_{k}" for k, b in S.GDD_BASES.items())}, {_prox()}
FROM ({base}) b"""
    cols = {"Ventilation_Index": "AWND * Temp_Range", "Shock_Index": "Rain_Light * AWND * VPD",
            "GDD_Burst_5d": "GDD_General * 5", "GDD_cumsum": f"GDD_General * {DOY}",
            "Dry_x_Wind": "Days_Since_Rain * AWND"}
    for k in (1, 2, 3, 7):
        cols[f"TMAX_lag_{k}"] = "TMAX"
        cols[f"PRCP_lag_{k}"] = "PRCP"
        cols[f"AWND_lag_{k}"] = "AWND"
        cols[f"VPD_lag_{k}"] = "VPD"
    for n in (3, 7, 14):
        cols[f"Temp_roll_{n}"] = "TAVG"
        cols[f"Rain_roll_{n}"] = f"PRCP * {n}"
        cols[f"VPD_roll_{n}"] = "VPD"
    s2 = "SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in cols.items()) + f" FROM ({s1}) s1"
    return f"SELECT request_id, pos, {', '.join(H.H5_COLUMNS)} FROM ({s2}) s2"


@query("request_features", "H6", with_views(_h6_sql(), "requests"))
def q_request_features(spark, sf_dir):
    r = H.request_features(FX.requests(spark, sf_dir))
    return r.select("request_id", "pos", *H.H5_COLUMNS)


# H6 with request history arrays (E21 + H6) --------------------------------------
def _h6_hist_sql():
    def arr(c, n):
        return (f"list_filter(list({c}) OVER (PARTITION BY site ORDER BY date ROWS BETWEEN {n} PRECEDING AND "
                f"1 PRECEDING), lambda x: x IS NOT NULL)")
    cols = []
    for k in (1, 2, 3, 7):
        cols.append(f"CASE WHEN coalesce(len(ht), 0) >= {k} THEN {Q.f_to_c(f'ht[-{k}]')} ELSE TMAX END AS TMAX_lag_{k}")
        cols.append(f"CASE WHEN coalesce(len(hp), 0) >= {k} THEN hp[-{k}] * 25.4E0 ELSE PRCP END AS PRCP_lag_{k}")
        cols.append(f"CASE WHEN coalesce(len(hw), 0) >= {k} THEN hw[-{k}] * 1.609E0 ELSE AWND END AS AWND_lag_{k}")
    return f"""
SELECT request_id, pos, {', '.join(cols)} FROM (
  SELECT request_id, pos, {Q.f_to_c('temp_max')} AS TMAX, coalesce(precipitation, 0.0E0) * 25.4E0 AS PRCP,
         coalesce(nullif(wind_speed, 0.0E0), 5.0E0) * 1.609E0 AS AWND,
         {arr('temp_avg', 30)} AS ht, {arr('precipitation', 90)} AS hp, {arr('wind_speed', 30)} AS hw
  FROM (SELECT *, request_id // 100000 AS site FROM requests) r) t"""


@query("request_features_with_history", "H6,E21", with_views(_h6_hist_sql(), "requests"))
def q_request_features_history(spark, sf_dir):
    from aeroseries.operators import windows as W
    r = FX.requests(spark, sf_dir).withColumn("site", (F.col("request_id") / 100000).cast("bigint"))
    r = W.trailing_arrays(r, temp="temp_avg", rain="precipitation", wind="wind_speed",
                          partition_by=("site",), order_by="date")
    f = H.request_features(r)
    return f.select("request_id", "pos", *[f"{c}_lag_{k}" for k in (1, 2, 3, 7) for c in ("TMAX", "PRCP", "AWND")])
