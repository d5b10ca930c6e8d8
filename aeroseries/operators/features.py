"""Composite feature sets (H1-H6) and severity labels.

Each set is a few ``withColumns`` phases (base scalars and lags, windows over
derived columns, interactions) over the site-day table.  Every window is keyed
by ``site_id`` first, so the whole set costs one exchange on ``site_id``; the
``(site_id, year)`` / ``(site_id, streak)`` windows add sorts only.  Whole-table
quantiles (``High_Wind``, ``Is_Heavy_Rain``) are per site by default - with a
single site this is the whole table.

The column lists are the selected features, in selection order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroseries.functions import scalars as S
from aeroseries.operators import windows as W
from aeroseries.operators.profile import upper_quartile_flag, upper_quartile_flags

SITE = ("site_id",)
POLLEN_TYPES = ["Tree", "Grass", "Weed", "Ragweed", "Total_Pollen"]


def _doy(d="date"):
    return F.dayofyear(d)


# Severity labels (G19 applied to each pollen column present) -----------------
def biological_labels(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    return df.withColumns({f"{t}_Severity": S.severity_biological(F.col(t), t)
                           for t in POLLEN_TYPES if t in have})


# H1 ---------------------------------------------------------------------------
H1_COLUMNS = (
    ["TMAX", "TMIN", "TAVG", "PRCP", "AWND", "Temp_Range", "Is_Rainy", "High_Wind"]
    + ["Month", "Day_of_Year", "Day_of_Week", "Month_sin", "Month_cos", "Day_of_Year_sin",
       "Day_of_Year_cos"]
    + [f"{p}_lag_{n}" for n in (1, 3, 7) for p in ("Pollen", "TMAX", "PRCP")]
    + [f"{p}_{n}" for n in (3, 7, 14) for p in ("Pollen_roll_mean", "Temp_roll_mean", "Precip_roll_sum")]
    + ["GDD", "GDD_cumsum"])


def baseline_features(df: DataFrame, partition_by=SITE, quantile_by: Sequence[str] = SITE) -> DataFrame:
    p = dict(partition_by=partition_by)
    m, doy = F.month("date"), _doy()
    ms, mc = S.cyclical(m, 12)
    ds, dc = S.cyclical(doy, 365)
    df = df.withColumns({
        "Year": F.year("date"), "Month": m, "Day_of_Year": doy, "Day_of_Week": F.weekday("date"),
        "Month_sin": ms, "Month_cos": mc, "Day_of_Year_sin": ds, "Day_of_Year_cos": dc,
        "Temp_Range": F.col("TMAX") - F.col("TMIN"), "Is_Rainy": S.is_rainy(F.col("PRCP")),
        "GDD": S.gdd(F.col("TAVG"), 5.0),
    })
    df = upper_quartile_flag(df, "AWND", "High_Wind", by=quantile_by, window=True)
    new = {}
    for n in (1, 3, 7):
        new[f"Pollen_lag_{n}"] = W.lag("Total_Pollen", n, **p)
        new[f"TMAX_lag_{n}"] = W.lag("TMAX", n, **p)
        new[f"PRCP_lag_{n}"] = W.lag("PRCP", n, **p)
    for n in (3, 7, 14):
        new[f"Pollen_roll_mean_{n}"] = W.rolling_mean("Total_Pollen", n, **p)
        new[f"Temp_roll_mean_{n}"] = W.rolling_mean("TAVG", n, **p)
        new[f"Precip_roll_sum_{n}"] = W.rolling_sum("PRCP", n, **p)
    new["GDD_cumsum"] = W.ytd_cumsum("GDD", **p)
    return df.withColumns(new)


# H2 ---------------------------------------------------------------------------
H2_COLUMNS = (
    ["TMAX", "TMIN", "TAVG", "PRCP", "AWND", "Temp_Range", "Is_Rainy",
     "Temp_Anomaly", "TAVG_change", "TAVG_volatility_7d",
     "PRCP_YTD", "PRCP_30d_sum", "Consecutive_Dry_Days", "Consecutive_Wet_Days",
     "Day_of_Week", "Month_sin", "Month_cos", "DOY_sin", "DOY_cos"]
    + [f"{p}_lag_{n}" for n in (1, 3, 7) for p in ("Pollen", "TMAX", "PRCP")]
    + [f"{p}_{n}" for n in (3, 7, 14) for p in ("Pollen_roll_mean", "Temp_roll_mean", "Precip_roll_sum")]
    + ["GDD", "GDD_cumsum", "GDD_7d", "GDD_14d", "GDD_30d", "GDD_since_frost", "Below_Freezing",
       "Days_to_Tree_Peak", "In_Tree_Season", "Days_to_Grass_Peak", "In_Grass_Season",
       "Days_to_Ragweed_Peak", "In_Ragweed_Season"])


def _peak_days(doy: Column, with_progress: bool = False) -> dict[str, Column]:
    out = {}
    for t in ("Tree", "Grass", "Ragweed"):
        lo, hi = S.SEASON_WINDOWS[t]
        out[f"Days_to_{t}_Peak"] = S.days_to_peak(doy, S.DAYS_TO_PEAK_DOY[t])
        out[f"In_{t}_Season"] = S.in_season(doy, lo, hi)
        if with_progress:
            out[f"{t}_Season_Progress"] = S.season_progress(doy, lo)
    return out


def enhanced_features(df: DataFrame, partition_by=SITE) -> DataFrame:
    p = dict(partition_by=partition_by)
    m, doy = F.month("date"), _doy()
    ms, mc = S.cyclical(m, 12)
    ds, dc = S.cyclical(doy, 365)
    df = df.withColumns({
        "Year": F.year("date"), "Day_of_Year": doy, "Day_of_Week": F.weekday("date"),
        "Month_sin": ms, "Month_cos": mc, "DOY_sin": ds, "DOY_cos": dc,
        "Temp_Range": F.col("TMAX") - F.col("TMIN"), "Is_Rainy": S.is_rainy(F.col("PRCP")),
        "GDD": S.gdd(F.col("TAVG"), 5.0), "Below_Freezing": S.below(F.col("TMIN"), 0),
        **_peak_days(doy),
    })
    new = {
        "TAVG_30d_mean": W.rolling_mean("TAVG", 30, **p),
        "PRCP_YTD": W.ytd_cumsum("PRCP", **p),
        "PRCP_30d_sum": W.rolling_sum("PRCP", 30, **p),
        "GDD_cumsum": W.ytd_cumsum("GDD", **p),
        "GDD_7d": W.rolling_sum("GDD", 7, **p),
        "GDD_14d": W.rolling_sum("GDD", 14, **p),
        "GDD_30d": W.rolling_sum("GDD", 30, **p),
        "Frost_Event": W.frost_event("TMIN", **p),
        "TAVG_change": W.diff("TAVG", **p),
        "AWND_30d_pct": W.share_of_max("AWND", 30, **p),
    }
    for n in (1, 3, 7):
        new[f"Pollen_lag_{n}"] = W.lag("Total_Pollen", n, **p)
        new[f"TMAX_lag_{n}"] = W.lag("TMAX", n, **p)
        new[f"PRCP_lag_{n}"] = W.lag("PRCP", n, **p)
    for n in (3, 7, 14):
        new[f"Pollen_roll_mean_{n}"] = W.rolling_mean("Total_Pollen", n, **p)
        new[f"Temp_roll_mean_{n}"] = W.rolling_mean("TAVG", n, **p)
        new[f"Precip_roll_sum_{n}"] = W.rolling_sum("PRCP", n, **p)
    df = df.withColumns(new)
    df = df.withColumns({
        "Temp_Anomaly": F.col("TAVG") - F.col("TAVG_30d_mean"),
        "TAVG_volatility_7d": W.rolling_std("TAVG_change", 7, **p),
    })
    df = W.gdd_since_frost(df, "GDD", "TMIN", **p)
    df = W.dry_streak(df, "PRCP", "Consecutive_Dry_Days", **p)
    return W.wet_count(df, "PRCP", "Consecutive_Wet_Days", **p)


# H3 ---------------------------------------------------------------------------
H3_COLUMNS = (
    ["TMAX", "TMIN", "TAVG", "PRCP", "AWND", "Temp_Range", "Is_Rainy", "Is_Heavy_Rain",
     "Day_of_Week", "Month_sin", "Month_cos", "DOY_sin", "DOY_cos",
     "Temp_Anomaly", "TAVG_change", "Temp_Volatility_7d", "Above_20C", "Below_5C", "Freezing",
     "PRCP_YTD", "PRCP_30d_sum", "PRCP_7d_sum", "Consecutive_Dry_Days",
     "AWND_7d_mean", "AWND_30d_pct", "High_Wind",
     "GDD", "GDD_cumsum", "GDD_7d", "GDD_14d", "GDD_30d", "GDD_since_frost",
     "GDD_cumsum_above_100", "GDD_cumsum_above_200", "GDD_cumsum_above_500",
     "Days_to_Tree_Peak", "In_Tree_Season", "Tree_Season_Progress",
     "Days_to_Grass_Peak", "In_Grass_Season", "Grass_Season_Progress",
     "Days_to_Ragweed_Peak", "In_Ragweed_Season", "Ragweed_Season_Progress"]
    + [f"{p}_lag_{n}" for n in (1, 3, 7) for p in ("TMAX", "TMIN", "PRCP", "AWND", "GDD")]
    + [f"{p}_roll_{n}" for n in (3, 7, 14) for p in ("TAVG", "PRCP", "AWND")]
    + ["GDD_x_Tree_Season", "GDD_x_Grass_Season", "GDD_x_Ragweed_Season",
       "Temp_x_Tree_Season", "Temp_x_Grass_Season"])


def weather_only_features(df: DataFrame, partition_by=SITE, quantile_by: Sequence[str] = SITE) -> DataFrame:
    p = dict(partition_by=partition_by)
    m, doy = F.month("date"), _doy()
    ms, mc = S.cyclical(m, 12)
    ds, dc = S.cyclical(doy, 365)
    tavg, tmin = F.col("TAVG"), F.col("TMIN")
    df = df.withColumns({
        "Year": F.year("date"), "Day_of_Year": doy, "Day_of_Week": F.weekday("date"),
        "Week_of_Year": F.weekofyear("date"),
        "Month_sin": ms, "Month_cos": mc, "DOY_sin": ds, "DOY_cos": dc,
        "Temp_Range": F.col("TMAX") - tmin, "Is_Rainy": S.is_rainy(F.col("PRCP")),
        "Above_20C": S.above(tavg, 20), "Below_5C": S.below(tavg, 5), "Freezing": S.below(tmin, 0),
        "GDD": S.gdd(tavg, 5.0),
        **_peak_days(doy, with_progress=True),
    })
    df = upper_quartile_flags(df, {"PRCP": "Is_Heavy_Rain", "AWND": "High_Wind"}, by=quantile_by, window=True)
    new = {
        "TAVG_30d_mean": W.rolling_mean("TAVG", 30, **p),
        "TAVG_change": W.diff("TAVG", **p),
        "PRCP_YTD": W.ytd_cumsum("PRCP", **p),
        "PRCP_30d_sum": W.rolling_sum("PRCP", 30, **p),
        "PRCP_7d_sum": W.rolling_sum("PRCP", 7, **p),
        "AWND_7d_mean": W.rolling_mean("AWND", 7, **p),
        "AWND_30d_pct": W.share_of_max("AWND", 30, **p),
        "GDD_cumsum": W.ytd_cumsum("GDD", **p),
        "GDD_7d": W.rolling_sum("GDD", 7, **p),
        "GDD_14d": W.rolling_sum("GDD", 14, **p),
        "GDD_30d": W.rolling_sum("GDD", 30, **p),
        "Frost_Event": W.frost_event("TMIN", **p),
    }
    for n in (1, 3, 7):
        for c in ("TMAX", "TMIN", "PRCP", "AWND", "GDD"):
            new[f"{c}_lag_{n}"] = W.lag(c, n, **p)
    for n in (3, 7, 14):
        new[f"TAVG_roll_{n}"] = W.rolling_mean("TAVG", n, **p)
        new[f"PRCP_roll_{n}"] = W.rolling_sum("PRCP", n, **p)
        new[f"AWND_roll_{n}"] = W.rolling_mean("AWND", n, **p)
    df = df.withColumns(new)
    gc = F.col("GDD_cumsum")
    df = df.withColumns({
        "Temp_Anomaly": tavg - F.col("TAVG_30d_mean"),
        "Temp_Volatility_7d": W.rolling_std("TAVG_change", 7, **p),
        "GDD_cumsum_above_100": S.gdd_trigger(gc, 100),
        "GDD_cumsum_above_200": S.gdd_trigger(gc, 200),
        "GDD_cumsum_above_500": S.gdd_trigger(gc, 500),
        "GDD_x_Tree_Season": gc * F.col("In_Tree_Season"),
        "GDD_x_Grass_Season": gc * F.col("In_Grass_Season"),
        "GDD_x_Ragweed_Season": gc * F.col("In_Ragweed_Season"),
        "Temp_x_Tree_Season": tavg * F.col("In_Tree_Season"),
        "Temp_x_Grass_Season": tavg * F.col("In_Grass_Season"),
    })
    df = W.gdd_since_frost(df, "GDD", "TMIN", **p)
    df = W.days_since_rain_dry(df, "PRCP", "Days_Since_Rain", **p)
    return df.withColumn("Consecutive_Dry_Days", W.rolling_max("Days_Since_Rain", 7, **p))


# H4 ---------------------------------------------------------------------------
H4_COLUMNS = (
    ["TMAX", "TMIN", "TAVG", "PRCP", "AWND", "Temp_Range", "Is_Rainy",
     "Temp_Anomaly", "Rainfall_Season_Cumsum", "Wind_Percentile",
     "Day_of_Week", "Month_sin", "Month_cos", "DOY_sin", "DOY_cos", "Year_Numeric", "Month_Numeric",
     "Pollen_lag_1", "TMAX_lag_1", "PRCP_lag_1", "Pollen_lag_3", "TMAX_lag_3", "PRCP_lag_3",
     "Pollen_lag_7"]
    + [f"{p}_roll_{n}" for n in (3, 7) for p in ("Pollen", "Temp", "Rain")]
    + ["GDD_General", "GDD_Tree", "GDD_Grass", "GDD_Weed", "GDD_cumsum", "GDD_Tree_cumsum",
       "GDD_Grass_cumsum", "GDD_Weed_cumsum", "Tree_Peak_Prox", "Grass_Peak_Prox", "Weed_Peak_Prox",
       "Temp_x_Spring", "Temp_x_Summer", "Rain_x_Wind"])


def _gdd_species(tavg: Column) -> dict[str, Column]:
    return {f"GDD_{k}": S.gdd(tavg, b) for k, b in S.GDD_BASES.items()}


def _peak_prox(doy: Column) -> dict[str, Column]:
    return {f"{t}_Peak_Prox": S.peak_proximity(doy, d) for t, d in S.PEAK_PROXIMITY_DOY.items()}


def refined_features(df: DataFrame, partition_by=SITE) -> DataFrame:
    p = dict(partition_by=partition_by)
    m, doy = F.month("date"), _doy()
    ms, mc = S.cyclical(m, 12)
    ds, dc = S.cyclical(doy, 365)
    tavg = F.col("TAVG")
    df = df.withColumns({
        "Day_of_Week": F.weekday("date"), "Month_Numeric": m, "Year_Numeric": F.year("date"),
        "Day_of_Year": doy, "Month_sin": ms, "Month_cos": mc, "DOY_sin": ds, "DOY_cos": dc,
        "Temp_Range": F.col("TMAX") - F.col("TMIN"), "Is_Rainy": S.is_rainy(F.col("PRCP")),
        "Season": S.season(m),
        **_gdd_species(tavg), **_peak_prox(doy),
        "Temp_x_Spring": tavg * S.flag(m.isin(3, 4, 5)),
        "Temp_x_Summer": tavg * S.flag(m.isin(6, 7, 8)),
        "Rain_x_Wind": F.col("PRCP") * F.col("AWND"),
    })
    new = {
        "TAVG_30day": W.rolling_mean("TAVG", 30, 7, **p),
        "Rainfall_Season_Cumsum": W.season_cumsum("PRCP", "Season", **p),
        "Wind_Percentile": W.window_rank_pct("AWND", 30, 7, **p),
    }
    for n in (1, 3, 7):
        new[f"Pollen_lag_{n}"] = W.lag("Total_Pollen", n, **p)
        if n <= 3:
            new[f"TMAX_lag_{n}"] = W.lag("TMAX", n, **p)
            new[f"PRCP_lag_{n}"] = W.lag("PRCP", n, **p)
    for n in (3, 7):
        new[f"Pollen_roll_{n}"] = W.rolling_mean("Total_Pollen", n, **p)
        new[f"Temp_roll_{n}"] = W.rolling_mean("TAVG", n, **p)
        new[f"Rain_roll_{n}"] = W.rolling_sum("PRCP", n, **p)
    for k in ("", "Tree_", "Grass_", "Weed_"):
        src = "GDD_General" if k == "" else f"GDD_{k[:-1]}"
        new[f"GDD_{k}cumsum"] = W.ytd_cumsum(src, **p)
    df = df.withColumns(new)
    return df.withColumn("Temp_Anomaly", tavg - F.col("TAVG_30day"))


# H5 ---------------------------------------------------------------------------
# The original selector lists GDD_Burst_5d twice (56 names); a DataFrame keeps
# the 55 distinct names in first-occurrence order.
H5_COLUMNS = (
    ["VPD", "Ventilation_Index", "Shock_Index", "GDD_Burst_5d", "Days_Since_Rain", "Rain_Light",
     "Rain_Heavy", "TMAX", "TMIN", "TAVG", "PRCP", "AWND", "Temp_Range", "Is_Rainy",
     "Day_of_Week", "Month_sin", "Month_cos", "DOY_sin", "DOY_cos", "Year_Numeric", "Month_Numeric"]
    + [f"{p}_lag_{n}" for n in (1, 2, 3, 7) for p in ("TMAX", "PRCP", "AWND", "VPD")]
    + [f"{p}_roll_{n}" for n in (3, 7, 14) for p in ("Temp", "Rain", "VPD")]
    + ["GDD_General", "GDD_Tree", "GDD_Grass", "GDD_Weed", "GDD_cumsum",
       "Tree_Peak_Prox", "Grass_Peak_Prox", "Weed_Peak_Prox", "Dry_x_Wind"])


def abiotic_features(df: DataFrame, partition_by=SITE) -> DataFrame:
    p = dict(partition_by=partition_by)
    m, doy = F.month("date"), _doy()
    ms, mc = S.cyclical(m, 12)
    ds, dc = S.cyclical(doy, 365)
    tavg, prcp, awnd = F.col("TAVG"), F.col("PRCP"), F.col("AWND")
    rh = F.col("RH") if "RH" in df.columns else None
    vpd = S.vpd(tavg, F.col("TMIN"), rh)
    df = df.withColumns({
        "Day_of_Week": F.weekday("date"), "Month_Numeric": m, "Year_Numeric": F.year("date"),
        "Day_of_Year": doy, "Month_sin": ms, "Month_cos": mc, "DOY_sin": ds, "DOY_cos": dc,
        "Temp_Range": F.col("TMAX") - F.col("TMIN"), "Is_Rainy": S.is_rainy(prcp),
        "VPD": vpd, "Rain_Intensity": S.rain_intensity(prcp),
        "Rain_Light": S.rain_light(prcp), "Rain_Heavy": S.rain_heavy(prcp),
        **_gdd_species(tavg), **_peak_prox(doy),
    })
    df = df.withColumns({
        "Ventilation_Index": awnd * F.col("Temp_Range"),
        "Shock_Index": F.col("Rain_Light") * awnd * F.col("VPD"),
    })
    new = {
        "GDD_Burst_5d": W.rolling_sum_strict("GDD_General", 5, **p),
        "GDD_cumsum": W.ytd_cumsum("GDD_General", **p),
    }
    for n in (1, 2, 3, 7):
        for c in ("TMAX", "PRCP", "AWND", "VPD"):
            new[f"{c}_lag_{n}"] = W.lag(c, n, **p)
    for n in (3, 7, 14):
        new[f"Temp_roll_{n}"] = W.rolling_mean("TAVG", n, **p)
        new[f"Rain_roll_{n}"] = W.rolling_sum("PRCP", n, **p)
        new[f"VPD_roll_{n}"] = W.rolling_mean("VPD", n, **p)
    df = df.withColumns(new)
    df = W.days_since_rain_rows(df, "PRCP", "Days_Since_Rain", **p)
    return df.withColumn("Dry_x_Wind", F.col("Days_Since_Rain") * awnd)


# H6 ---------------------------------------------------------------------------
def request_inputs(df: DataFrame) -> DataFrame:
    """Request defaults and unit conversion: midpoint temp_avg, wind 0 / null ->
    5 mph, rain null -> 0; metric TMAX / TMIN / TAVG (C), PRCP (mm), AWND (km/h)."""
    tmax, tmin = F.col("temp_max"), F.col("temp_min")
    return df.withColumns({
        "temp_avg_f": F.coalesce(F.col("temp_avg"), (tmax + tmin) / 2),
        "wind_mph": F.coalesce(F.nullif(F.col("wind_speed"), F.lit(0.0)), F.lit(5.0)),
        "precipitation": F.coalesce(F.col("precipitation"), F.lit(0.0)),
    }).withColumns({
        "TMAX": S.f_to_c(tmax), "TMIN": S.f_to_c(tmin), "TAVG": S.f_to_c(F.col("temp_avg_f")),
        "PRCP": F.col("precipitation") * F.lit(S.INCH_TO_MM),
        "AWND": F.col("wind_mph") * F.lit(S.MPH_TO_KMH),
    })


def _hist(arr: str, k: int, convert, fallback: Column, have: set) -> Column:
    if arr not in have:
        return fallback
    a = F.col(arr)
    ok = F.coalesce(F.size(a) >= k, F.lit(False))
    return F.when(ok, convert(F.try_element_at(a, F.lit(-k)))).otherwise(fallback)


def request_features(df: DataFrame) -> DataFrame:
    """The H5 names from one request row with stand-ins for history: rolling
    means = today's value, rolling rain = n x today, burst = 5 x GDD,
    GDD_cumsum = GDD x day of year, VPD lags = today's VPD, days since rain
    estimated from the month, lags from the history arrays or today's value."""
    df = request_inputs(df)
    have = set(df.columns)
    m, doy = F.month("date"), _doy()
    ms, mc = S.cyclical(m, 12)
    ds, dc = S.cyclical(doy, 365)
    tmax, tavg, prcp, awnd = F.col("TMAX"), F.col("TAVG"), F.col("PRCP"), F.col("AWND")
    vpd = F.greatest(F.lit(0.0), S.saturation_vp(tavg) - S.saturation_vp(F.col("TMIN")))
    light = F.when(prcp == 0, 0).when(prcp <= 2.5, 1).otherwise(0)
    heavy = F.when(prcp == 0, 0).when(prcp <= 2.5, 0).otherwise(1)
    df = df.withColumns({
        "Temp_Range": tmax - F.col("TMIN"), "Is_Rainy": F.when(prcp > 0, 1).otherwise(0),
        "VPD": vpd, "Days_Since_Rain": S.estimate_days_since_rain(m, prcp),
        "Rain_Light": light, "Rain_Heavy": heavy,
        "Day_of_Week": F.weekday("date"), "Month_sin": ms, "Month_cos": mc, "DOY_sin": ds,
        "DOY_cos": dc, "Year_Numeric": F.year("date"), "Month_Numeric": m,
        **{f"GDD_{k}": F.greatest(tavg - F.lit(b), F.lit(0.0)) for k, b in S.GDD_BASES.items()},
        **_peak_prox(doy),
    })
    gg = F.col("GDD_General")
    out = {
        "Ventilation_Index": awnd * F.col("Temp_Range"),
        "Shock_Index": F.col("Rain_Light") * awnd * F.col("VPD"),
        "GDD_Burst_5d": gg * 5, "GDD_cumsum": gg * doy,
        "Dry_x_Wind": F.col("Days_Since_Rain") * awnd,
    }
    for k in (1, 2, 3, 7):
        out[f"TMAX_lag_{k}"] = _hist("historical_temps", k, S.f_to_c, tmax, have)
        out[f"PRCP_lag_{k}"] = _hist("historical_precip", k, lambda c: c * F.lit(S.INCH_TO_MM), prcp, have)
        out[f"AWND_lag_{k}"] = _hist("historical_wind", k, lambda c: c * F.lit(S.MPH_TO_KMH), awnd, have)
        out[f"VPD_lag_{k}"] = F.col("VPD")
    for n in (3, 7, 14):
        out[f"Temp_roll_{n}"] = tavg
        out[f"Rain_roll_{n}"] = prcp * n
        out[f"VPD_roll_{n}"] = F.col("VPD")
    return df.withColumns(out)


FEATURE_SETS = {
    "baseline": (baseline_features, H1_COLUMNS),
    "enhanced": (enhanced_features, H2_COLUMNS),
    "weather_only": (weather_only_features, H3_COLUMNS),
    "refined": (refined_features, H4_COLUMNS),
    "abiotic": (abiotic_features, H5_COLUMNS),
}


def build(df: DataFrame, name: str, keep: Sequence[str] = ("site_id", "date")) -> DataFrame:
    """Feature set ``name`` projected to ``keep`` + its selected columns."""
    fn, cols = FEATURE_SETS[name]
    out = fn(df)
    extra = [c for c in keep if c not in cols]
    return out.select(*extra, *cols)
