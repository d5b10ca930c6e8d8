"""Scalar functions (Column -> Column), all native Spark expressions.

Null rules follow the pandas behaviour of the original analysis:
comparisons with a missing value are false (flags use ``flag``), NumPy
``maximum`` propagates missing values (``gdd``, ``vpd`` guard with
``isNotNull`` because Spark's ``greatest`` skips nulls).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the original analysis (stated plainly).
# ---------------------------------------------------------------------------
# Biological base thresholds per pollen type (5-point sets, total has 10).
BIO_THRESHOLDS = {
    "Tree": [0, 1, 15, 90, 1500],
    "Grass": [0, 1, 5, 20, 200],
    "Weed": [0, 1, 10, 50, 500],
    "Ragweed": [0, 1, 10, 50, 500],
    "Total_Pollen": [0, 10, 30, 60, 100, 200, 500, 1000, 2000, 5000],
}
# Level names per type, next to the base sets.
BIO_LEVEL_NAMES = {
    "Tree": ["None", "Low", "Moderate", "High", "Very High"],
    "Grass": ["None", "Low", "Moderate", "High", "Very High"],
    "Weed": ["None", "Low", "Moderate", "High", "Very High"],
    "Ragweed": ["None", "Low", "Moderate", "High", "Very High"],
    "Total_Pollen": ["None", "Low", "Low-Mod", "Moderate", "Mod-High", "High", "Very High",
                     "Extreme", "Severe", "Critical"],
}
# Percentiles used for percentile-based severity cut points.
SEVERITY_PERCENTILES = [0, 10, 25, 40, 55, 70, 80, 85, 90, 95, 100]
# Names of the percentile severities 0 to 9.
SEVERITY_NAMES = ["None", "Very Low", "Low", "Low-Mod", "Moderate", "Mod-High", "High", "Very High", "Extreme", "Severe"]
# Fixed count cut points of the scoring service (severity 0..9).
FIXED_SEVERITY_CUTS = [0.6, 3.0, 7.0, 14.0, 29.0, 61.0, 131.0, 202.5, 341.3, 642.8]
# Severity level names, index = floor(score) capped at 9.
SEVERITY_LEVELS = ["None", "Very Low", "Low", "Low-Moderate", "Moderate", "Moderate-High",
                   "High", "Very High", "Extreme", "Severe"]
# Typical monthly temperature (F) of the scoring service; other months 60.
SEASONAL_TEMPERATURE_F = {1: 32, 2: 35, 3: 45, 4: 57, 5: 67, 6: 76, 7: 81, 8: 79, 9: 71,
                          10: 59, 11: 47, 12: 36}
# Peak day-of-year for the Gaussian proximity features and for days-to-peak.
PEAK_PROXIMITY_DOY = {"Tree": 110, "Grass": 175, "Weed": 255}
DAYS_TO_PEAK_DOY = {"Tree": 105, "Grass": 165, "Ragweed": 255}
# In-season day-of-year windows (inclusive); season progress starts at the lower bound.
SEASON_WINDOWS = {"Tree": (60, 150), "Grass": (120, 210), "Ragweed": (210, 300)}
# GDD base temperatures (C).
GDD_BASES = {"General": 5.0, "Tree": 5.0, "Grass": 10.0, "Weed": 8.0}
# Unit factors.
INCH_TO_MM = 25.4
MPH_TO_MS = 0.44704
MPH_TO_KMH = 1.609


def flag(pred: Column) -> Column:
    """Boolean predicate as 0/1 int; a null comparison is 0 (pandas semantics)."""
    return F.coalesce(pred, F.lit(False)).cast("int")


# G1 -------------------------------------------------------------------------
def calendar_parts(d: Column) -> dict[str, Column]:
    """year, month, day of year, day of week (Monday = 0), ISO week."""
    return {
        "Year": F.year(d),
        "Month": F.month(d),
        "Day_of_Year": F.dayofyear(d),
        "Day_of_Week": F.weekday(d),
        "Week_of_Year": F.weekofyear(d),
    }


# G2 -------------------------------------------------------------------------
def cyclical(value: Column, period: float) -> tuple[Column, Column]:
    ang = F.lit(2 * math.pi) * value / F.lit(float(period))
    return F.sin(ang), F.cos(ang)


# G3 -------------------------------------------------------------------------
def season(month: Column) -> Column:
    return (F.when(month.isin(3, 4, 5), "Spring").when(month.isin(6, 7, 8), "Summer")
            .when(month.isin(9, 10, 11), "Fall").otherwise("Winter"))


# G4, G5, G7, G10, G11 -------------------------------------------------------
def temp_range(tmax: Column, tmin: Column) -> Column:
    return tmax - tmin


def is_rainy(prcp: Column) -> Column:
    return flag(prcp > 0)


def above(c: Column, v: float) -> Column:
    return flag(c > v)


def below(c: Column, v: float) -> Column:
    return flag(c < v)


def ventilation_index(wind: Column, trange: Column) -> Column:
    return wind * trange


def shock_index(rain_light: Column, wind: Column, vpd_col: Column) -> Column:
    return rain_light * wind * vpd_col


# G6 -------------------------------------------------------------------------
def rain_intensity(prcp: Column) -> Column:
    """Right-closed bins (-1,0] -> 0, (0,2.5] -> 1, (2.5,1000] -> 2, else null."""
    return (F.when((prcp > -1) & (prcp <= 0), F.lit(0.0))
            .when((prcp > 0) & (prcp <= 2.5), F.lit(1.0))
            .when((prcp > 2.5) & (prcp <= 1000), F.lit(2.0)))


def rain_light(prcp: Column) -> Column:
    return flag(rain_intensity(prcp) == 1)


def rain_heavy(prcp: Column) -> Column:
    return flag(rain_intensity(prcp) == 2)


# G8 -------------------------------------------------------------------------
def gdd(t: Column, base: float) -> Column:
    """max(t - base, 0); null stays null."""
    return F.when(t.isNotNull(), F.greatest(t - F.lit(float(base)), F.lit(0.0)))


# G9 -------------------------------------------------------------------------
def saturation_vp(t: Column) -> Column:
    return F.lit(0.6108) * F.exp(F.lit(17.27) * t / (t + F.lit(237.3)))


def vpd(t_avg: Column, t_min: Column, rh: Column | None = None) -> Column:
    """Vapour pressure deficit (kPa); T_min stands in for the dew point when no
    humidity column is given.  Null inputs give null."""
    es = saturation_vp(t_avg)
    ea = es * rh / F.lit(100.0) if rh is not None else saturation_vp(t_min)
    return F.when(es.isNotNull() & ea.isNotNull(), F.greatest(F.lit(0.0), es - ea))


# G12-G15 --------------------------------------------------------------------
def peak_proximity(doy: Column, peak: float) -> Column:
    return F.exp(F.lit(-0.5) * F.pow((doy - F.lit(float(peak))) / F.lit(30.0), 2))


def days_to_peak(doy: Column, peak: int) -> Column:
    return F.abs(doy - F.lit(peak))


def in_season(doy: Column, lo: int, hi: int) -> Column:
    return flag((doy >= lo) & (doy <= hi))


def clip(c: Column, lo: float, hi: float) -> Column:
    """Bound to [lo, hi]; null stays null."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(lo))), F.lit(float(hi))))


def season_progress(doy: Column, start: int) -> Column:
    return clip((doy - F.lit(start)) / F.lit(90.0), 0.0, 1.0)


# G17 ------------------------------------------------------------------------
def gdd_trigger(gdd_cumsum: Column, level: float) -> Column:
    """Running GDD above ``level``, compared at 1e-9.  The original adds with
    compensation, so that a sum of exactly ``level`` isn't above it; a plain sum
    can be off in the last digit there, and engines add in different orders."""
    return flag(F.round(gdd_cumsum, 9) > level)


# G18 ------------------------------------------------------------------------
def severity_percentile(count: Column, thr: Column) -> Column:
    """``thr`` is an array column of 11 cut points.  0 for a zero count, else the
    highest i in 10..1 with count >= thr[i], else 0; null gives 0."""
    expr = F.when(count == 0, F.lit(0))
    for i in range(10, 0, -1):
        expr = expr.when(count >= F.element_at(thr, i + 1), F.lit(i))
    return expr.otherwise(F.lit(0))


# G19 ------------------------------------------------------------------------
def extended_thresholds(base: list[float]) -> list[float]:
    """5-point base sets are widened to 11 points; other sets are used as is."""
    if len(base) != 5:
        return [float(x) for x in base]
    t = [float(x) for x in base]
    return [t[0], t[1], (t[1] + t[2]) / 2, t[2], (t[2] + t[3]) / 2, t[3], (t[3] + t[4]) / 2,
            t[4], t[4] * 1.5, t[4] * 2.5, t[4] * 5]


def severity_biological(count: Column, pollen_type: str) -> Column:
    ext = extended_thresholds(BIO_THRESHOLDS[pollen_type])
    n = len(ext)
    expr = F.when(count.isNull() | (count == 0), F.lit(0.0))
    for i in range(n - 1, 0, -1):
        expr = expr.when(count >= F.lit(ext[i]), F.lit(min(10.0, i * (10.0 / (n - 1)))))
    return expr.otherwise(F.lit(0.0))


# G20 ------------------------------------------------------------------------
def severity_fixed(count: Column) -> Column:
    expr = F.when(count <= 0, F.lit(0.0))
    for i in range(len(FIXED_SEVERITY_CUTS) - 1, -1, -1):
        expr = expr.when(count >= F.lit(FIXED_SEVERITY_CUTS[i]), F.lit(float(i)))
    return expr.otherwise(F.lit(0.0))


# G21-G23, G26 ---------------------------------------------------------------
def severity_level(score: Column) -> Column:
    idx = F.least(F.greatest(F.floor(score), F.lit(0)), F.lit(9)).cast("int")
    return F.element_at(F.array(*[F.lit(x) for x in SEVERITY_LEVELS]), idx + 1)


RECOMMENDATIONS = [
    "Pollen is low: outdoor activity is fine.",
    "Pollen is moderate: sensitive people should watch for symptoms.",
    "Pollen is high: shorten time outdoors.",
    "Pollen is very high: people with allergies should stay inside when they can.",
    "Pollen is extreme: stay inside and keep windows shut.",
]


def recommendation(score: Column) -> Column:
    return (F.when(score <= 2, RECOMMENDATIONS[0]).when(score <= 4, RECOMMENDATIONS[1])
            .when(score <= 6, RECOMMENDATIONS[2]).when(score <= 8, RECOMMENDATIONS[3])
            .otherwise(RECOMMENDATIONS[4]))


def alert_level(total: Column) -> Column:
    return (F.when(total <= 3, "Low").when(total <= 5, "Moderate").when(total <= 7, "High")
            .otherwise("Severe"))


def display_band(score: Column) -> Column:
    return (F.when(score <= 2, "Low").when(score <= 4, "Moderate").when(score <= 6, "High")
            .when(score <= 8, "Very High").otherwise("Severe"))


# G24 ------------------------------------------------------------------------
def level_name_biological(count: Column, pollen_type: str) -> Column:
    """Name of the highest base threshold reached (below the first: first name)."""
    base = BIO_THRESHOLDS[pollen_type]
    names = BIO_LEVEL_NAMES[pollen_type]
    expr = None
    for i in range(len(base) - 1, -1, -1):
        cond = count >= F.lit(float(base[i]))
        expr = F.when(cond, names[i]) if expr is None else expr.when(cond, names[i])
    return expr.otherwise(names[0])


# G25 ------------------------------------------------------------------------
# Tier scales: (upper bounds, names).  Values are the original cut points.
TIER_SCALES = {
    "mae_0_10": ([1.0, 2.0, 3.0], ["Excellent", "Good", "Okay", "Poor"]),
    "mae_biological": ([0.35, 0.45, 0.60], ["Exceptional", "Excellent", "Good", "Acceptable"]),
    "mae_weather_only": ([0.50, 0.70, 0.90], ["Excellent", "Good", "Fair", "Limited"]),
    "mae_average": ([0.60, 0.80], ["Viable", "Acceptable", "Needs history"]),
}


def performance_tier(mae: Column, scale: str = "mae_0_10") -> Column:
    cuts, names = TIER_SCALES[scale]
    expr = F.when(mae <= cuts[0], names[0])
    for c, n in zip(cuts[1:], names[1:]):
        expr = expr.when(mae <= c, n)
    return expr.otherwise(names[-1])


def relative_change(mae: Column, best: Column) -> Column:
    """Percent by which ``mae`` exceeds ``best``; null when ``best`` is 0."""
    return F.try_divide(mae - best, best) * 100


def relative_change_tier(pct: Column) -> Column:
    """Relative MAE change: < 50 weather carries the signal, < 100 both, else history
    (also where the change is null)."""
    return (F.when(pct < 50, "Weather captures most signal").when(pct < 100, "History matters")
            .otherwise("History dominates"))


def benefit_tier(improvement: Column) -> Column:
    return (F.when(improvement > 5, "Significant benefit").when(improvement > 0, "Modest benefit")
            .when(improvement > -5, "Similar").otherwise("Other regime better"))


# G27 ------------------------------------------------------------------------
def f_to_c(c: Column) -> Column:
    return (c - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)


def inch_to_mm(c: Column) -> Column:
    return c * F.lit(INCH_TO_MM)


def mph_to_ms(c: Column) -> Column:
    return c * F.lit(MPH_TO_MS)


def mph_to_kmh(c: Column) -> Column:
    return c * F.lit(MPH_TO_KMH)


# G28 ------------------------------------------------------------------------
def estimate_days_since_rain(month: Column, rain: Column) -> Column:
    return (F.when(rain > 0, F.lit(0)).when(month.isin(6, 7, 8), F.lit(3))
            .when(month.isin(12, 1, 2), F.lit(1)).otherwise(F.lit(2)))


# G29 ------------------------------------------------------------------------
def first_truthy(*cols: Column) -> Column:
    """First alias that is neither null nor zero."""
    return F.coalesce(*[F.nullif(c, F.lit(0)) for c in cols])


# G30 ------------------------------------------------------------------------
def seasonal_temperature(month: Column) -> Column:
    expr = None
    for m, t in SEASONAL_TEMPERATURE_F.items():
        expr = F.when(month == m, F.lit(float(t))) if expr is None else expr.when(month == m, F.lit(float(t)))
    return expr.otherwise(F.lit(60.0))
