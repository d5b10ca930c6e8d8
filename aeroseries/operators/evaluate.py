"""Evaluation helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroseries.functions.scalars import clip
from aeroseries.operators.metrics import macro_average, metrics_full

# Which engineered names can be computed from date + weather
# input alone (names containing these parts, or equal to these names).
WEATHER_NAME_PARTS = ["Month_", "DOY_", "Day_of_Week", "Year_Numeric", "Month_Numeric",
                      "Temp_Anomaly", "TAVG_30day", "Wind_Percentile", "Rainfall_Season_Cumsum",
                      "Season", "GDD", "Peak_Prox", "TMAX_lag_", "PRCP_lag_", "Temp_roll_", "Rain_roll_"]
WEATHER_NAMES = ["TMAX", "TMIN", "AWND", "PRCP", "TAVG", "Temp_Range", "Is_Rainy",
                 "Temp_x_Spring", "Temp_x_Summer", "Rain_x_Wind"]
# Further parts of the wider list, which the comparison of models
# trained with and without pollen history goes by.
WIDER_NAME_PARTS = ["VPD", "Ventilation_Index", "Shock_Index", "Days_Since_Rain", "Rain_Light", "Rain_Heavy",
                    "Temp_x_Spring", "Temp_x_Summer", "Rain_x_Wind", "Dry_x_Wind", "AWND_lag_", "VPD_lag_", "VPD_roll_"]


def is_weather_derivable(name: str, wider: bool = False) -> bool:
    parts = WEATHER_NAME_PARTS + (WIDER_NAME_PARTS if wider else [])
    return name in WEATHER_NAMES or any(p in name for p in parts)


# B14 --------------------------------------------------------------------------
def classify_features(names: Sequence[str], wider: bool = False) -> tuple[list[str], list[str]]:
    """(weather-derivable, needs pollen history), de-duplicated, order kept."""
    uniq = list(dict.fromkeys(names))
    ok = {n: is_weather_derivable(n, wider) for n in uniq}
    return [n for n in uniq if ok[n]], [n for n in uniq if not ok[n]]


# I15 --------------------------------------------------------------------------
def feature_coverage(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per feature of ``df``: weather-derivable or not and its non-null share;
    one aggregate pass over the data, then a long table."""
    feats = list(dict.fromkeys(features))
    g = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"),
                            *[F.count(F.col(f)).alias(f"__c{i}") for i, f in enumerate(feats)])
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(is_weather_derivable(f)).alias("weather_derivable"),
                             (F.col(f"__c{i}") / F.col("__n")).alias("non_null_share"))
                    for i, f in enumerate(feats)])
    return g.select(*by, F.inline(arr))


def coverage_summary(coverage: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return coverage.groupBy(*by).agg(
        F.count(F.lit(1)).alias("features"), F.count_if("weather_derivable").alias("available"),
        F.count_if(~F.col("weather_derivable")).alias("excluded"),
        (F.count_if("weather_derivable") * 100.0 / F.count(F.lit(1))).alias("available_pct"))


# I12 --------------------------------------------------------------------------
def residuals(model: PipelineModel, df: DataFrame, label: str,
              keys: Sequence[str] = ("site_id", "date")) -> DataFrame:
    p = model.transform(df)
    return p.select(*keys, F.col(label).alias("actual"), F.col("prediction").alias("predicted"),
                    (F.col(label) - F.col("prediction")).alias("residual"))


# I13 --------------------------------------------------------------------------
def without_history(df: DataFrame, features: Sequence[str], wider: bool = False) -> DataFrame:
    """Pollen-history features set to 0, weather-derivable ones kept."""
    return df.withColumns({f: F.lit(0.0) for f in classify_features(features, wider)[1]})


def evaluate_without_history(models: dict[str, PipelineModel], test: DataFrame,
                             features: Sequence[str], wider: bool = False) -> tuple[DataFrame, DataFrame]:
    """Score each per-type model on its test rows with only weather-derivable
    features (the rest zeroed); D18 per type and the D20 macro average.
    Test rows are the tail cut before dropping incomplete rows; here rows
    missing a weather-derivable feature or the label are dropped."""
    weather, _ = classify_features(features, wider)
    parts = []
    for lab, m in models.items():
        rows = test.na.drop(subset=weather + [lab])
        p = m.transform(without_history(rows, features, wider))
        parts.append(p.select(F.lit(lab).alias("pollen_type"), F.col(lab).alias("actual"),
                              clip(F.col("prediction"), 0, 10).alias("predicted")))
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    per_type = metrics_full(allp, by=("pollen_type",))
    return per_type, macro_average(per_type)
