"""Batch scoring of forecast requests.

The request/response service of the original is re-aimed as table jobs: a
request table (one row per requested day; weekly requests are 1-7 rows with a
``pos``) is validated, turned into features (H6), scored by a fitted
``PipelineModel`` (or any scorer with the same ``transform`` contract), and
summarised.  The allergen scores of a request day are one array in its row, so
totals, ranks, shares and alerts are expressions of that row: no shuffle, and
sums in the array's order.  Weekly groups are at most 7 rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroseries.functions import scalars as S
from aeroseries.operators.clean import align_features, validate_requests
from aeroseries.operators.features import H5_COLUMNS, request_features
from aeroseries.operators.windows import forecast_lags

# Reported confidence of daily and weekly forecasts.
DAILY_CONFIDENCE = 0.87
WEEKLY_CONFIDENCE = 0.84
# Allergen order of the per-type models, and of the seasonal allocation.
ALLERGENS_MODEL_ORDER = ["Tree", "Grass", "Weed", "Ragweed"]
ALLERGENS_SEASON_ORDER = ["Tree", "Grass", "Ragweed", "Weed"]
# Seasonal shares (tree, grass, ragweed, weed) by month group.
SEASON_SHARES = {
    "spring": ([3, 4, 5], [0.6, 0.2, 0.1, 0.1]),
    "summer": ([6, 7, 8], [0.1, 0.7, 0.1, 0.1]),
    "fall": ([9, 10], [0.1, 0.2, 0.5, 0.2]),
    "other": ([11, 12, 1, 2], [0.3, 0.1, 0.1, 0.5]),
}
WEEKLY_SUMMARIES = [
    "Low pollen expected all week.",
    "Moderate pollen expected: check the daily forecast.",
    "High pollen expected: plan time indoors.",
    "Very high pollen expected: take precautions.",
]


def _predict(features: DataFrame, model, names: Sequence[str] | None, keep: Sequence[str]) -> DataFrame:
    names = list(names or H5_COLUMNS)
    x = align_features(features, names, keep=keep)
    return model.transform(x)


# J1 ---------------------------------------------------------------------------
def score_daily(requests: DataFrame, model, feature_names: Sequence[str] | None = None,
                keys: Sequence[str] = ("request_id", "pos"), with_inputs: bool = False) -> DataFrame:
    """Valid requests -> features -> predict -> clip [0, 10] -> score rounded to
    2, level and advice from the unrounded score, confidence 0.87.
    ``with_inputs`` keeps the filled request temperature (``temp_avg_f``) for
    the seasonal allocation, so it needs no join back to the requests."""
    v = validate_requests(requests).filter("is_valid")
    f = request_features(v)
    p = _predict(f, model, feature_names, keep=[*keys, "date", "temp_avg_f"])
    s = S.clip(F.col("prediction"), 0, 10)
    out = p.select(*keys, "date", F.round(s, 2).alias("severity_score"), s.alias("raw_score"),
                   S.severity_level(s).alias("severity_level"),
                   F.lit(DAILY_CONFIDENCE).alias("confidence"), S.recommendation(s).alias("recommendation"),
                   "temp_avg_f")
    return out.drop("temp_avg_f") if not with_inputs else out


def score_history(site_days: DataFrame, model, feature_names: Sequence[str] | None = None,
                  keys: Sequence[str] = ("site_id", "date")) -> DataFrame:
    """Score site-days from their true history: the abiotic features (H5)
    computed over each site's series instead of the one-row stand-ins of H6;
    days without a complete feature row are not scored."""
    from aeroseries.operators.features import abiotic_features
    f = abiotic_features(site_days).na.drop(subset=list(feature_names or H5_COLUMNS))
    return score_history_features(f, model, feature_names, keys)


def score_history_features(features: DataFrame, model, feature_names: Sequence[str] | None = None,
                           keys: Sequence[str] = ("site_id", "date")) -> DataFrame:
    p = _predict(features, model, feature_names, keep=list(keys))
    s = S.clip(F.col("prediction"), 0, 10)
    return p.select(*keys, F.round(s, 2).alias("severity_score"), s.alias("raw_score"),
                    S.severity_level(s).alias("severity_level"), S.recommendation(s).alias("recommendation"))


# J2 ---------------------------------------------------------------------------
def score_weekly(requests: DataFrame, model, feature_names: Sequence[str] | None = None) -> DataFrame:
    """1-7 days per request; each day's lags come from the forecast's earlier
    days (E22); confidence 0.84."""
    v = validate_requests(requests).filter("is_valid")
    f = forecast_lags(request_features(v))
    p = _predict(f, model, feature_names, keep=["request_id", "pos", "date"])
    s = S.clip(F.col("prediction"), 0, 10)
    return p.select("request_id", "pos", "date", F.round(s, 2).alias("severity_score"), s.alias("raw_score"),
                    S.severity_level(s).alias("severity_level"), F.lit(WEEKLY_CONFIDENCE).alias("confidence"))


# J3 ---------------------------------------------------------------------------
def weekly_summary(weekly: DataFrame) -> DataFrame:
    """Mean of the rounded scores with 4 texts (cuts <= 3, 5, 7); peak day = the
    first day with the largest unrounded score, null when all scores are 0."""
    avg = F.avg("severity_score")
    text = (F.when(avg <= 3, WEEKLY_SUMMARIES[0]).when(avg <= 5, WEEKLY_SUMMARIES[1])
            .when(avg <= 7, WEEKLY_SUMMARIES[2]).otherwise(WEEKLY_SUMMARIES[3]))
    peak = F.min_by("date", F.struct((-F.col("raw_score")).alias("s"), F.col("pos").alias("p")))
    return weekly.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("days"), avg.alias("avg_severity"),
        F.when(F.max("raw_score") > 0, peak).alias("peak_day"), text.alias("summary"))


# J4 ---------------------------------------------------------------------------
def _entry(t: str, i: int, score: Column) -> Column:
    return F.struct(F.lit(t).alias("allergen_type"), F.lit(i).alias("idx"), score.alias("score"))


def model_entries(requests: DataFrame, models: dict[str, object],
                  feature_names: Sequence[str] | None = None,
                  keys: Sequence[str] = ("request_id", "pos")) -> DataFrame:
    """Per-type models one after the other on one frame of request features:
    (keys, date, entries), ``entries`` the clipped scores in model order."""
    v = validate_requests(requests).filter("is_valid")
    x = align_features(request_features(v), list(feature_names or H5_COLUMNS), keep=[*keys, "date"])
    types = [t for t in ALLERGENS_MODEL_ORDER if t in models]
    own = list(x.columns)
    for t in types:
        p = models[t].transform(x.select(*own))
        own.append(f"__score_{t}")
        x = p.withColumn(own[-1], S.clip(F.col("prediction"), 0, 10))
    entries = F.array(*[_entry(t, ALLERGENS_MODEL_ORDER.index(t), F.col(f"__score_{t}")) for t in types])
    return x.select(*keys, "date", entries.alias("entries"))


def score_allergens(requests: DataFrame, models: dict[str, object],
                    feature_names: Sequence[str] | None = None,
                    keys: Sequence[str] = ("request_id", "pos")) -> DataFrame:
    """Per-type models on the request features, each clipped; long form
    (keys, date, allergen_type, idx, score) with ``idx`` the model order."""
    return model_entries(requests, models, feature_names, keys).select(*keys, "date", F.inline_outer("entries"))


# J1, J2, J4 through the registry ------------------------------------------------
def _named(df: DataFrame, resolved) -> DataFrame:
    return df.withColumns({"model": F.lit(resolved.name), "version": F.lit(resolved.version)})


def score_daily_resolved(requests: DataFrame, registry, total: str = "Total_Pollen", with_inputs: bool = False) -> DataFrame:
    """J1 with the model that the registry resolves for the total, and its name and version."""
    m = resolved_total(registry, total)
    return _named(score_daily(requests, m, m.features, with_inputs=with_inputs), m)


def score_weekly_resolved(requests: DataFrame, registry, total: str = "Total_Pollen") -> DataFrame:
    """J2 with the model that the registry resolves for the total, and its name and version."""
    m = resolved_total(registry, total)
    return _named(score_weekly(requests, m, m.features), m)


def resolved_total(registry, total: str = "Total_Pollen"):
    """The total's model; without one nothing can be scored."""
    models = registry.load()
    if total not in models:
        raise LookupError(f"the registry has no model for {total}")
    return models[total]


def score_allergens_resolved(requests: DataFrame, registry, keys: Sequence[str] = ("request_id", "pos")) -> DataFrame:
    """J4 with the model that the registry resolves for each allergen; types
    without one have no rows.  Where no type has one, the day's severity is
    split by season instead (J5)."""
    models = {t: m for t, m in registry.load().items() if t in ALLERGENS_MODEL_ORDER}
    if not models:
        daily = score_daily_resolved(requests, registry, with_inputs=True)
        return allocate_by_season(daily, keys).withColumns({"model": F.lit("season"), "version": F.lit(0)})
    names = list(dict.fromkeys(f for m in models.values() for f in m.features))
    rows = score_allergens(requests, models, names, keys)
    used = lambda what: F.element_at(F.create_map(*[x for t, m in models.items() for x in (F.lit(t), F.lit(getattr(m, what)))]), F.col("allergen_type"))
    return rows.withColumns({"model": used("name"), "version": used("version")})


# J5 ---------------------------------------------------------------------------
def season_entries(daily: DataFrame) -> DataFrame:
    """Without allergen models: the day's severity split by the month's shares
    times a temperature factor (> 75 F: 1.2, < 50 F: 0.7) of the request's
    (filled) average temperature, 65 F when unknown.  ``daily`` comes from
    ``score_daily(..., with_inputs=True)``; adds ``entries`` in the order tree,
    grass, ragweed, weed."""
    t = F.coalesce(F.col("temp_avg_f"), F.lit(65.0))
    m = F.month("date")
    factor = F.when(t > 75, 1.2).when(t < 50, 0.7).otherwise(1.0)
    share_arr = None
    for months, shares in SEASON_SHARES.values():
        arr = F.array(*[F.lit(float(x)) for x in shares])
        share_arr = F.when(m.isin(*months), arr) if share_arr is None else share_arr.when(m.isin(*months), arr)
    return daily.withColumn("entries", F.array(*[
        _entry(t, i, F.col("raw_score") * F.element_at(share_arr, i + 1) * factor)
        for i, t in enumerate(ALLERGENS_SEASON_ORDER)]))


def allocate_by_season(daily: DataFrame, keys: Sequence[str] = ("request_id", "pos")) -> DataFrame:
    """J5 in long form, like J4."""
    return season_entries(daily).select(*keys, "date", F.inline_outer("entries"))


# J6 ---------------------------------------------------------------------------
def _summary(entries: str = "entries") -> dict[str, Column]:
    """Of one row's entries: the total (added in the entries' order), the first
    entry with the greatest score above 0, else Grass, and the alert level of
    the unrounded total."""
    total = F.aggregate(entries, F.lit(0.0), lambda acc, e: acc + e["score"])
    best = F.array_min(F.transform(entries, lambda e: F.struct((-e["score"]).alias("s"), e["idx"], e["allergen_type"])))
    return {"total": total, "primary": F.when(best["s"] < 0, best["allergen_type"]).otherwise(F.lit("Grass")),
            "alert": S.alert_level(total)}


def ranked_allergens(df: DataFrame) -> DataFrame:
    """From ``entries``: ``allergens``, ranked (rounded score desc, ties in input
    order) with rounded score, level and share (1 decimal, 0 when the total is
    0), and the row's total_severity, primary_allergen and alert_level."""
    s = _summary()
    df = df.withColumns({"__total": s["total"], "primary_allergen": s["primary"], "alert_level": s["alert"]})
    order = F.array_sort(F.transform("entries", lambda e: F.struct(
        (-F.round(e["score"], 2)).alias("o"), e["idx"].alias("idx"), e["allergen_type"].alias("allergen_type"),
        e["score"].alias("score"))))
    ranked = F.transform(order, lambda e, i: F.struct(
        (i + 1).alias("rank"), e["allergen_type"].alias("allergen_type"),
        F.round(e["score"], 2).alias("severity_score"), S.severity_level(e["score"]).alias("severity_level"),
        F.when(F.col("__total") > 0, F.round(e["score"] / F.col("__total") * 100, 1)).otherwise(F.lit(0.0))
        .alias("contribution_pct")))
    return df.withColumns({"allergens": ranked, "total_severity": F.round("__total", 2)}).drop("__total", "entries")


def allergen_breakdown(scores: DataFrame, keys: Sequence[str] = ("request_id", "pos")) -> DataFrame:
    """One row per allergen of the rows of ``season_entries`` or ``model_entries``."""
    r = ranked_allergens(scores)
    return r.select(*keys, "date", "total_severity", "primary_allergen", "alert_level", F.inline_outer("allergens"))


def allergen_response(scores: DataFrame, keys: Sequence[str] = ("request_id", "pos")) -> DataFrame:
    """Nested response per request day: allergens as a ranked array of structs."""
    return ranked_allergens(scores).select(*keys, "date", "total_severity", "primary_allergen", "alert_level", "allergens")


# J7 ---------------------------------------------------------------------------
def dominant_allergen(df: DataFrame, types: Sequence[str] = ("Tree", "Grass", "Weed", "Ragweed")) -> Column:
    """Type with the highest count (first in ``types`` on ties); 'None' when all are 0."""
    mx = F.greatest(*[F.col(t) for t in types])
    expr = F.when(mx.isNull() | (mx <= 0), F.lit("None"))
    for t in types:
        expr = expr.when(F.col(t) == mx, F.lit(t))
    return expr


# J8 ---------------------------------------------------------------------------
def high_risk_days(df: DataFrame, count_col: str = "Total_Pollen", severity_col: str | None = None,
                   q: float = 0.75, by: Sequence[str] = ("site_id",)) -> DataFrame:
    """Planned rule (count above the q-quantile, per site) and built rule (severity >= 7)."""
    qt = df.groupBy(*by).agg(F.percentile(F.col(count_col), F.lit(q)).alias("__q"))
    j = df.join(qt, list(by), "left")
    out = j.withColumn("high_risk_quantile", S.flag(F.col(count_col) > F.col("__q"))).drop("__q")
    if severity_col:
        out = out.withColumn("high_risk_severity", S.flag(F.col(severity_col) >= 7))
    return out


# J9 ---------------------------------------------------------------------------
def expand_sparse_history(df: DataFrame, yesterday="pollen_1", three_days="pollen_3", seven_days="pollen_7",
                          avg_temp="avg_temp_30", rain_total="rain_season", avg_wind="avg_wind_30") -> DataFrame:
    """Form-style history to request arrays: pollen [d7 x4, d3, d3, d1] (parts
    only when yesterday is given), 30 copies of the average temperature and
    wind, and a one-element rain list."""
    d1, d3, d7 = F.col(yesterday), F.col(three_days), F.col(seven_days)
    base = F.when(d1.isNotNull(), F.array(d1))
    with3 = F.when(d1.isNotNull() & d3.isNotNull(), F.concat(F.array(d3, d3), F.array(d1))).otherwise(base)
    fill7 = F.array_repeat(d7, F.greatest(F.lit(7) - F.size(with3), F.lit(0)))
    pollen = F.when(d1.isNotNull() & d7.isNotNull(), F.concat(fill7, with3)).otherwise(with3)
    return df.withColumns({
        "historical_pollen": pollen,
        "historical_temps": F.when(F.col(avg_temp).isNotNull(), F.array_repeat(F.col(avg_temp), 30)),
        "historical_precip": F.when(F.col(rain_total).isNotNull(), F.array(F.col(rain_total))),
        "historical_wind": F.when(F.col(avg_wind).isNotNull(), F.array_repeat(F.col(avg_wind), 30)),
    })


# J10 --------------------------------------------------------------------------
def full_report(daily: DataFrame, entries: str | None = "entries") -> DataFrame:
    """Daily score with the request's allergen summary in the same row; without
    ``entries`` the summary is null."""
    if entries is None:
        none = F.lit(None)
        return daily.withColumns({"total_severity": none.cast("double"), "primary_allergen": none.cast("string"),
                                  "alert_level": none.cast("string")})
    s = _summary(entries)
    return daily.withColumns({"total_severity": F.round(s["total"], 2), "primary_allergen": s["primary"],
                              "alert_level": s["alert"]}).drop(entries)
