"""Queries of the model registry (A8, I16) and of scoring through it.

The models are boosted trees of one round without a split and a forest of one
such tree, so their predictions have closed forms over the labels, and the
whole path - publish, lose files, resolve, load, score - has an exact oracle.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from aeroseries.operators import features as H
from aeroseries.operators import models as ML
from aeroseries.operators import score as J
from aeroseries.plans import sqlgen as Q
from aeroseries.plans.catalog import query
from aeroseries.plans.q_score import VALID
from aeroseries.plans.views_sql import with_views
from aeroseries.session import cut_lineage, drop_tables
from aeroseries.sources import fixtures as FX
from aeroseries.sources.registry import TOTAL, Registry
from aeroseries.streaming.stream import scratch_path

TYPES = ["Tree", "Grass", "Weed", "Ragweed", TOTAL]
# What is published, with the learning rate that tells the kinds apart.
RATES = {"weather_only": 0.9, "multi_type": 0.5}
PUBLISHED = {"weather_only": ["Tree", TOTAL], "multi_type": ["Tree", "Grass", TOTAL], "random_forest": ["Weed", TOTAL]}
L1, L2 = 3.0, 7.0


def label_of(pollen_type: str) -> str:
    return f"{pollen_type}_Severity"


def trained_models(spark, sf_dir) -> dict[tuple[str, str], object]:
    """(type, kind) -> model; the boosted ones of a kind are fitted in the same jobs."""
    labels = [label_of(t) for t in TYPES]
    rows = cut_lineage(H.biological_labels(FX.joined(spark, sf_dir)).select("site_id", "date", F.coalesce("TMAX", F.lit(0.0)).alias("TMAX"), *labels))
    out = {}
    for kind, rate in RATES.items():
        fits = ML.train_all_types(rows, ["TMAX"], [label_of(t) for t in PUBLISHED[kind]], "abiotic", None, rounds=1, rate=rate, depth=0, rows=1.0, l1=L1, l2=L2, base=0.5)
        out |= {(t, kind): fits[label_of(t)] for t in PUBLISHED[kind]}
    for t in PUBLISHED["random_forest"]:
        out[t, "random_forest"] = ML.fit(rows.na.drop(subset=[label_of(t)]), ["TMAX"], label_of(t), "small_rf", numTrees=1, maxDepth=0, bootstrap=False)
    return out


def filled_registry(spark, sf_dir, kinds=tuple(PUBLISHED)) -> Registry:
    registry = Registry(spark, scratch_path(spark, "registry"))
    for (t, kind), m in trained_models(spark, sf_dir).items():
        if kind in kinds:
            registry.publish(t, kind, m, ["TMAX"])
    return registry


def constant_sql(kind: str, label: str) -> str:
    """The kind's prediction over a column of labels, as an aggregate."""
    if kind == "random_forest":
        return f"avg({label})"
    g = f"sum(0.5 - {label})"
    return f"0.5 - sign({g}) * greatest(abs({g}) - {L1!r}, 0) / (count({label}) + {L2!r}) * {RATES[kind]!r}"


_LABELS = ("labels_long", "\nUNION ALL ".join(f"SELECT '{t}' AS pollen_type, {Q.severity_biological(t, t)} AS sev FROM joined" for t in TYPES))
_CONSTANTS = ("constants", "\nUNION ALL ".join(
    f"SELECT pollen_type, '{k}' AS model, {constant_sql(k, 'sev')} AS p FROM labels_long WHERE pollen_type IN ({', '.join(repr(t) for t in ts)}) GROUP BY pollen_type" for k, ts in PUBLISHED.items()))


# What serves each type while files disappear, and what a reload changes ------
@query("registry_resolution", "A8,I16", with_views("""
SELECT stage, c.pollen_type, c.model, c.priority, 1 AS version, round(p, 6) AS prediction, 0.0 AS reload_difference
FROM (VALUES ('all', 'Tree', 'weather_only', 1), ('all', 'Grass', 'multi_type', 2), ('all', 'Total_Pollen', 'weather_only', 1),
             ('weather_only gone', 'Tree', 'weather_only', 1), ('weather_only gone', 'Grass', 'multi_type', 2), ('weather_only gone', 'Total_Pollen', 'multi_type', 2),
             ('both gone', 'Tree', 'weather_only', 1), ('both gone', 'Grass', 'multi_type', 2), ('both gone', 'Total_Pollen', 'random_forest', 3)) c(stage, pollen_type, model, priority)
JOIN constants k ON k.pollen_type = c.pollen_type AND k.model = c.model""", "joined", extra=[_LABELS, _CONSTANTS]))
def q_registry(spark, sf_dir):
    trained = trained_models(spark, sf_dir)
    registry = Registry(spark, scratch_path(spark, "registry"))
    for (t, kind), m in trained.items():
        registry.publish(t, kind, m, ["TMAX"])
    rows = cut_lineage(FX.joined(spark, sf_dir).select("site_id", "date", F.coalesce("TMAX", F.lit(0.0)).alias("TMAX")))
    out = []
    for stage, gone in (("all", None), ("weather_only gone", "weather_only"), ("both gone", "multi_type")):
        if gone:
            drop_tables(spark, registry.load()[TOTAL].path)
        places = {r["pollen_type"]: r["priority"] for r in registry.resolve().collect()}
        for t, m in registry.load().items():
            # Every row scored by the model as it was trained and as it was stored.
            both = trained[t, m.name].transform(rows).select("TMAX", F.col("prediction").alias("before"))
            x = m.transform(both).agg(F.avg("prediction").alias("p"), F.max(F.abs(F.col("prediction") - F.col("before"))).alias("d")).first()
            out.append((stage, t, m.name, places[t], m.version, round(x["p"], 6) if x["p"] is not None else math.nan, float(x["d"] or 0.0)))
    return spark.createDataFrame(out, "stage string, pollen_type string, model string, priority int, version int, prediction double, reload_difference double")


# J1, J2, J4 by what the registry resolves ----------------------------------------------
_BASE = f"SELECT request_id, pos, date FROM requests WHERE {VALID}"


def _served(kinds: dict[str, str]) -> str:
    return "(SELECT pollen_type, model, " + Q.clip("p", 0, 10) + " AS s FROM constants WHERE " + " OR ".join(f"pollen_type = '{t}' AND model = '{k}'" for t, k in kinds.items()) + ")"


@query("score_daily_registry", "J1,I16", with_views(f"""
SELECT request_id, pos, date, round(s, 2) AS severity_score, {Q.severity_level('s')} AS severity_level, {J.DAILY_CONFIDENCE!r}E0 AS confidence, model, 1 AS version
FROM ({_BASE}) r CROSS JOIN {_served({TOTAL: 'weather_only'})} m""", "requests", "joined", extra=[_LABELS, _CONSTANTS]))
def q_daily_registry(spark, sf_dir):
    return J.score_daily_resolved(FX.requests(spark, sf_dir), filled_registry(spark, sf_dir)).drop("raw_score", "recommendation")


@query("score_weekly_registry", "J2,I16", with_views(f"""
SELECT request_id, pos, date, round(s, 2) AS severity_score, {Q.severity_level('s')} AS severity_level, {J.WEEKLY_CONFIDENCE!r}E0 AS confidence, model, 1 AS version
FROM ({_BASE}) r CROSS JOIN {_served({TOTAL: 'multi_type'})} m""", "requests", "joined", extra=[_LABELS, _CONSTANTS]))
def q_weekly_registry(spark, sf_dir):
    # No weather-only model is there: the multi-type one serves.
    registry = filled_registry(spark, sf_dir, ("multi_type", "random_forest"))
    return J.score_weekly_resolved(FX.requests(spark, sf_dir), registry).drop("raw_score")


@query("score_allergens_registry", "J4,I16", with_views(f"""
SELECT request_id, pos, date, pollen_type AS allergen_type, CASE pollen_type WHEN 'Tree' THEN 0 WHEN 'Grass' THEN 1 END AS idx, round(s, 6) AS score, model, 1 AS version
FROM ({_BASE}) r CROSS JOIN {_served({'Tree': 'weather_only', 'Grass': 'multi_type'})} m""", "requests", "joined", extra=[_LABELS, _CONSTANTS]))
def q_allergens_registry(spark, sf_dir):
    # Weed has only a forest, which may serve the total alone; Ragweed has none.
    return J.score_allergens_resolved(FX.requests(spark, sf_dir), filled_registry(spark, sf_dir)).withColumn("score", F.round("score", 6))
