"""Queries for I/O (A4-A9), metadata helpers (B13, B15) and SQL functions (L1)."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from aeroseries.functions.sqlfuncs import register_sql_functions
from aeroseries.operators import clean as B
from aeroseries.operators import features as H
from aeroseries.operators import joins as C
from aeroseries.operators import metrics as M
from aeroseries.operators import models as ML
from aeroseries.operators import splits as SP
from aeroseries.operators.boosting import BoostedModel
from aeroseries.plans import sqlgen as Q
from aeroseries.plans.catalog import query
from aeroseries.plans.q_features import _H4, _H5
from aeroseries.plans.q_profile import metrics_sql
from aeroseries.plans.views_sql import with_views
from aeroseries.session import cut_lineage
from aeroseries.sources import fixtures as FX
from aeroseries.sources import io as IO
from aeroseries.streaming.stream import scratch_path


# A4 ---------------------------------------------------------------------------
@query("require_columns", "A4", with_views("SELECT STATION, DATE, TMAX, PRCP FROM weather_raw", "weather_raw"))
def q_require(spark, sf_dir):
    return B.require_columns(FX.weather_raw(spark, sf_dir), ["STATION", "DATE", "TMAX", "RH", "PRCP"])


# A5 + A1 + A9 -----------------------------------------------------------------
def _rec_sql():
    names = ["rows", "stations", "first_day", "last_day"] + [f"pct_{v}" for v in ("TMAX", "TMIN", "PRCP", "AWND")]
    exprs = ["cast(count(*) AS double)", "cast(count(DISTINCT STATION) AS double)",
             "cast(min(date_diff('day', DATE '1970-01-01', DATE)) AS double)",
             "cast(max(date_diff('day', DATE '1970-01-01', DATE)) AS double)"]
    exprs += [f"count({v}) * 100.0E0 / count(*)" for v in ("TMAX", "TMIN", "PRCP", "AWND")]
    parts = [f"SELECT '{n}' AS check, {e} AS source_value, {e} AS target_value, true AS ok FROM weather_raw"
             for n, e in zip(names, exprs)]
    return with_views("\nUNION ALL ".join(parts), "weather_raw")


@query("write_and_reconcile", "A1,A5,A9", _rec_sql())
def q_write_reconcile(spark, sf_dir):
    src = FX.weather_raw(spark, sf_dir)
    out = scratch_path(spark, "a5-daily")
    IO.write_daily(src.drop("site_id"), out, fmt="csv", site=("STATION",), date_col="DATE")
    back = IO.read_station_weather(spark, out, fmt="csv")
    return IO.reconcile(src, back)


# A7 + A6 + G29 ----------------------------------------------------------------
@query("metric_documents", "A6,A7,G29", with_views("""
SELECT model, mae, rmse, r2, CASE WHEN model LIKE 'Rolling%' THEN acc_within_1 END AS acc_within_1
FROM models WHERE mae IS NOT NULL AND mae <> 0 AND r2 IS NOT NULL AND r2 <> 0""",
    "model_predictions", extra=[("models", metrics_sql("model_predictions", ["model"]))]))
def q_metric_docs(spark, sf_dir):
    m = M.metrics_full(FX.model_predictions(spark, sf_dir), by=("model",))
    m = m.withColumn("style", F.when(F.col("model").startswith("Rolling"), "plain").otherwise("test"))
    path = scratch_path(spark, "a7-metrics")
    IO.write_metric_documents(m, path)
    r = IO.read_metrics(spark, path)
    return r.select("model", "mae", "rmse", "r2", "acc_within_1")


@query("write_metrics_tidy", "A7", with_views("""
SELECT model, metric, value FROM (
  SELECT model, cast(n AS double) AS n, mae, rmse, r2, weighted_mae, acc_within_1, acc_within_2, high_mae,
         cast(high_count AS double) AS high_count FROM models) t
UNPIVOT INCLUDE NULLS (value FOR metric IN (n, mae, rmse, r2, weighted_mae, acc_within_1, acc_within_2, high_mae,
                                             high_count))""",
    "model_predictions", extra=[("models", metrics_sql("model_predictions", ["model"]))]))
def q_write_metrics(spark, sf_dir):
    m = M.metrics_full(FX.model_predictions(spark, sf_dir), by=("model",))
    path = scratch_path(spark, "a7-tidy")
    IO.write_metrics(m, path)
    return spark.read.schema("model string, metric string, value double").json(path)


# A document of metrics by type beside documents of single models ----------------
_PERSISTED = """
SELECT site_id, date, pollen_type, sev AS actual, lag(sev) OVER (PARTITION BY site_id, pollen_type ORDER BY date) AS predicted FROM (
""" + "\nUNION ALL ".join(f"SELECT site_id, date, '{t}' AS pollen_type, {Q.severity_biological(t, t)} AS sev FROM joined" for t in ("Tree", "Grass", "Total_Pollen")) + ") t"


@query("multitype_metric_documents", "A6", with_views("""
SELECT 'Multi-type' AS model, nullif(mae, 0) AS mae, nullif(rmse, 0) AS rmse, nullif(r2, 0) AS r2, nullif(acc_within_1, 0) AS acc_within_1, nullif(acc_within_2, 0) AS acc_within_2
FROM per_type WHERE pollen_type = 'Total_Pollen' AND mae <> 0 AND r2 <> 0
UNION ALL SELECT model, mae, rmse, r2, acc_within_1, NULL FROM models WHERE model LIKE 'Rolling%' AND mae <> 0 AND r2 <> 0""", "joined", "model_predictions",
    extra=[("persisted", _PERSISTED), ("per_type", metrics_sql("persisted", ["pollen_type"])), ("models", metrics_sql("model_predictions", ["model"]))]))
def q_multitype_docs(spark, sf_dir):
    j = H.biological_labels(FX.joined(spark, sf_dir))
    types = ("Tree", "Grass", "Total_Pollen")
    long = j.select("site_id", "date", F.expr(f"stack({len(types)}, " + ", ".join(f"'{t}', {t}_Severity" for t in types) + ") AS (pollen_type, actual)"))
    yesterday = F.lag("actual").over(Window.partitionBy("site_id", "pollen_type").orderBy("date"))
    per_type = M.metrics_full(long.withColumn("predicted", yesterday), by=("pollen_type",))
    path, single = scratch_path(spark, "a6-types"), scratch_path(spark, "a6-single")
    IO.write_multitype_metrics(per_type, path)
    m = M.metrics_full(FX.model_predictions(spark, sf_dir), by=("model",)).where(F.col("model").startswith("Rolling"))
    IO.write_metric_documents(m.withColumn("style", F.lit("plain")), single)
    columns = ["model", "mae", "rmse", "r2", "acc_within_1"]
    out = IO.read_multitype_metrics(spark, path, "Multi-type").select(*columns, "acc_within_2")
    return out.unionByName(IO.read_metrics(spark, single).select(*columns, F.lit(None).cast("double").alias("acc_within_2")))


# A5 + C1 + H5: a table kept by site feeds the features without an exchange ------------
@query("features_from_buckets", "A5,C1,H5", with_views("SELECT site_id, date, " + ", ".join(H.H5_COLUMNS) + " FROM h5", "joined", extra=[("h5", _H5)]))
def q_bucketed(spark, sf_dir):
    return H.abiotic_features(bucketed_joined(spark, sf_dir)).select("site_id", "date", *H.H5_COLUMNS)


def bucketed_joined(spark, sf_dir, buckets=8):
    """C1 over pollen and weather stored by site, stored by site itself."""
    name = f"aeroseries_{uuid.uuid4().hex}"
    parts = [IO.write_bucketed(v(spark, sf_dir), f"{name}_{tag}", scratch_path(spark, f"a5-{tag}"), buckets) for tag, v in (("pollen", FX.pollen), ("weather", FX.weather_site))]
    return IO.write_bucketed(C.join_daily(*parts), f"{name}_joined", scratch_path(spark, "a5-buckets"), buckets)


# A8 ---------------------------------------------------------------------------
@query("model_save_load", "A8")
def q_model_roundtrip(spark, sf_dir):
    j = H.biological_labels(FX.joined(spark, sf_dir))
    f = H.abiotic_features(j).select("site_id", "date", *H.H5_COLUMNS, "Total_Pollen_Severity")
    f = SP.split_positional(f.na.drop(subset=list(H.H5_COLUMNS)), 0.8)
    m = ML.fit(f.filter(F.col("role") == "train"), H.H5_COLUMNS, "Total_Pollen_Severity", "linear")
    path = scratch_path(spark, "a8-model")
    IO.save_model(m, H.H5_COLUMNS, path)
    loaded, names = IO.load_model(spark, path)
    return ML.evaluate(loaded, f.filter(F.col("role") == "test"), "Total_Pollen_Severity") \
        .withColumn("features", F.lit(len(names)))


_INPUTS = ["TMAX", "TMIN", "AWND"]


@query("model_reload_differences", "A8", with_views(
    f"SELECT kind, count(*) AS n, 0 AS different, {len(_INPUTS)} AS features FROM joined CROSS JOIN (VALUES ('pipeline'), ('boosted')) k(kind) WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in _INPUTS) + " GROUP BY kind", "joined"))
def q_model_reload(spark, sf_dir):
    """Every complete row scored by a model as it was fitted and as it was read again."""
    j = H.biological_labels(FX.joined(spark, sf_dir))
    f = cut_lineage(j.select("site_id", "date", *_INPUTS, "Total_Pollen_Severity").na.drop(subset=_INPUTS))
    label = "Total_Pollen_Severity"
    fits = {"pipeline": ML.fit(f.na.drop(subset=[label]), _INPUTS, label, "linear"), "boosted": ML.train_all_types(f, _INPUTS, [label], "refined", None, rounds=3)[label]}
    out = None
    for kind, m in fits.items():
        path = scratch_path(spark, f"a8-{kind}")
        if kind == "boosted":
            m.save(spark, path)
            loaded, names = BoostedModel.load(spark, path), m.features
        else:
            IO.save_model(m, _INPUTS, path)
            loaded, names = IO.load_model(spark, path)
        both = loaded.transform(m.transform(f).select(*f.columns, F.col("prediction").alias("before")))
        g = both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") != F.col("prediction")).alias("different"))
        g = g.select(F.lit(kind).alias("kind"), "n", "different", F.lit(len(names)).alias("features"))
        out = g if out is None else out.unionByName(g)
    return out


# B13 --------------------------------------------------------------------------
_PATTERNS = ["lag_", "roll_", "GDD", "Peak_Prox", "_x_"]


def _pattern_cols():
    return B.select_by_pattern(H.H4_COLUMNS, literal=["TMAX", "TMIN", "TAVG", "PRCP", "AWND"],
                               contains=_PATTERNS, ban="Pollen")


@query("select_by_pattern", "B13", with_views(
    "SELECT site_id, date, " + ", ".join(_pattern_cols()) + " FROM h4", "joined", extra=[("h4", _H4)]))
def q_select_pattern(spark, sf_dir):
    f = H.build(FX.joined(spark, sf_dir), "refined")
    return f.select("site_id", "date", *_pattern_cols())


# B15 --------------------------------------------------------------------------
@query("suffix_collisions", "B15", with_views("""
SELECT j.*, w.TMAX AS TMAX_weather, w.TMIN AS TMIN_weather, w.TAVG AS TAVG_weather, w.PRCP AS PRCP_weather,
       w.AWND AS AWND_weather
FROM joined j JOIN weather_site w ON j.site_id = w.site_id AND j.date = w.date""", "joined"))
def q_suffix(spark, sf_dir):
    return C.join_daily(FX.joined(spark, sf_dir), FX.weather_site(spark, sf_dir))


# L1 ---------------------------------------------------------------------------
@query("sql_functions", "L1", with_views(f"""
SELECT site_id, date, {Q.gdd('TAVG', 5)} AS gdd5, {Q.vpd('TAVG', 'TMIN')} AS vpd,
       {Q.severity_biological('Tree', 'Tree')} AS tree_severity,
       {Q.severity_level(Q.severity_biological('Total_Pollen', 'Total_Pollen'))} AS total_level,
       {Q.season('month(date)')} AS season
FROM joined""", "joined"))
def q_sql_functions(spark, sf_dir):
    register_sql_functions(spark)
    FX.joined(spark, sf_dir).createOrReplaceTempView("aeroseries_joined")
    return spark.sql("""
        SELECT site_id, date, gdd(TAVG, 5D) AS gdd5, vpd(TAVG, TMIN) AS vpd,
               severity_biological(Tree, 'Tree') AS tree_severity,
               severity_level(severity_biological(Total_Pollen, 'Total_Pollen')) AS total_level,
               season(month(date)) AS season
        FROM aeroseries_joined""")


# A2 ---------------------------------------------------------------------------
@query("read_pollen_csv", "A2,A5", with_views(
    "SELECT site_id, Total_Pollen, Tree, Grass, Weed, Ragweed, date FROM pollen", "pollen"))
def q_read_pollen_csv(spark, sf_dir):
    p = FX.pollen(spark, sf_dir).select(
        F.col("site_id").cast("int").alias("site_id"), F.date_format("date", "yyyy-MM-dd").alias("Date_Standard"),
        "Total_Pollen", "Tree", "Grass", "Weed", "Ragweed")
    path = scratch_path(spark, "a2-pollen")
    IO.write_daily(p, path, fmt="csv", date_col="Date_Standard")
    return IO.read_pollen(spark, path, with_site=True, date_format="yyyy-MM-dd")


# A3 ---------------------------------------------------------------------------
@query("read_joined_written", "A3,A5", with_views(
    "SELECT *, year(date) AS year FROM joined", "joined"))
def q_read_joined_written(spark, sf_dir):
    j = FX.joined(spark, sf_dir).withColumn("year", F.year("date"))
    path = scratch_path(spark, "a3-joined")
    IO.write_daily(j, path, fmt="parquet", partition_cols=("year",))
    return IO.read_joined(spark, path)
