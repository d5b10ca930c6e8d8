"""Queries for the streaming operators (K1-K4).

Each query lands its input under the shared checkpoint folder as a file feed,
runs the streaming query to completion (``availableNow``) into a parquet sink
and returns the sink as a batch DataFrame, so it can be compared with the
batch oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeroseries.plans.catalog import query
from aeroseries.plans.q_registry import _CONSTANTS, _LABELS, trained_models
from aeroseries.plans.q_score import VALID, _daily_sql
from aeroseries.plans import sqlgen as Q
from aeroseries.plans.views_sql import with_views
from aeroseries.session import cut_lineage
from aeroseries.sources import fixtures as FX
from aeroseries.sources.registry import TOTAL, Registry
from aeroseries.streaming import stream as K


def _feed(df, path, parts=None):
    (df.repartition(parts) if parts else df).write.mode("overwrite").parquet(path)
    return df.schema


# K1 ---------------------------------------------------------------------------
@query("stream_score", "K1", with_views(_daily_sql(), "requests"))
def q_stream_score(spark, sf_dir):
    src, sink = K.scratch_path(spark, "k1-src"), K.scratch_path(spark, "k1-sink")
    schema = _feed(FX.requests(spark, sf_dir), src, 4)
    out = K.stream_score(K.file_stream(spark, src, schema, max_files=1), FX.STANDIN)
    K.run_to_sink(out, sink, K.scratch_path(spark, "k1-ckpt"))
    return spark.read.parquet(sink)


# K2 ---------------------------------------------------------------------------
@query("stream_daily_aggregate", "K2", with_views("""
SELECT cast(date_trunc('day', ts) AS date) AS day, site_id, metric, avg(value) AS mean_value, count(*) AS n
FROM readings GROUP BY date_trunc('day', ts), site_id, metric
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM readings) - INTERVAL 1 HOUR""", "readings"))
def q_stream_agg(spark, sf_dir):
    # Event-time windows are aligned to UTC days; the readings' wall-clock times are UTC.
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    src, sink = K.scratch_path(spark, "k2-src"), K.scratch_path(spark, "k2-sink")
    schema = _feed(FX.readings(spark, sf_dir), src)
    out = K.stream_daily_aggregate(K.file_stream(spark, src, schema))
    try:
        K.run_to_sink(out, sink, K.scratch_path(spark, "k2-ckpt"), partitions=K.state_partitions(spark))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return spark.read.parquet(sink)


@query("stream_daily_current", "K2", with_views("""
SELECT cast(date_trunc('day', ts) AS date) AS day, site_id, metric, avg(value) AS mean_value, count(*) AS n
FROM readings GROUP BY date_trunc('day', ts), site_id, metric""", "readings"))
def q_stream_current(spark, sf_dir):
    """Every day, the newest included, after several micro-batches that share days."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    src, sink = K.scratch_path(spark, "k2u-src"), K.scratch_path(spark, "k2u-sink")
    # Three files, each with readings of all days: no watermark may drop what the others hold.
    schema = _feed(FX.readings(spark, sf_dir), src, 3)
    span = FX.readings(spark, sf_dir).agg(F.datediff(F.max("ts"), F.min("ts"))).first()[0] or 0
    try:
        K.stream_daily_current(K.file_stream(spark, src, schema, max_files=1), sink, K.scratch_path(spark, "k2u-ckpt"), delay=f"{span + 2} days", partitions=K.state_partitions(spark))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return spark.read.schema("site_id int, metric string, mean_value double, n long, day date").parquet(sink)


# K3 ---------------------------------------------------------------------------
@query("stream_dedupe", "K3", with_views("SELECT DISTINCT event_id, site_id, ts, metric, value FROM readings",
                                         "readings"))
def q_stream_dedupe(spark, sf_dir):
    src, sink = K.scratch_path(spark, "k3-src"), K.scratch_path(spark, "k3-sink")
    r = FX.readings(spark, sf_dir)
    schema = _feed(r.unionAll(r), src)
    out = K.stream_dedupe(K.file_stream(spark, src, schema), keys=("event_id",))
    K.run_to_sink(out, sink, K.scratch_path(spark, "k3-ckpt"), partitions=K.state_partitions(spark))
    return spark.read.parquet(sink)


# K4 ---------------------------------------------------------------------------
@query("stream_running_features", "K4", with_views(f"""
SELECT site_id, date, {Q.cumsum_within(Q.gdd('TAVG', 5), 'site_id, year(date)')} AS GDD_cumsum,
       cast(row_number() OVER (PARTITION BY site_id, k ORDER BY date) - 1 AS integer) AS Days_Since_Rain
FROM (SELECT *, sum({Q.flag('PRCP > 0')}) OVER {Q.running()} AS k FROM weather_site) t""", "weather_site"))
def q_stream_running(spark, sf_dir):
    src, sink = K.scratch_path(spark, "k4-src"), K.scratch_path(spark, "k4-sink")
    w = FX.weather_site(spark, sf_dir).select(F.col("site_id").cast("int").alias("site_id"), "date", "TAVG", "PRCP")
    schema = w.schema
    # The table is built once, by year; the feed then arrives year by year
    # (bounded by the calendar), each site's days of a year in one file.
    staged = K.scratch_path(spark, "k4-years")
    w.withColumn("year", F.year("date")).repartition("year", "site_id").write.partitionBy("year").parquet(staged)
    years = spark.read.parquet(staged)
    for y in sorted(r["year"] for r in years.select("year").distinct().collect()):
        years.filter(F.col("year") == y).drop("year").write.mode("append").parquet(src)
    out = K.stream_running_features(K.file_stream(spark, src, schema, max_files=8))
    K.run_to_sink(out, sink, K.scratch_path(spark, "k4-ckpt"), partitions=K.state_partitions(spark))
    return spark.read.parquet(sink).filter("not is_late").drop("is_late")


# K4 with days in no order: what the watermark has passed equals the running sums in calendar order.
_DELAY = 400


@query("stream_ordered_features", "K4,E14,E19", with_views(f"""
SELECT site_id, date, {Q.cumsum_within(Q.gdd('TAVG', 5), 'site_id, year(date)')} AS GDD_cumsum,
       cast(row_number() OVER (PARTITION BY site_id, k ORDER BY date) - 1 AS integer) AS Days_Since_Rain
FROM (SELECT *, sum({Q.flag('PRCP > 0')}) OVER {Q.running()} AS k FROM weather_site) t
QUALIFY date + INTERVAL 1 DAY <= (SELECT max(date) FROM weather_site) - INTERVAL {_DELAY} DAY""", "weather_site"))
def q_stream_ordered(spark, sf_dir):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    src, sink = K.scratch_path(spark, "k4o-src"), K.scratch_path(spark, "k4o-sink")
    w = FX.weather_site(spark, sf_dir).select(F.col("site_id").cast("int").alias("site_id"), "date", "TAVG", "PRCP")
    staged = cut_lineage(w.withColumn("year", F.year("date")))
    # A year is two files by a hash of the day, so days come in no order within it.
    for y in sorted(r["year"] for r in staged.select("year").distinct().collect()):
        for half in (1, 0):
            part = staged.filter((F.col("year") == y) & (F.pmod(F.xxhash64("date"), F.lit(2)) == half))
            part.drop("year").orderBy(F.xxhash64("site_id", "date")).coalesce(1).write.mode("append").parquet(src)
    out = K.stream_ordered_features(K.file_stream(spark, src, w.schema, max_files=1), f"{_DELAY} days")
    try:
        K.run_to_sink(out, sink, K.scratch_path(spark, "k4o-ckpt"), partitions=K.state_partitions(spark))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return spark.read.parquet(sink).filter("not is_late").drop("is_late")


# K1 through the registry: a model published between batches serves from the next one on, and a batch run
# again adds no row.
@query("stream_score_registry", "K1,I16", with_views(f"""
SELECT request_id, pos, date, round(s, 2) AS severity_score, {Q.severity_level('s')} AS severity_level, model
FROM (SELECT request_id, pos, date, CASE WHEN request_id % 2 = 0 THEN 'multi_type' ELSE 'weather_only' END AS model FROM requests WHERE {VALID}) r
JOIN (SELECT model AS m, {Q.clip('p', 0, 10)} AS s FROM constants WHERE pollen_type = '{TOTAL}') k ON k.m = r.model""",
    "requests", "joined", extra=[_LABELS, _CONSTANTS]))
def q_stream_registry(spark, sf_dir):
    requests = FX.requests(spark, sf_dir)
    src, sink, checkpoint = (K.scratch_path(spark, f"k1r-{x}") for x in ("src", "sink", "ckpt"))
    trained = trained_models(spark, sf_dir)
    registry = Registry(spark, K.scratch_path(spark, "k1r-registry"))
    registry.publish(TOTAL, "multi_type", trained[TOTAL, "multi_type"], ["TMAX"])
    for part in (0, 1):
        if part:
            registry.publish(TOTAL, "weather_only", trained[TOTAL, "weather_only"], ["TMAX"])
        requests.where(F.pmod("request_id", F.lit(2)) == part).repartition(2).write.mode("append").parquet(src)
        K.stream_score_resolved(K.file_stream(spark, src, requests.schema, max_files=1), registry, sink, checkpoint)
    # The first batch once more, as after a driver that was lost before it noted the batch.
    K.score_batch(registry, sink)(requests.where("request_id % 2 = 0"), 0)
    return spark.read.parquet(sink).select("request_id", "pos", "date", "severity_score", "severity_level", "model")


@query("stream_score_model", "K1,J1")
def q_stream_score_model(spark, sf_dir):
    """K1 with a Spark ML pipeline fitted on the joined table (rows-only check)."""
    from aeroseries.operators import features as H
    from aeroseries.plans.q_score import _trained
    m = _trained(spark, sf_dir, ["Total_Pollen_Severity"])["Total_Pollen_Severity"]
    src, sink = K.scratch_path(spark, "k1m-src"), K.scratch_path(spark, "k1m-sink")
    schema = _feed(FX.requests(spark, sf_dir), src, 4)
    out = K.stream_score(K.file_stream(spark, src, schema, max_files=2), m, H.H5_COLUMNS)
    K.run_to_sink(out, sink, K.scratch_path(spark, "k1m-ckpt"))
    return spark.read.parquet(sink)
