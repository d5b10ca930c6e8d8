"""Test-input views derived from the driver tables (see FIXTURES.md).

Each function builds one view with the DataFrame API; the same views are
written in SQL for the DuckDB oracle (``aeroseries.plans.views_sql``).  Results
are equal in both engines (the ``read_*`` / ``fixture_*`` queries are checked
against those views).

Plans pre-aggregate before joining: lineitem is reduced to one row per
(supplier, day) before the supplier / nation lookups, so the join input is the
aggregate, not the raw fact table.  ``nation`` has a fixed 25 rows and is the
only side broadcast explicitly; every other join strategy is left to the
planner's size statistics and AQE.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aeroseries.sources.tables import memo_frame, read_table


def _view(fn):
    """Each view is defined once per session and folder (lazy plan reuse)."""
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        return memo_frame(spark, ("view", fn.__name__, sf_dir.rstrip("/")), lambda: fn(spark, sf_dir))
    wrapped.__name__, wrapped.__doc__ = fn.__name__, fn.__doc__
    return wrapped


@_view
def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station-day weather: one row per (STATION, DATE), several stations per site."""
    li = read_table(spark, sf_dir, "lineitem")
    per_day = (li.groupBy(F.col("l_suppkey"), F.to_date("l_shipdate").alias("DATE"))
               .agg(F.max("l_quantity").alias("qmax"), F.min("l_quantity").alias("qmin"),
                    F.max("l_linenumber").alias("lnmax"), F.min("l_linenumber").alias("lnmin"),
                    F.max("l_discount").alias("dmax"), F.max("l_tax").alias("tmax")))
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (per_day.join(sup, per_day.l_suppkey == sup.s_suppkey)
         .join(F.broadcast(nat), F.col("s_nationkey") == F.col("n_nationkey")))
    tax = F.round(F.col("tmax") * 100, 0)
    return j.select(
        F.col("s_nationkey").alias("site_id"),
        F.concat(F.lit("STN"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0")).alias("STATION"),
        F.concat(F.col("s_name"), F.lit(", "), F.col("n_name")).alias("NAME"),
        F.col("DATE"),
        (F.lit(32) + F.col("qmax")).cast("double").alias("TMAX"),
        (F.lit(7) + F.col("qmin")).cast("double").alias("TMIN"),
        F.when(F.col("lnmax") % 3 == 0, F.lit(None).cast("double"))
         .otherwise(((F.lit(39) + F.col("qmax") + F.col("qmin")) / 2).cast("double")).alias("TAVG"),
        F.when(F.col("lnmin") == 7, F.lit(None).cast("double"))
         .otherwise((F.greatest(F.round(F.col("dmax") * 100, 0) - 5, F.lit(0)) / 10).cast("double"))
         .alias("PRCP"),
        (tax * 3).cast("double").alias("AWND"),
        (tax * 6).cast("double").alias("WSF2"),
        (tax * 15 / 2).cast("double").alias("WSF5"),
    )


@_view
def weather_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site-day weather in metric units (station mean per day, F to C, in to mm)."""
    w = weather_raw(spark, sf_dir)
    return (w.groupBy("site_id", F.col("DATE").alias("date"))
            .agg(F.round((F.avg("TMAX") - 32) * 5 / 9, 6).alias("TMAX"),
                 F.round((F.avg("TMIN") - 32) * 5 / 9, 6).alias("TMIN"),
                 F.round((F.avg("TAVG") - 32) * 5 / 9, 6).alias("TAVG"),
                 F.round(F.avg("PRCP") * 25.4, 6).alias("PRCP"),
                 F.round(F.avg("AWND"), 6).alias("AWND")))


@_view
def pollen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily pollen counts per site (orders by customer nation)."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    done = F.col("o_orderstatus") != "P"
    pr = F.col("o_orderpriority")
    price = F.col("o_totalprice")

    def part(cond, div):
        return F.sum(F.when(done & cond, F.floor(price / div)).otherwise(F.lit(0))).cast("double")

    g = (j.groupBy(F.col("c_nationkey").alias("site_id"), F.to_date("o_orderdate").alias("date"))
         .agg(part(pr == "1-URGENT", 1000).alias("Tree"),
              part(pr == "2-HIGH", 2000).alias("Grass"),
              part(pr.isin("3-MEDIUM", "4-NOT SPECIFIED"), 4000).alias("Weed"),
              part(pr == "5-LOW", 4000).alias("Ragweed")))
    return g.withColumn("Total_Pollen", F.col("Tree") + F.col("Grass") + F.col("Weed") + F.col("Ragweed"))


@_view
def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pollen joined with site weather on (site_id, date)."""
    p = pollen(spark, sf_dir)
    w = weather_site(spark, sf_dir)
    return p.join(w, ["site_id", "date"]).select(
        "site_id", "date", "Tree", "Grass", "Weed", "Ragweed", "Total_Pollen",
        "TMAX", "TMIN", "TAVG", "PRCP", "AWND")


@_view
def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly forecast requests in Fahrenheit / inches / mph: 7 days per request."""
    w = weather_raw(spark, sf_dir)
    day = (w.groupBy("site_id", F.col("DATE").alias("date"))
           .agg(F.max("TMAX").alias("temp_max"), F.min("TMIN").alias("temp_min"),
                F.max("TAVG").alias("temp_avg"),
                F.max(F.coalesce(F.col("PRCP"), F.lit(0.0))).alias("precipitation"),
                F.max("AWND").alias("wind_speed")))
    rn0 = F.row_number().over(Window.partitionBy("site_id").orderBy("date")) - 1
    day = day.withColumn("rn0", rn0)
    return day.select(
        (F.col("site_id") * 100000 + (F.col("rn0") - F.col("rn0") % 7) / 7).cast("bigint").alias("request_id"),
        (F.col("rn0") % 7).cast("int").alias("pos"),
        "date", "temp_max", "temp_min", "temp_avg", "precipitation", "wind_speed")


@_view
def messy_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests with nine kinds of invalid rows, by a rule on their keys."""
    n = (F.col("request_id") + F.col("pos")) % 13
    return requests(spark, sf_dir).select(
        "request_id", "pos", F.when(n != 1, F.col("date")).alias("date"),
        F.when(n == 2, None).when(n == 3, F.col("temp_max") + 200.0).when(n == 4, F.col("temp_min") - 1.0)
        .otherwise(F.col("temp_max")).alias("temp_max"),
        F.when(n.isin(2, 5), None).when(n == 6, F.col("temp_min") - 300.0).otherwise(F.col("temp_min")).alias("temp_min"),
        F.when(n == 7, 151.0).otherwise(F.col("temp_avg")).alias("temp_avg"),
        F.when(n == 8, -0.5).otherwise(F.col("precipitation")).alias("precipitation"),
        F.when(n.isin(8, 9), -1.0).otherwise(F.col("wind_speed")).alias("wind_speed"))


@_view
def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic stand-in predictions so metric operators have exact oracles."""
    j = joined(spark, sf_dir)
    tp = F.col("Total_Pollen")
    actual = (F.when(tp >= 5000, 10.0).when(tp >= 500, 7.0).when(tp >= 200, 6.0)
              .when(tp >= 100, 5.0).when(tp >= 60, 4.0).when(tp >= 30, 3.0)
              .when(tp >= 10, 2.0).otherwise(0.0))
    w = Window.partitionBy("site_id").orderBy("date").rowsBetween(-6, 0)
    pred = F.round(F.least(F.lit(10.0), F.greatest(F.lit(0.0), F.avg(tp).over(w) / 30)), 6)
    return j.select("site_id", "date", actual.alias("actual"), pred.alias("predicted"))


@_view
def model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long table (model, site_id, date, actual, predicted) of four data-derived
    stand-in models: trailing means of 3 / 7 / 14 rows and yesterday's value,
    each scaled by 1/30 and clipped to [0, 10].  Feeds model-comparison operators
    with results whose size grows with the data."""
    j = joined(spark, sf_dir)
    tp = F.col("Total_Pollen")
    o = Window.partitionBy("site_id").orderBy("date")
    actual = (F.when(tp >= 5000, 10.0).when(tp >= 500, 7.0).when(tp >= 200, 6.0)
              .when(tp >= 100, 5.0).when(tp >= 60, 4.0).when(tp >= 30, 3.0)
              .when(tp >= 10, 2.0).otherwise(0.0))

    def scaled(c):
        return F.round(F.least(F.lit(10.0), F.greatest(F.lit(0.0), c / 30)), 6)

    wide = j.select(
        "site_id", "date", actual.alias("actual"),
        scaled(F.avg(tp).over(o.rowsBetween(-2, 0))).alias("m3"),
        scaled(F.avg(tp).over(o.rowsBetween(-6, 0))).alias("m7"),
        scaled(F.avg(tp).over(o.rowsBetween(-13, 0))).alias("m14"),
        scaled(F.lag(tp, 1).over(o)).alias("p1"))
    return wide.select(
        "site_id", "date", "actual",
        F.expr("stack(4, 'Rolling Mean 3', m3, 'Rolling Mean 7', m7, "
               "'Rolling Mean 14', m14, 'Persistence Lag 1', p1) AS (model, predicted)"))


@_view
def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor readings for the streaming operators."""
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", (F.col("user_id") % 25).cast("int").alias("site_id"),
                    "ts", F.col("event_type").alias("metric"), "value")


class LinearIndexScorer(Transformer):
    """Deterministic scorer of the tests and oracles: ``prediction`` = intercept + sum(w * feature).
    Same ``transform`` contract as a fitted pipeline; used where an exact
    oracle is wanted."""

    def __init__(self, weights: dict[str, float], intercept: float = 0.0):
        super().__init__()
        self.weights = dict(weights)
        self.intercept = float(intercept)

    def _transform(self, df: DataFrame) -> DataFrame:
        expr: Column = F.lit(self.intercept)
        for c, w in self.weights.items():
            expr = expr + F.col(c) * F.lit(float(w))
        return df.withColumn("prediction", expr)


# Weights of the stand-in index (GDD and peak proximity raise, rain lowers).
STANDIN_WEIGHTS = {"GDD_General": 0.25, "Tree_Peak_Prox": 3.0, "Grass_Peak_Prox": 2.5,
                   "Weed_Peak_Prox": 2.0, "Rain_Heavy": -1.5, "Ventilation_Index": 0.005,
                   "TMAX_lag_1": 0.02, "PRCP_lag_1": -0.01}
STANDIN = LinearIndexScorer(STANDIN_WEIGHTS, intercept=0.5)


VIEWS = {
    "weather_raw": weather_raw,
    "weather_site": weather_site,
    "pollen": pollen,
    "joined": joined,
    "requests": requests,
    "messy_requests": messy_requests,
    "predictions": predictions,
    "model_predictions": model_predictions,
    "readings": readings,
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return VIEWS[name](spark, sf_dir)
