"""Flagship query and the fixture scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeroseries.functions import scalars as S
from aeroseries.plans import sqlgen as Q
from aeroseries.plans.catalog import query
from aeroseries.plans.views_sql import with_views
from aeroseries.sources import fixtures as FX


def monthly_severity(spark, sf_dir):
    """Per site and month: mean / max biological total severity, mean pollen,
    mean temperatures, rain total and day count over the joined table."""
    j = FX.joined(spark, sf_dir)
    sev = S.severity_biological(F.col("Total_Pollen"), "Total_Pollen")
    return (j.groupBy("site_id", F.year("date").alias("year"), F.month("date").alias("month"))
            .agg(F.count(F.lit(1)).alias("days"),
                 F.avg(sev).alias("mean_severity"), F.max(sev).alias("max_severity"),
                 F.avg("Total_Pollen").alias("mean_pollen"),
                 F.avg("TMAX").alias("mean_tmax"), F.avg("TMIN").alias("mean_tmin"),
                 F.sum("PRCP").alias("total_prcp"))
            .withColumn("season", S.season(F.col("month"))))


_sev = Q.severity_biological("Total_Pollen", "Total_Pollen")
query("monthly_severity", "flagship", with_views(f"""
SELECT site_id, year(date) AS year, month(date) AS month, count(*) AS days,
       avg({_sev}) AS mean_severity, max({_sev}) AS max_severity,
       avg(Total_Pollen) AS mean_pollen, avg(TMAX) AS mean_tmax, avg(TMIN) AS mean_tmin,
       sum(PRCP) AS total_prcp, {Q.season('month(date)')} AS season
FROM joined GROUP BY site_id, year(date), month(date)""", "joined"))(monthly_severity)


for _name, _op in [("weather_raw", "A1"), ("pollen", "A2"), ("joined", "A3")]:
    def _scan(spark, sf_dir, _n=_name):
        return FX.view(spark, sf_dir, _n)
    query(f"read_{_name}", _op, with_views(f"SELECT * FROM {_name}", _name))(_scan)

query("fixture_weather_site", "D7,B4,B6", with_views("SELECT * FROM weather_site", "weather_site"))(
    lambda spark, sf_dir: FX.weather_site(spark, sf_dir))
query("fixture_requests", "E22", with_views("SELECT * FROM requests", "requests"))(
    lambda spark, sf_dir: FX.requests(spark, sf_dir))
query("fixture_predictions", "I12", with_views("SELECT * FROM predictions", "predictions"))(
    lambda spark, sf_dir: FX.predictions(spark, sf_dir))
query("fixture_model_predictions", "D20", with_views("SELECT * FROM model_predictions",
                                                     "model_predictions"))(
    lambda spark, sf_dir: FX.model_predictions(spark, sf_dir))
query("fixture_readings", "K2", with_views("SELECT * FROM readings", "readings"))(
    lambda spark, sf_dir: FX.readings(spark, sf_dir))
