"""Hand-computed edge rows (FIXTURES.md section 4)."""

import datetime as dt
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroseries.functions import scalars as S
from aeroseries.operators import profile as D
from aeroseries.operators import score as J
from aeroseries.operators import windows as W

RAIN = [0, 0, 5, 0, None, 0, 3, 2, None, 1, 0, 0]


@pytest.fixture(scope="module")
def rain(spark):
    rows = [(1, dt.date(2024, 1, 1) + dt.timedelta(days=2 * i), None if r is None else float(r))
            for i, r in enumerate(RAIN)]
    return spark.createDataFrame(rows, "site_id int, date date, PRCP double")


def col(df, name):
    return [r[name] for r in df.orderBy("date").collect()]


def test_streaks(rain):
    assert col(W.dry_streak(rain, out="v"), "v") == [1, 2, 0, 1, 0, 1, 0, 0, 0, 0, 1, 2]
    assert col(W.wet_count(rain, out="v"), "v") == [0, 0, 1, 0, 0, 0, 1, 2, 2, 3, 0, 0]
    assert col(W.days_since_rain_dry(rain, out="v"), "v") == [1, 2, 0, 1, 1, 2, 0, 0, 0, 0, 1, 2]
    assert col(W.days_since_rain_rows(rain, out="v"), "v") == [0, 1, 0, 1, 2, 3, 0, 0, 1, 0, 1, 2]


def test_running_and_rolling_sum(rain):
    out = rain.select("date", W.ytd_cumsum("PRCP").alias("c"), W.rolling_sum("PRCP", 3).alias("r"))
    assert col(out, "c") == [0, 0, 5, 5, None, 5, 8, 10, None, 11, 11, 11]
    assert col(out, "r") == [0, 0, 5, 5, 5, 0, 3, 5, 5, 3, 1, 1]


def test_window_rank_pct(rain):
    got = col(rain.select("date", W.window_rank_pct("PRCP", 4, 2).alias("p")), "p")
    want = [None, 100, 33.33, 100, 0, 75, 25, 50, 0, 75, 75, 75]
    for g, w in zip(got, want):
        assert (g is None and w is None) or abs(g - w) < 0.01


def test_rain_intensity(spark):
    df = spark.createDataFrame([(0.0,), (2.5,), (2.6,), (None,), (1001.0,)], "p double")
    assert [r[0] for r in df.select(S.rain_intensity(F.col("p"))).collect()] == [0, 1, 2, None, None]


def test_percentile_thresholds(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 4, 8, 16, 40]], "Total_Pollen double")
    want = [1, 1.5, 2.5, 4, 7, 12, 16, 22, 28, 34, 40]
    # the whole table and its groups are exact alike
    thr = D.severity_thresholds(df).first()["thresholds"]
    assert [round(x, 6) for x in thr] == want
    per_site = D.severity_thresholds(df.withColumn("site_id", F.lit(1)), by=("site_id",)).first()["thresholds"]
    assert [round(x, 6) for x in per_site] == want
    # approximation only if asked for (values from the data)
    approx = D.severity_thresholds(df, approx=True).first()["thresholds"]
    assert set(approx) <= {1.0, 2.0, 4.0, 8.0, 16.0, 40.0}
    assert D.severity_thresholds(df.where("Total_Pollen < 0")).first()["thresholds"] is None


def test_exact_percentiles_match_the_sorted_list(spark):
    rng = np.random.default_rng(3)
    values = np.round(rng.gamma(1.0, 50.0, 4000), 1)
    df = spark.createDataFrame([(float(v), None) for v in values], "v double, none double").repartition(6)
    fr = [0.0, 0.1, 0.25, 0.5, 0.75, 0.333, 0.9, 1.0]
    got = D.exact_percentiles(df, ["v", "none"], fr)
    assert got["none"] is None
    assert np.allclose(got["v"], np.quantile(values, fr), rtol=0, atol=1e-9)


def test_labels_without_groups_use_the_whole_table(spark):
    df = spark.createDataFrame([(1, float(x)) for x in [0, 1, 2, 4]] + [(2, float(x)) for x in [8, 16, 40]], "site_id int, Total_Pollen double")
    labels = {r["Total_Pollen"]: r["Pollen_Severity"] for r in D.label_percentile_severity(df, window=True).collect()}
    assert labels == {0.0: 0, 1.0: 0, 2.0: 1, 4.0: 3, 8.0: 4, 16.0: 6, 40.0: 10}
    flags = D.upper_quartile_flags(df, {"Total_Pollen": "high"}, window=True)
    assert sorted(r["Total_Pollen"] for r in flags.where("high = 1").collect()) == [16.0, 40.0]


def test_severity_biological_tree(spark):
    vals = [0, 0.5, 1, 8, 15, 52.5, 90, 795, 1500, 2250, 3750, 7500, None]
    df = spark.createDataFrame([(None if v is None else float(v),) for v in vals], "c double")
    got = [r[0] for r in df.select(S.severity_biological(F.col("c"), "Tree")).collect()]
    assert got == [0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 0]


def test_severity_total_steps(spark):
    df = spark.createDataFrame([(10.0,), (5000.0,), (1e9,)], "c double")
    got = [r[0] for r in df.select(S.severity_biological(F.col("c"), "Total_Pollen")).collect()]
    assert math.isclose(got[0], 10 / 9) and got[1] == 10 and got[2] == 10


def test_severity_level(spark):
    df = spark.createDataFrame([(0.0,), (0.99,), (5.5,), (9.99,), (10.0,)], "s double")
    got = [r[0] for r in df.select(S.severity_level(F.col("s"))).collect()]
    assert got == ["None", "None", "Moderate-High", "Severe", "Severe"]


def test_gdd_null_stays_null(spark):
    df = spark.createDataFrame([(None,), (3.0,), (12.0,)], "t double")
    assert [r[0] for r in df.select(S.gdd(F.col("t"), 5)).collect()] == [None, 0.0, 7.0]


def entries(spark, scores, order=J.ALLERGENS_MODEL_ORDER):
    rows = [(1, 0, dt.date(2024, 5, 1), [(t, i, v) for i, (t, v) in enumerate(zip(order, scores))])]
    return spark.createDataFrame(rows, "request_id long, pos int, date date, "
                                       "entries array<struct<allergen_type string, idx int, score double>>")


def test_breakdown_all_zero(spark):
    out = J.allergen_breakdown(entries(spark, [0.0] * 4)).collect()
    assert {r["contribution_pct"] for r in out} == {0.0}
    assert {r["primary_allergen"] for r in out} == {"Grass"}
    assert [r["allergen_type"] for r in sorted(out, key=lambda r: r["rank"])] == J.ALLERGENS_MODEL_ORDER


def test_breakdown_primary_first_max(spark):
    out = J.allergen_breakdown(entries(spark, [2.0, 5.0, 5.0, 1.0])).collect()
    assert {r["primary_allergen"] for r in out} == {"Grass"}
    assert {r["alert_level"] for r in out} == {"Severe"}
    assert {r["total_severity"] for r in out} == {13.0}


def test_total_is_added_in_order(spark):
    """0.7 + 1.4 + 3.5 + 1.4 is 7.0 in this order and more in others: not Severe."""
    e = entries(spark, [0.7, 1.4, 3.5, 1.4], J.ALLERGENS_SEASON_ORDER)
    assert {r["alert_level"] for r in J.allergen_breakdown(e).collect()} == {"High"}
    r = J.full_report(e).first()
    assert (r["total_severity"], r["alert_level"]) == (7.0, "High")
    assert J.full_report(e.drop("entries"), None).first()["alert_level"] is None


def test_breakdown_needs_no_shuffle(spark):
    plan = J.full_report(entries(spark, [1.0, 2.0, 3.0, 4.0]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_weekly_summary_all_zero(spark):
    rows = [(1, i, dt.date(2024, 1, 1 + i), 0.0, 0.0) for i in range(7)]
    w = spark.createDataFrame(rows, "request_id long, pos int, date date, severity_score double, raw_score double")
    r = J.weekly_summary(w).first()
    assert r["peak_day"] is None and r["days"] == 7


def test_weekly_peak_first_max(spark):
    vals = [1.0, 3.0, 2.0, 3.0]
    rows = [(1, i, dt.date(2024, 1, 1 + i), v, v) for i, v in enumerate(vals)]
    w = spark.createDataFrame(rows, "request_id long, pos int, date date, severity_score double, raw_score double")
    assert J.weekly_summary(w).first()["peak_day"] == dt.date(2024, 1, 2)


def test_relative_tier_without_error_in_the_best_model(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (0.4, 0.0), (0.6, 0.5), (0.8, 0.5), (1.5, 0.5), (None, 0.5)], "mae double, best double")
    out = rows.select(S.relative_change_tier(S.relative_change(F.col("mae"), F.col("best"))).alias("t")).collect()
    weather, matters, dominates = "Weather captures most signal", "History matters", "History dominates"
    assert [r["t"] for r in out] == [dominates, dominates, weather, matters, dominates, dominates]


def test_performance_tier_where_a_model_has_no_error(spark, tmp_path):
    """Counts so large that every model predicts the actual top level: the best MAE is 0."""
    from __spark_entry__ import oracle_sql, queries
    day = dt.datetime(2024, 1, 1)
    sf = str(tmp_path)
    tables = {
        "customer": ([(1, 7)], "c_custkey long, c_nationkey int"),
        "nation": ([(7, "N")], "n_nationkey int, n_name string"),
        "supplier": ([(1, "S", 7)], "s_suppkey long, s_name string, s_nationkey int"),
        "orders": ([(1, "F", 9e6, day + dt.timedelta(days=i), "1-URGENT") for i in range(20)],
                   "o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(1, day + dt.timedelta(days=i), 10.0, 1, 0.05, 0.02) for i in range(20)],
                     "l_suppkey long, l_shipdate timestamp, l_quantity double, l_linenumber int, l_discount double, l_tax double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{sf}/{name}.parquet")
    got = {r["model"]: (r["mae"], r["relative_tier"]) for r in queries()["performance_tier"](spark, sf).collect()}
    con = duckdb.connect()
    for name in tables:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet/*.parquet')")
    want = con.execute(f"SELECT model, mae, relative_tier FROM ({oracle_sql()['performance_tier']}) q").fetchall()
    assert got == {m: (mae, tier) for m, mae, tier in want}
    # The first day has no yesterday: one row of twenty is wrong by ten levels.
    assert got == {**{f"Rolling Mean {n}": (0.0, "History dominates") for n in (3, 7, 14)}, "Persistence Lag 1": (0.5, "History dominates")}
