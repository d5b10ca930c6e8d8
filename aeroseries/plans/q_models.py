"""Queries for splits (I1-I4, I17), model fits and evaluation.

Model queries train small presets on the abiotic / refined feature sets of the
joined table and return metric rows (rows-only check: no SQL form for a fit).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from aeroseries.functions import scalars as S
from aeroseries.operators import evaluate as EV
from aeroseries.operators import features as H
from aeroseries.operators import metrics as M
from aeroseries.operators import models as ML
from aeroseries.operators import rank as R
from aeroseries.operators import splits as SP
from aeroseries.plans import sqlgen as Q
from aeroseries.plans.catalog import query
from aeroseries.plans.q_features import _H4
from aeroseries.plans.q_profile import metrics_sql
from aeroseries.plans.views_sql import with_views
from aeroseries.session import cut_lineage
from aeroseries.sources import fixtures as FX

TOTAL = "Total_Pollen_Severity"
LABELS = ["Tree_Severity", "Grass_Severity", "Weed_Severity", "Ragweed_Severity", TOTAL]


def _labeled(spark, sf_dir):
    j = FX.joined(spark, sf_dir)
    return H.biological_labels(j)


# I1 ---------------------------------------------------------------------------
@query("split_by_date_quantile", "I1", with_views("""
SELECT j.site_id, j.date, CASE WHEN date_diff('day', DATE '1970-01-01', j.date) <= cut THEN 'train' ELSE 'test' END AS role
FROM joined j JOIN (SELECT site_id, quantile_cont(cast(date_diff('day', DATE '1970-01-01', date) AS double), 0.8) AS cut
                    FROM joined GROUP BY site_id) c ON j.site_id = c.site_id""", "joined"))
def q_split_quantile(spark, sf_dir):
    j = FX.joined(spark, sf_dir).select("site_id", "date")
    return SP.split_by_date_quantile(j, 0.8)


# I2 ---------------------------------------------------------------------------
@query("split_positional", "I2", with_views("""
SELECT site_id, date, CASE WHEN row_number() OVER (PARTITION BY site_id ORDER BY date) - 1
                                < floor(count(*) OVER (PARTITION BY site_id) * 0.8) THEN 'train' ELSE 'test' END AS role
FROM joined""", "joined"))
def q_split_positional(spark, sf_dir):
    return SP.split_positional(FX.joined(spark, sf_dir).select("site_id", "date"), 0.8)


@query("split_positional_global", "I2", with_views("""
SELECT site_id, date, CASE WHEN row_number() OVER (ORDER BY date, site_id) - 1
                                < floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'test' END AS role
FROM joined""", "joined"))
def q_split_positional_global(spark, sf_dir):
    return SP.split_positional(FX.joined(spark, sf_dir).select("site_id", "date"), 0.8, by=())


# I3 ---------------------------------------------------------------------------
@query("validation_tail", "I3", with_views("""
SELECT site_id, date, row_number() OVER (PARTITION BY site_id ORDER BY date) - 1
                      >= floor(count(*) OVER (PARTITION BY site_id) * 0.9) AS is_validation
FROM (SELECT * FROM (
  SELECT site_id, date, row_number() OVER (PARTITION BY site_id ORDER BY date) - 1
                        < floor(count(*) OVER (PARTITION BY site_id) * 0.8) AS is_train FROM joined) a
  WHERE is_train) t""", "joined"))
def q_validation_tail(spark, sf_dir):
    s = SP.split_positional(FX.joined(spark, sf_dir).select("site_id", "date"), 0.8)
    return SP.validation_tail(s.filter(F.col("role") == "train").drop("role"), 0.9)


# I4 ---------------------------------------------------------------------------
@query("expanding_folds", "I4", with_views("""
SELECT site_id, date, fold, role FROM (
  SELECT site_id, date, f.fold,
         CASE WHEN pos < n - (5 - f.fold) * sz THEN 'train'
              WHEN pos < n - (5 - f.fold) * sz + sz THEN 'test' END AS role
  FROM (SELECT site_id, date, row_number() OVER (PARTITION BY site_id ORDER BY date) - 1 AS pos,
               count(*) OVER (PARTITION BY site_id) AS n,
               floor(count(*) OVER (PARTITION BY site_id) / 6) AS sz FROM joined) p
  CROSS JOIN (SELECT cast(range AS integer) AS fold FROM range(5)) f) t
WHERE role IS NOT NULL""", "joined"))
def q_folds(spark, sf_dir):
    return SP.expanding_folds(FX.joined(spark, sf_dir).select("site_id", "date"), 5)


# I17 --------------------------------------------------------------------------
@query("split_summary", "I17,I2", with_views(f"""
SELECT site_id, role, count(*) AS rows, min(date) AS first_date, max(date) AS last_date,
       min(sev) AS label_min, max(sev) AS label_max, avg(sev) AS label_mean
FROM (SELECT site_id, date, {Q.severity_biological('Total_Pollen', 'Total_Pollen')} AS sev,
             CASE WHEN row_number() OVER (PARTITION BY site_id ORDER BY date) - 1
                       < floor(count(*) OVER (PARTITION BY site_id) * 0.8) THEN 'train' ELSE 'test' END AS role
      FROM joined) t
GROUP BY site_id, role""", "joined"))
def q_split_summary(spark, sf_dir):
    s = SP.split_positional(_labeled(spark, sf_dir).select("site_id", "date", TOTAL), 0.8)
    return SP.split_summary(s, TOTAL, by=("site_id",))


# Model fits (rows-only) -------------------------------------------------------
def _frame(spark, sf_dir, name="abiotic"):
    """Feature set + labels, complete rows, positional split per site."""
    fn, cols = H.FEATURE_SETS[name]
    f = fn(_labeled(spark, sf_dir)).select("site_id", "date", *cols, *LABELS)
    f = f.na.drop(subset=list(cols) + [TOTAL])
    # Written once to the shared checkpoint folder: every fit below re-reads
    # the feature table instead of re-running the window plan.
    return cut_lineage(SP.split_positional(f, 0.8)), list(cols)


def _fit_query(preset):
    def run(spark, sf_dir):
        df, cols = _frame(spark, sf_dir)
        tr, te = df.filter(F.col("role") == "train"), df.filter(F.col("role") == "test")
        if preset == "ridge":
            m = ML.fit_ridge(tr, cols, TOTAL, 1.0)
        else:
            m = ML.fit(tr, cols, TOTAL, preset)
        return ML.evaluate(m, te, TOTAL).withColumn("model", F.lit(preset))
    return run


query("fit_random_forest", "I5")(_fit_query("rf_baseline"))
query("fit_ridge", "I6")(_fit_query("ridge"))
query("fit_linear", "I7")(_fit_query("linear"))


def _validated(df):
    """Training rows with the last tenth of each site marked."""
    return SP.validation_tail(df.filter(F.col("role") == "train").drop("role"), 0.9)


@query("fit_boosted_early_stop", "I9")
def q_fit_boosted(spark, sf_dir):
    df, cols = _frame(spark, sf_dir, "refined")
    m = ML.fit_boosted(_validated(df), cols, TOTAL, "refined")
    return ML.evaluate(m, df.filter(F.col("role") == "test"), TOTAL).withColumns({"rounds": F.lit(len(m.trees)), "rounds_tried": F.lit(len(m.errors))})


# One round of depth 0 is the penalised mean residual; one of depth 1 on a flag has one such leaf
# a side where the split's gain is above 0, else the leaf of all rows.
_L1, _L2, _RATE = 5.0, 0.25, 0.3


def _closed_form_sql():
    shrunk = lambda g: f"sign({g}) * greatest(abs({g}) - {_L1!r}, 0)"
    worth = lambda g, n: f"pow({shrunk(g)}, 2) / ({n} + {_L2!r})"
    leaf = lambda g, n: f"round(0.5 - {shrunk(g)} / ({n} + {_L2!r}) * {_RATE!r}, 6)"
    rows = "\nUNION ALL ".join(f"SELECT '{t}_Severity' AS label, {Q.flag('PRCP > 0')} AS rain, {Q.severity_biological(t, t)} AS sev FROM joined" for t in ("Tree", "Grass", "Weed", "Ragweed"))
    sides = f"SELECT label, rain, count(sev) AS n, sum(0.5 - sev) AS g FROM ({rows}) r GROUP BY label, rain"
    wide = f"SELECT *, sum(g) OVER (PARTITION BY label) AS ga, sum(n) OVER (PARTITION BY label) AS na, sum({worth('g', 'n')}) OVER (PARTITION BY label) AS w FROM ({sides}) s"
    return f"""SELECT label, 0 AS depth, -1 AS rain, max(na) AS n, max({leaf('ga', 'na')}) AS prediction FROM ({wide}) w GROUP BY label
UNION ALL SELECT label, 1, rain, n, CASE WHEN w - {worth('ga', 'na')} > 1e-6 THEN {leaf('g', 'n')} ELSE {leaf('ga', 'na')} END FROM ({wide}) w"""


@query("boosted_closed_form", "I9,I11", with_views(_closed_form_sql(), "joined"))
def q_boosted_closed_form(spark, sf_dir):
    labels = LABELS[:4]
    rows = cut_lineage(_labeled(spark, sf_dir).select("site_id", "date", S.flag(F.col("PRCP") > 0).cast("double").alias("rain"), *labels))
    out = None
    for depth in (0, 1):
        models = ML.train_all_types(rows, ["rain"], labels, "refined", None, rounds=1, rate=_RATE, depth=depth, min_child=1, rows=1.0, columns=1.0, min_gain=0.0, l1=_L1, l2=_L2, base=0.5)
        for lab, m in models.items():
            p = m.transform(rows).where(F.col(lab).isNotNull())
            g = p.groupBy((F.col("rain").cast("int") if depth else F.lit(-1)).alias("rain")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 6).alias("prediction"))
            g = g.select(F.lit(lab).alias("label"), F.lit(depth).alias("depth"), "rain", "n", "prediction")
            out = g if out is None else out.unionByName(g)
    return out


@query("select_by_cv", "I8")
def q_select_cv(spark, sf_dir):
    df, cols = _frame(spark, sf_dir)
    tr = df.filter(F.col("role") == "train").drop("role")
    best, _, summary = ML.select_by_cv(tr, cut_lineage(SP.fold_blocks(tr, 5)), cols, TOTAL)
    return summary.withColumn("chosen", F.col("spec") == F.lit(best))


# I8 on one feature, all folds: against the closed forms.
@query("cv_one_feature", "I8", with_views("""
SELECT spec, fold, round(avg(abs(y - (my + slope * (x - mx)))), 6) AS mae, round(avg(avg(abs(y - (my + slope * (x - mx))))) OVER (PARTITION BY spec), 6) AS cv_mae
FROM (SELECT *, CASE WHEN pos < n - 5 * sz THEN 0 ELSE cast(floor((pos - (n - 5 * sz)) / sz) AS integer) + 1 END AS block
      FROM (SELECT *, floor(n / 6) AS sz FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY date) - 1 AS pos, count(*) OVER (PARTITION BY site_id) AS n FROM one) a) b) t
JOIN (SELECT spec, f.fold, regr_sxy(y, x) / (regr_sxx(y, x) + alpha) AS slope, avg(x) AS mx, avg(y) AS my
      FROM (SELECT *, CASE WHEN pos < n - 5 * sz THEN 0 ELSE cast(floor((pos - (n - 5 * sz)) / sz) AS integer) + 1 END AS block
            FROM (SELECT *, floor(n / 6) AS sz FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY date) - 1 AS pos, count(*) OVER (PARTITION BY site_id) AS n FROM one) a) b) u
      JOIN (SELECT cast(range AS integer) AS fold FROM range(5)) f ON u.block <= f.fold
      CROSS JOIN (SELECT 'linear' AS spec, 0.0E0 AS alpha UNION ALL SELECT 'ridge', 1000.0E0) s GROUP BY spec, alpha, f.fold) w ON t.block = w.fold + 1
GROUP BY spec, fold""", "joined", extra=[("one", "SELECT site_id, date, TAVG AS x, cast(Total_Pollen AS double) AS y FROM joined WHERE TAVG IS NOT NULL AND Total_Pollen IS NOT NULL")]))
def q_cv_one(spark, sf_dir):
    j = FX.joined(spark, sf_dir).select("site_id", "date", F.col("TAVG").alias("x"), F.col("Total_Pollen").cast("double").alias("y"))
    cv = ML.cross_validate(cut_lineage(SP.fold_blocks(j.na.drop(), 5)), ["x"], "y", {"linear": ML.PRESETS["linear"], "ridge": ("ridge", {"alpha": 1000.0})})
    w = Window.partitionBy("spec")
    return cv.select("spec", "fold", F.round("mae", 6).alias("mae"), F.round(F.avg("mae").over(w), 6).alias("cv_mae"))


def _search(grid, shorter):
    def run(spark, sf_dir):
        df, cols = _frame(spark, sf_dir, grid)
        tr = df.filter(F.col("role") == "train").drop("role")
        axes, draws = ML.SEARCH_GRIDS[grid]
        # All axes, draws and folds of the reference; fewer rounds, at five times the rates, keep a
        # registered query to minutes (README).  ``random_search`` itself takes the full grid.
        short = {**axes, "rounds": [max(2, r // shorter) for r in axes["rounds"]], "rate": [r * 5 for r in axes["rate"]]}
        return ML.random_search(cut_lineage(SP.fold_blocks(tr, 5)), cols, TOTAL, draws, short)[1]
    return run


query("random_search", "I10")(_search("refined", 50))
query("random_search_baseline", "I10")(_search("baseline", 200))


@query("train_all_types", "I11")
def q_train_all(spark, sf_dir):
    df, cols = _frame(spark, sf_dir, "refined")
    te = df.filter(F.col("role") == "test")
    models = ML.train_all_types(_validated(df), cols, LABELS, "refined")
    out = None
    for lab, m in models.items():
        r = ML.evaluate(m, te.na.drop(subset=[lab]), lab).withColumns({"pollen_type": F.lit(lab), "rounds": F.lit(len(m.trees))})
        out = r if out is None else out.unionByName(r)
    return out


# A tree of one split on a flag predicts its sides' means and has all the importance.
@query("forest_one_split", "I5,F2", with_views("\nUNION ALL ".join(
    f"SELECT '{t}_Severity' AS label, rain, count(*) AS n, round(avg(sev), 6) AS prediction, 'rain' AS feature, 1.0E0 AS importance "
    f"FROM (SELECT {Q.severity_biological(t, t)} AS sev, {Q.flag('PRCP > 0')} AS rain FROM joined) r WHERE sev IS NOT NULL GROUP BY rain"
    for t in ("Tree", "Grass")), "joined"))
def q_forest_one_split(spark, sf_dir):
    rows = cut_lineage(_labeled(spark, sf_dir).select(S.flag(F.col("PRCP") > 0).cast("double").alias("rain"), *LABELS[:2]))
    out = None
    for lab in LABELS[:2]:
        own = rows.na.drop(subset=[lab])
        m = ML.fit(own, ["rain"], lab, "rf_baseline", numTrees=1, maxDepth=1, minInstancesPerNode=1, bootstrap=False)
        g = m.transform(own).groupBy(F.col("rain").cast("int").alias("rain")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 6).alias("prediction"))
        g = g.select(F.lit(lab).alias("label"), "rain", "n", "prediction").crossJoin(F.broadcast(R.top_features(ML.feature_importances(m, ["rain"]), 1).select("feature", "importance")))
        out = g if out is None else out.unionByName(g)
    return out


@query("top_features", "F2,I5")
def q_top_features(spark, sf_dir):
    df, cols = _frame(spark, sf_dir)
    m = ML.fit(df.filter(F.col("role") == "train"), cols, TOTAL, "small_rf")
    return R.top_features(ML.feature_importances(m, cols), 10)


# Coefficients on one feature, against their closed forms -------------------
_ONE = ("one", "SELECT site_id, TAVG AS x, cast(Total_Pollen AS double) AS y FROM joined WHERE TAVG IS NOT NULL AND Total_Pollen IS NOT NULL")


@query("linear_one_feature", "I7", with_views(
    "SELECT count(*) AS n, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept FROM one",
    "joined", extra=[_ONE]))
def q_linear_one(spark, sf_dir):
    return _one_feature(spark, sf_dir, lambda d: ML.fit(d, ["x"], "y", "linear", solver="normal"))


@query("ridge_one_feature", "I6", with_views("""
SELECT n, round(slope, 6) AS slope, round(my - slope * mx, 6) AS intercept
FROM (SELECT count(*) AS n, regr_sxy(y, x) / (regr_sxx(y, x) + 1000.0E0) AS slope, avg(x) AS mx, avg(y) AS my FROM one) t""",
    "joined", extra=[_ONE]))
def q_ridge_one(spark, sf_dir):
    return _one_feature(spark, sf_dir, lambda d: ML.fit_ridge(d, ["x"], "y", 1000.0))


def _one_feature(spark, sf_dir, fit):
    j = FX.joined(spark, sf_dir).select(F.col("TAVG").alias("x"), F.col("Total_Pollen").cast("double").alias("y"))
    d = cut_lineage(j.na.drop())
    m = fit(d).stages[-1]
    return d.agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.round(F.lit(float(m.coefficients[0])), 6).alias("slope"), F.round(F.lit(float(m.intercept)), 6).alias("intercept"))


# I12 with predictions given by a fixed scorer ---------------------------------------
@query("residuals_given", "I12", with_views(
    "SELECT site_id, date, actual, predicted, actual - predicted AS residual FROM predictions", "predictions"))
def q_residuals_given(spark, sf_dir):
    class Given:
        """Predictions that the table holds already."""

        def transform(self, df):
            return df.withColumnRenamed("predicted", "prediction")

    return EV.residuals(Given(), FX.predictions(spark, sf_dir), "actual")


@query("residuals", "I12")
def q_residuals(spark, sf_dir):
    df, cols = _frame(spark, sf_dir)
    m = ML.fit(df.filter(F.col("role") == "train"), cols, TOTAL, "linear")
    return EV.residuals(m, df.filter(F.col("role") == "test"), TOTAL)


def _regime(spark, sf_dir, name):
    """Models of every label on one feature set, and the test tail: trained on
    complete rows of the first 80% per site; the tail is cut before dropping
    incomplete rows (only weather inputs and the label are required there), as
    in the original weather-only evaluation."""
    fn, cols = H.FEATURE_SETS[name]
    cols = list(dict.fromkeys(cols))
    f = fn(_labeled(spark, sf_dir)).select("site_id", "date", *cols, *LABELS)
    df = cut_lineage(SP.split_positional(f, 0.8))
    # Fewer, larger steps than the presets: two regimes of five labels are fitted in one query.
    models = ML.train_all_types(_validated(df).na.drop(subset=cols), cols, LABELS, "refined", rounds=40, rate=0.1, depth=5)
    return models, df.filter(F.col("role") == "test"), cols


@query("evaluate_without_history", "I13,B14,D20")
def q_without_history(spark, sf_dir):
    models, te, cols = _regime(spark, sf_dir, "refined")
    return EV.evaluate_without_history(models, te, cols)[0]


@query("compare_training_regimes", "I14,C7,D23")
def q_compare_training(spark, sf_dir):
    """Models trained with pollen history (H4) against models trained without
    (H5), both scored on weather-derivable inputs by the wider list."""
    a = EV.evaluate_without_history(*_regime(spark, sf_dir, "refined"), wider=True)[0]
    b = EV.evaluate_without_history(*_regime(spark, sf_dir, "abiotic"), wider=True)[0]
    return M.compare_regimes(a, b)


# I13 with a fixed scorer: what is left of two features when history is zeroed ---------
@query("evaluate_without_history_fixed", "I13,B14,D20", with_views("""
SELECT 'Total_Pollen_Severity' AS pollen_type, count(*) AS n, avg(abs(y - p)) AS mae, avg(CASE WHEN abs(y - p) <= 1 THEN 1.0E0 ELSE 0.0E0 END) AS acc_within_1
FROM (SELECT sev AS y, least(greatest(TAVG * 0.25E0, 0.0E0), 10.0E0) AS p FROM (
  SELECT *, """ + Q.severity_biological("Total_Pollen", "Total_Pollen") + """ AS sev FROM joined) j
  WHERE TAVG IS NOT NULL AND sev IS NOT NULL) t""", "joined"))
def q_without_history_fixed(spark, sf_dir):
    rows = _labeled(spark, sf_dir).select("site_id", "date", "TAVG", F.col("Tree").alias("Tree_lag_1"), TOTAL)
    scorer = FX.LinearIndexScorer({"TAVG": 0.25, "Tree_lag_1": 3.0})
    out = EV.evaluate_without_history({TOTAL: scorer}, rows, ["TAVG", "Tree_lag_1"])[0]
    return out.select("pollen_type", "n", "mae", "acc_within_1")


# I15 --------------------------------------------------------------------------
def _coverage_sql():
    # The names that need pollen history, stated here so that the oracle is its own.
    history = "regexp_matches('{f}', 'Pollen|Tree_lag|Grass_lag|Weed_lag|Ragweed_lag')"
    parts = [f"SELECT '{f}' AS feature, NOT {history.format(f=f)} AS weather_derivable, "
             f"count({f}) / count(*) AS non_null_share FROM h4" for f in H.H4_COLUMNS]
    return with_views("\nUNION ALL ".join(parts), "joined", extra=[("h4", _H4)])


@query("feature_coverage", "I15,B14", _coverage_sql())
def q_coverage(spark, sf_dir):
    f = H.build(FX.joined(spark, sf_dir), "refined")
    return EV.feature_coverage(f, H.H4_COLUMNS)


# I16 --------------------------------------------------------------------------
_PRIORITY = {"Rolling Mean 7": 1, "Rolling Mean 14": 2, "Persistence Lag 1": 3, "Rolling Mean 3": 4}
_PRI_SQL = "CASE model " + " ".join(f"WHEN '{m}' THEN {p}" for m, p in _PRIORITY.items()) + " END"


@query("resolve_model", "I16", with_views(f"""
SELECT site_id, arg_min(model, (priority, model)) AS model, min(priority) AS priority
FROM (SELECT site_id, model, {_PRI_SQL} AS priority, mae <= 2.0 AS available FROM per_site) r
WHERE available GROUP BY site_id""", "model_predictions",
    extra=[("per_site", metrics_sql("model_predictions", ["model", "site_id"]))]))
def q_resolve(spark, sf_dir):
    per = M.metrics_full(FX.model_predictions(spark, sf_dir), by=("model", "site_id"))
    pri = F.create_map(*[x for m, p in _PRIORITY.items() for x in (F.lit(m), F.lit(p))])
    reg = per.select("site_id", "model", F.element_at(pri, F.col("model")).alias("priority"),
                     (F.col("mae") <= 2.0).alias("available"))
    return ML.resolve_model(reg, by="site_id")
