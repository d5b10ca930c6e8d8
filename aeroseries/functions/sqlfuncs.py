"""SQL scalar functions (L1) for ``spark.sql`` users.

Registered as SQL-bodied temporary functions (``CREATE TEMPORARY FUNCTION ...
RETURN expr``), which Catalyst inlines into the calling plan: they stay inside
whole-stage code generation and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from aeroseries.functions import scalars as S


def _severity_body() -> str:
    whens = []
    for t in S.BIO_THRESHOLDS:
        ext = S.extended_thresholds(S.BIO_THRESHOLDS[t])
        n = len(ext)
        chain = " ".join(f"WHEN c >= {ext[i]!r} THEN {min(10.0, i * 10.0 / (n - 1))!r}D"
                         for i in range(n - 1, 0, -1))
        whens.append(f"WHEN pollen_type = '{t}' THEN CASE WHEN c IS NULL OR c = 0 THEN 0D {chain} ELSE 0D END")
    return "CASE " + " ".join(whens) + " END"


def definitions() -> dict[str, str]:
    levels = ", ".join(f"'{x}'" for x in S.SEVERITY_LEVELS)
    return {
        "gdd": ("(t DOUBLE, base DOUBLE) RETURNS DOUBLE RETURN "
                "CASE WHEN t IS NOT NULL AND base IS NOT NULL THEN greatest(t - base, 0D) END"),
        "vpd": ("(t_avg DOUBLE, t_min DOUBLE) RETURNS DOUBLE RETURN "
                "CASE WHEN t_avg IS NOT NULL AND t_min IS NOT NULL THEN greatest(0D, "
                "0.6108D * exp(17.27D * t_avg / (t_avg + 237.3D)) - 0.6108D * exp(17.27D * t_min / (t_min + 237.3D))) END"),
        "severity_biological": f"(c DOUBLE, pollen_type STRING) RETURNS DOUBLE RETURN {_severity_body()}",
        "severity_level": (f"(score DOUBLE) RETURNS STRING RETURN element_at(array({levels}), "
                           "cast(least(greatest(floor(score), 0), 9) AS INT) + 1)"),
        "season": ("(m INT) RETURNS STRING RETURN CASE WHEN m IN (3, 4, 5) THEN 'Spring' "
                   "WHEN m IN (6, 7, 8) THEN 'Summer' WHEN m IN (9, 10, 11) THEN 'Fall' ELSE 'Winter' END"),
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    names = []
    for name, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
        names.append(name)
    return names
