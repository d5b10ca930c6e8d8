"""SQL text for the oracle, generated from the same fixed values the Spark
functions use (thresholds, peaks, level names)."""

from __future__ import annotations

import math

from aeroseries.functions import scalars as S


def flag(pred: str) -> str:
    return f"cast(coalesce({pred}, false) AS integer)"


def severity_biological(col: str, pollen_type: str) -> str:
    ext = S.extended_thresholds(S.BIO_THRESHOLDS[pollen_type])
    n = len(ext)
    parts = [f"WHEN {col} IS NULL OR {col} = 0 THEN 0.0E0"]
    for i in range(n - 1, 0, -1):
        parts.append(f"WHEN {col} >= {ext[i]!r} THEN {min(10.0, i * (10.0 / (n - 1)))!r}")
    return "CASE " + " ".join(parts) + " ELSE 0.0E0 END"


def severity_fixed(col: str) -> str:
    parts = [f"WHEN {col} <= 0 THEN 0.0E0"]
    for i in range(len(S.FIXED_SEVERITY_CUTS) - 1, -1, -1):
        parts.append(f"WHEN {col} >= {S.FIXED_SEVERITY_CUTS[i]!r} THEN {float(i)!r}")
    return "CASE " + " ".join(parts) + " ELSE 0.0E0 END"


def severity_level(score: str) -> str:
    arr = ", ".join(f"'{x}'" for x in S.SEVERITY_LEVELS)
    return f"([{arr}])[cast(least(greatest(floor({score}), 0), 9) AS integer) + 1]"


def recommendation(score: str) -> str:
    r = S.RECOMMENDATIONS
    return (f"CASE WHEN {score} <= 2 THEN '{r[0]}' WHEN {score} <= 4 THEN '{r[1]}' "
            f"WHEN {score} <= 6 THEN '{r[2]}' WHEN {score} <= 8 THEN '{r[3]}' ELSE '{r[4]}' END")


def alert_level(total: str) -> str:
    return (f"CASE WHEN {total} <= 3 THEN 'Low' WHEN {total} <= 5 THEN 'Moderate' "
            f"WHEN {total} <= 7 THEN 'High' ELSE 'Severe' END")


def season(month: str) -> str:
    return (f"CASE WHEN {month} IN (3, 4, 5) THEN 'Spring' WHEN {month} IN (6, 7, 8) THEN 'Summer' "
            f"WHEN {month} IN (9, 10, 11) THEN 'Fall' ELSE 'Winter' END")


def gdd(t: str, base: float) -> str:
    return f"CASE WHEN {t} IS NOT NULL THEN greatest({t} - {float(base)!r}, 0.0E0) END"


def sat_vp(t: str) -> str:
    return f"(0.6108E0 * exp(17.27E0 * {t} / ({t} + 237.3E0)))"


def vpd(tavg: str, tmin: str) -> str:
    return (f"CASE WHEN {tavg} IS NOT NULL AND {tmin} IS NOT NULL "
            f"THEN greatest(0.0E0, {sat_vp(tavg)} - {sat_vp(tmin)}) END")


def cyc(v: str, period: float) -> tuple[str, str]:
    a = f"({2 * math.pi!r} * {v} / {float(period)!r})"
    return f"sin({a})", f"cos({a})"


def peak_prox(doy: str, peak: float) -> str:
    return f"exp(-0.5E0 * pow(({doy} - {float(peak)!r}) / 30.0E0, 2))"


def clip(c: str, lo: float, hi: float) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, {float(lo)!r}), {float(hi)!r}) END"


def rain_intensity(p: str) -> str:
    return (f"CASE WHEN {p} > -1 AND {p} <= 0 THEN 0.0E0 WHEN {p} > 0 AND {p} <= 2.5 THEN 1.0E0 "
            f"WHEN {p} > 2.5 AND {p} <= 1000 THEN 2.0E0 END")


def f_to_c(c: str) -> str:
    return f"(({c} - 32.0E0) * 5.0E0 / 9.0E0)"


def weekday(d: str) -> str:
    return f"(isodow({d}) - 1)"


def w(part: str = "site_id", order: str = "date") -> str:
    return f"PARTITION BY {part} ORDER BY {order}"


def rows(n: int, part: str = "site_id", order: str = "date") -> str:
    return f"({w(part, order)} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def running(part: str = "site_id", order: str = "date") -> str:
    return f"({w(part, order)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def cumsum_within(c: str, part: str, order: str = "date") -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN sum({c}) OVER {running(part, order)} END"


def rolling_mean(c: str, n: int, minp: int = 1, part: str = "site_id") -> str:
    if minp <= 1:
        return f"avg({c}) OVER {rows(n, part)}"
    return f"CASE WHEN count({c}) OVER {rows(n, part)} >= {minp} THEN avg({c}) OVER {rows(n, part)} END"


def rolling_sum(c: str, n: int, minp: int = 1, part: str = "site_id") -> str:
    if minp <= 1:
        return f"sum({c}) OVER {rows(n, part)}"
    return f"CASE WHEN count({c}) OVER {rows(n, part)} >= {minp} THEN sum({c}) OVER {rows(n, part)} END"


def lag(c: str, n: int, part: str = "site_id") -> str:
    return f"lag({c}, {n}) OVER ({w(part)})"
