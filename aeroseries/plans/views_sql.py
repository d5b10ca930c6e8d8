"""Fixture views as SQL text for the DuckDB oracle (the driver registers only
base tables, so every oracle query carries the views it needs as a WITH prefix).
The Spark side builds the same views with the DataFrame API in
``aeroseries.sources.fixtures``."""

from __future__ import annotations

VIEW_SQL = {
    "weather_raw": """
SELECT s.s_nationkey AS site_id,
       concat('STN', lpad(cast(l.l_suppkey AS varchar), 6, '0')) AS STATION,
       concat(min(s.s_name), ', ', min(n.n_name)) AS NAME,
       cast(l.l_shipdate AS date) AS DATE,
       cast(32 + max(l.l_quantity) AS double) AS TMAX,
       cast(7 + min(l.l_quantity) AS double) AS TMIN,
       CASE WHEN max(l.l_linenumber) % 3 = 0 THEN NULL
            ELSE cast((39 + max(l.l_quantity) + min(l.l_quantity)) / 2 AS double) END AS TAVG,
       CASE WHEN min(l.l_linenumber) = 7 THEN NULL
            ELSE cast(greatest(round(max(l.l_discount) * 100, 0) - 5, 0) / 10 AS double) END AS PRCP,
       cast(round(max(l.l_tax) * 100, 0) * 3 AS double) AS AWND,
       cast(round(max(l.l_tax) * 100, 0) * 6 AS double) AS WSF2,
       cast(round(max(l.l_tax) * 100, 0) * 15 / 2 AS double) AS WSF5
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY s.s_nationkey, l.l_suppkey, cast(l.l_shipdate AS date)""",
    "weather_site": """
SELECT site_id, DATE AS date,
       round((avg(TMAX) - 32) * 5 / 9, 6) AS TMAX,
       round((avg(TMIN) - 32) * 5 / 9, 6) AS TMIN,
       round((avg(TAVG) - 32) * 5 / 9, 6) AS TAVG,
       round(avg(PRCP) * 25.4E0, 6) AS PRCP,
       round(avg(AWND), 6) AS AWND
FROM weather_raw
GROUP BY site_id, DATE""",
    "pollen": """
SELECT site_id, date, Tree, Grass, Weed, Ragweed, Tree + Grass + Weed + Ragweed AS Total_Pollen
FROM (
  SELECT c.c_nationkey AS site_id, cast(o.o_orderdate AS date) AS date,
    cast(sum(CASE WHEN o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT' THEN floor(o_totalprice / 1000) ELSE 0 END) AS double) AS Tree,
    cast(sum(CASE WHEN o_orderstatus <> 'P' AND o_orderpriority = '2-HIGH' THEN floor(o_totalprice / 2000) ELSE 0 END) AS double) AS Grass,
    cast(sum(CASE WHEN o_orderstatus <> 'P' AND o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN floor(o_totalprice / 4000) ELSE 0 END) AS double) AS Weed,
    cast(sum(CASE WHEN o_orderstatus <> 'P' AND o_orderpriority = '5-LOW' THEN floor(o_totalprice / 4000) ELSE 0 END) AS double) AS Ragweed
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY c.c_nationkey, cast(o.o_orderdate AS date)
) t""",
    "joined": """
SELECT p.site_id, p.date, p.Tree, p.Grass, p.Weed, p.Ragweed, p.Total_Pollen,
       w.TMAX, w.TMIN, w.TAVG, w.PRCP, w.AWND
FROM pollen p JOIN weather_site w ON p.site_id = w.site_id AND p.date = w.date""",
    "requests": """
SELECT cast(site_id * 100000 + (rn - 1 - (rn - 1) % 7) / 7 AS bigint) AS request_id,
       cast((rn - 1) % 7 AS int) AS pos, date,
       temp_max, temp_min, temp_avg, precipitation, wind_speed
FROM (
  SELECT site_id, DATE AS date,
         row_number() OVER (PARTITION BY site_id ORDER BY DATE) AS rn,
         max(TMAX) AS temp_max, min(TMIN) AS temp_min, max(TAVG) AS temp_avg,
         max(coalesce(PRCP, 0)) AS precipitation, max(AWND) AS wind_speed
  FROM weather_raw GROUP BY site_id, DATE
) t""",
    "messy_requests": """
SELECT request_id, pos, CASE WHEN n = 1 THEN NULL ELSE date END AS date,
       CASE WHEN n = 2 THEN NULL WHEN n = 3 THEN temp_max + 200.0E0 WHEN n = 4 THEN temp_min - 1.0E0 ELSE temp_max END AS temp_max,
       CASE WHEN n IN (2, 5) THEN NULL WHEN n = 6 THEN temp_min - 300.0E0 ELSE temp_min END AS temp_min,
       CASE WHEN n = 7 THEN 151.0E0 ELSE temp_avg END AS temp_avg,
       CASE WHEN n = 8 THEN -0.5E0 ELSE precipitation END AS precipitation,
       CASE WHEN n IN (8, 9) THEN -1.0E0 ELSE wind_speed END AS wind_speed
FROM (SELECT *, (request_id + pos) % 13 AS n FROM requests) r""",
    "predictions": """
SELECT site_id, date, actual, predicted FROM (
  SELECT site_id, date,
         CASE WHEN Total_Pollen >= 5000 THEN 10.0E0 WHEN Total_Pollen >= 500 THEN 7.0E0 WHEN Total_Pollen >= 200 THEN 6.0E0
              WHEN Total_Pollen >= 100 THEN 5.0E0 WHEN Total_Pollen >= 60 THEN 4.0E0 WHEN Total_Pollen >= 30 THEN 3.0E0
              WHEN Total_Pollen >= 10 THEN 2.0E0 ELSE 0.0E0 END AS actual,
         round(least(10.0E0, greatest(0.0E0, avg(Total_Pollen) OVER (PARTITION BY site_id ORDER BY date
               ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) / 30)), 6) AS predicted
  FROM joined
) t""",
    "model_predictions_wide": """
SELECT site_id, date,
       CASE WHEN Total_Pollen >= 5000 THEN 10.0E0 WHEN Total_Pollen >= 500 THEN 7.0E0 WHEN Total_Pollen >= 200 THEN 6.0E0
            WHEN Total_Pollen >= 100 THEN 5.0E0 WHEN Total_Pollen >= 60 THEN 4.0E0 WHEN Total_Pollen >= 30 THEN 3.0E0
            WHEN Total_Pollen >= 10 THEN 2.0E0 ELSE 0.0E0 END AS actual,
       round(least(10.0E0, greatest(0.0E0, avg(Total_Pollen) OVER (PARTITION BY site_id ORDER BY date
             ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) / 30)), 6) AS m3,
       round(least(10.0E0, greatest(0.0E0, avg(Total_Pollen) OVER (PARTITION BY site_id ORDER BY date
             ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) / 30)), 6) AS m7,
       round(least(10.0E0, greatest(0.0E0, avg(Total_Pollen) OVER (PARTITION BY site_id ORDER BY date
             ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) / 30)), 6) AS m14,
       round(least(10.0E0, greatest(0.0E0, lag(Total_Pollen, 1) OVER (PARTITION BY site_id ORDER BY date) / 30)), 6) AS p1
FROM joined""",
    "model_predictions": """
SELECT site_id, date, actual, 'Rolling Mean 3' AS model, m3 AS predicted FROM model_predictions_wide
UNION ALL SELECT site_id, date, actual, 'Rolling Mean 7', m7 FROM model_predictions_wide
UNION ALL SELECT site_id, date, actual, 'Rolling Mean 14', m14 FROM model_predictions_wide
UNION ALL SELECT site_id, date, actual, 'Persistence Lag 1', p1 FROM model_predictions_wide""",
    "readings": """
SELECT event_id, cast(user_id % 25 AS int) AS site_id, ts, event_type AS metric, value FROM events""",
}

VIEW_DEPS = {
    "weather_raw": (),
    "weather_site": ("weather_raw",),
    "pollen": (),
    "joined": ("pollen", "weather_site"),
    "requests": ("weather_raw",),
    "messy_requests": ("requests",),
    "predictions": ("joined",),
    "model_predictions_wide": ("joined",),
    "model_predictions": ("model_predictions_wide",),
    "readings": (),
}


def _ordered(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in VIEW_DEPS[n]:
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the named views (and their dependencies) as CTEs.
    ``extra`` adds further (name, sql) CTEs after the views, in order."""
    ctes = [f"{n} AS ({VIEW_SQL[n].strip()})" for n in _ordered(names)]
    for n, sql in extra or []:
        ctes.append(f"{n} AS ({sql.strip()})")
    if not ctes:
        return body.strip()
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()
