"""Queries for cleaning (B) and joins / set operations (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeroseries.operators import clean as B
from aeroseries.operators import joins as C
from aeroseries.operators import windows as W
from aeroseries.plans.catalog import query
from aeroseries.plans.views_sql import with_views
from aeroseries.sources import fixtures as FX



def _conv(col, test, conv):
    return f"CASE WHEN coalesce({test}, false) THEN {conv} ELSE {col} END AS {col}"


def _ftoc(c):
    return f"(({c} - 32.0E0) * 5.0E0 / 9.0E0)"


# B1 ---------------------------------------------------------------------------
@query("filter_station", "B1", with_views(
    "SELECT * FROM weather_raw WHERE STATION = 'STN000001'", "weather_raw"))
def q_filter_station(spark, sf_dir):
    return B.filter_station(FX.weather_raw(spark, sf_dir), "STN000001")


# B2 + cleaning sequence B4-B7 -------------------------------------------------
_CLEAN_SQL = with_views(f"""
SELECT STATION, NAME, DATE, TMAX, TMIN, TAVG, PRCP, AWND, WSF2, WSF5, TAVG_calculated FROM (
  SELECT STATION, NAME, DATE, TMAX, TMIN,
         CASE WHEN can THEN (TMAX + TMIN) / 2 ELSE TAVG END AS TAVG,
         coalesce(can, false) AS TAVG_calculated,
         {_conv('PRCP', 'mx_p < 20', 'PRCP * 25.4E0')},
         {_conv('AWND', 'm_a > 20', 'AWND * 0.44704E0')},
         {_conv('WSF2', 'm_2 > 20', 'WSF2 * 0.44704E0')},
         {_conv('WSF5', 'm_5 > 20', 'WSF5 * 0.44704E0')}
  FROM (
    SELECT *, TAVG IS NULL AND TMAX IS NOT NULL AND TMIN IS NOT NULL AS can FROM (
      SELECT STATION, NAME, DATE,
             {_conv('TMAX', 'm_tx > 30', _ftoc('TMAX'))},
             {_conv('TMIN', 'm_tn > 30', _ftoc('TMIN'))},
             {_conv('TAVG', 'm_ta > 30', _ftoc('TAVG'))},
             PRCP, AWND, WSF2, WSF5, m_a, m_2, m_5, mx_p
      FROM weather_raw, (SELECT avg(TMAX) m_tx, avg(TMIN) m_tn, avg(TAVG) m_ta, avg(AWND) m_a,
                                avg(WSF2) m_2, avg(WSF5) m_5, max(PRCP) mx_p FROM weather_raw) s
    ) a
  ) b
) c""", "weather_raw")


@query("clean_select_key_variables", "B2,B4,B5,B6,B7", _CLEAN_SQL)
def q_clean_select(spark, sf_dir):
    return B.select_key_variables(B.clean_weather(FX.weather_raw(spark, sf_dir)))


# B3 ---------------------------------------------------------------------------
@query("search_stations", "B3", with_views(
    "SELECT DISTINCT STATION, NAME FROM weather_raw WHERE regexp_matches(NAME, '(?i)nation_1[0-4]$|nation_3$')",
    "weather_raw"))
def q_search_stations(spark, sf_dir):
    return B.search_stations(FX.weather_raw(spark, sf_dir), "nation_1[0-4]$|nation_3$")


# B4 ---------------------------------------------------------------------------
@query("fix_temperature_unit", "B4", with_views(f"""
SELECT site_id, STATION, DATE, {_conv('TMAX', 'm_tx > 30', _ftoc('TMAX'))},
       {_conv('TMIN', 'm_tn > 30', _ftoc('TMIN'))}, {_conv('TAVG', 'm_ta > 30', _ftoc('TAVG'))}
FROM weather_raw, (SELECT avg(TMAX) m_tx, avg(TMIN) m_tn, avg(TAVG) m_ta FROM weather_raw) s""",
    "weather_raw"))
def q_fix_temperature(spark, sf_dir):
    w = FX.weather_raw(spark, sf_dir).select("site_id", "STATION", "DATE", "TMAX", "TMIN", "TAVG")
    return B.fix_temperature_unit(w)


@query("fix_temperature_unit_by_site", "B4", with_views(f"""
SELECT w.site_id, STATION, DATE, {_conv('TMAX', 'm_tx > 50', _ftoc('TMAX'))},
       {_conv('TMIN', 'm_tn > 50', _ftoc('TMIN'))}, {_conv('TAVG', 'm_ta > 50', _ftoc('TAVG'))}
FROM weather_raw w LEFT JOIN (SELECT site_id, avg(TMAX) m_tx, avg(TMIN) m_tn, avg(TAVG) m_ta
                              FROM weather_raw GROUP BY site_id) s ON w.site_id = s.site_id""",
    "weather_raw"))
def q_fix_temperature_site(spark, sf_dir):
    w = FX.weather_raw(spark, sf_dir).select("site_id", "STATION", "DATE", "TMAX", "TMIN", "TAVG")
    return B.fix_temperature_unit(w, threshold=50.0, by=("site_id",))


# B5 ---------------------------------------------------------------------------
@query("fix_wind_unit", "B5", with_views(f"""
SELECT STATION, DATE, {_conv('AWND', 'm_a > 20', 'AWND * 0.44704E0')},
       {_conv('WSF2', 'm_2 > 20', 'WSF2 * 0.44704E0')}, {_conv('WSF5', 'm_5 > 20', 'WSF5 * 0.44704E0')}
FROM weather_raw, (SELECT avg(AWND) m_a, avg(WSF2) m_2, avg(WSF5) m_5 FROM weather_raw) s""",
    "weather_raw"))
def q_fix_wind(spark, sf_dir):
    w = FX.weather_raw(spark, sf_dir).select("STATION", "DATE", "AWND", "WSF2", "WSF5")
    return B.fix_wind_unit(w)


@query("fix_wind_unit_awnd_10", "B5", with_views(f"""
SELECT STATION, DATE, {_conv('AWND', 'm_a > 10', 'AWND * 0.44704E0')}
FROM weather_raw, (SELECT avg(AWND) m_a FROM weather_raw) s""", "weather_raw"))
def q_fix_wind_10(spark, sf_dir):
    w = FX.weather_raw(spark, sf_dir).select("STATION", "DATE", "AWND")
    return B.fix_wind_unit(w, ["AWND"], threshold=10.0)


# B6 ---------------------------------------------------------------------------
@query("fix_precip_unit", "B6", with_views(f"""
SELECT STATION, DATE, {_conv('PRCP', 'mx_p < 20', 'PRCP * 25.4E0')}
FROM weather_raw, (SELECT max(PRCP) mx_p FROM weather_raw) s""", "weather_raw"))
def q_fix_precip(spark, sf_dir):
    return B.fix_precip_unit(FX.weather_raw(spark, sf_dir).select("STATION", "DATE", "PRCP"))


# B7 ---------------------------------------------------------------------------
@query("fill_tavg", "B7", with_views("""
SELECT STATION, DATE, TMAX, TMIN,
       CASE WHEN TAVG IS NULL AND TMAX IS NOT NULL AND TMIN IS NOT NULL THEN (TMAX + TMIN) / 2 ELSE TAVG END AS TAVG,
       coalesce(TAVG IS NULL AND TMAX IS NOT NULL AND TMIN IS NOT NULL, false) AS TAVG_calculated
FROM weather_raw""", "weather_raw"))
def q_fill_tavg(spark, sf_dir):
    return B.fill_tavg(FX.weather_raw(spark, sf_dir).select("STATION", "DATE", "TMAX", "TMIN", "TAVG"))


# B8 ---------------------------------------------------------------------------
@query("filter_overlap", "B8", with_views("""
SELECT p.* FROM pollen p JOIN (
  SELECT a.site_id, greatest(a_start, b_start) AS s, least(a_end, b_end) AS e
  FROM (SELECT site_id, min(date) a_start, max(date) a_end FROM pollen GROUP BY site_id) a
  JOIN (SELECT site_id, min(date) b_start, max(date) b_end FROM weather_site GROUP BY site_id) b
  ON a.site_id = b.site_id) o ON p.site_id = o.site_id
WHERE p.date BETWEEN o.s AND o.e""", "pollen", "weather_site"))
def q_filter_overlap(spark, sf_dir):
    p = FX.pollen(spark, sf_dir)
    ov = C.date_overlap(p, FX.weather_site(spark, sf_dir), by=("site_id",))
    return B.filter_overlap(p, ov, by=("site_id",))


# B9 ---------------------------------------------------------------------------
@query("drop_incomplete", "B9", with_views(
    "SELECT * FROM weather_raw WHERE TAVG IS NOT NULL AND PRCP IS NOT NULL", "weather_raw"))
def q_drop_incomplete(spark, sf_dir):
    return B.drop_incomplete(FX.weather_raw(spark, sf_dir), ["TAVG", "PRCP"])


# B10 --------------------------------------------------------------------------
@query("align_features", "B10", with_views(
    "SELECT site_id, date, TMAX, 0.0E0 AS RH, PRCP, AWND FROM weather_site", "weather_site"))
def q_align(spark, sf_dir):
    return B.align_features(FX.weather_site(spark, sf_dir), ["TMAX", "RH", "PRCP", "AWND"],
                            keep=["site_id", "date"])


# B11 --------------------------------------------------------------------------
def _qc_sql():
    rows = []
    for c in ("TMAX", "TMIN", "TAVG"):
        rows.append(f"SELECT site_id, '{c}_min' AS check, cast(min({c}) AS double) AS value, "
                    f"min({c}) >= -40 AS ok FROM joined GROUP BY site_id")
        rows.append(f"SELECT site_id, '{c}_max', cast(max({c}) AS double), max({c}) <= 45 "
                    f"FROM joined GROUP BY site_id")
    rows.append("SELECT site_id, 'TMAX_ge_TMIN', cast(count_if(NOT coalesce(TMAX >= TMIN, false)) AS double), "
                "count_if(NOT coalesce(TMAX >= TMIN, false)) = 0 FROM joined GROUP BY site_id")
    rows.append("SELECT site_id, 'TMIN_le_TAVG_le_TMAX', "
                "cast(count_if(NOT coalesce(TAVG >= TMIN AND TAVG <= TMAX, false)) AS double), "
                "count_if(NOT coalesce(TAVG >= TMIN AND TAVG <= TMAX, false)) = 0 FROM joined GROUP BY site_id")
    rows.append("SELECT site_id, 'PRCP_negative', cast(count_if(PRCP < 0) AS double), count_if(PRCP < 0) = 0 "
                "FROM joined GROUP BY site_id")
    rows.append("SELECT site_id, 'AWND_max', cast(max(AWND) AS double), coalesce(max(AWND) <= 50, true) "
                "FROM joined GROUP BY site_id")
    return with_views("\nUNION ALL ".join(rows), "joined")


@query("quality_checks", "B11", _qc_sql())
def q_quality(spark, sf_dir):
    return B.quality_checks(FX.joined(spark, sf_dir), by=("site_id",))


# B12 --------------------------------------------------------------------------
def _checked(table):
    return f"""
SELECT request_id, pos, date,
       coalesce(array_to_string(list_filter([
         CASE WHEN date IS NULL THEN 'date_missing' END,
         CASE WHEN temp_max IS NULL THEN 'temp_max_missing' END,
         CASE WHEN temp_min IS NULL THEN 'temp_min_missing' END,
         CASE WHEN temp_max < -50 OR temp_max > 150 THEN 'temp_max_range' END,
         CASE WHEN temp_min < -50 OR temp_min > 150 THEN 'temp_min_range' END,
         CASE WHEN temp_avg < -50 OR temp_avg > 150 THEN 'temp_avg_range' END,
         CASE WHEN precipitation < 0 THEN 'precipitation_negative' END,
         CASE WHEN wind_speed < 0 THEN 'wind_negative' END,
         CASE WHEN temp_max < temp_min THEN 'max_below_min' END], lambda x: x IS NOT NULL), ','), '') AS reasons,
       temp_max IS NOT NULL AND temp_min IS NOT NULL AND date IS NOT NULL
         AND coalesce(NOT (temp_max < -50 OR temp_max > 150), true)
         AND coalesce(NOT (temp_min < -50 OR temp_min > 150), true)
         AND coalesce(NOT (temp_avg < -50 OR temp_avg > 150), true)
         AND coalesce(precipitation >= 0, true) AND coalesce(wind_speed >= 0, true)
         AND coalesce(temp_max >= temp_min, true) AS is_valid
FROM {table}"""


def _reasons(df):
    return df.select("request_id", "pos", "date", F.array_join("reasons", ",").alias("reasons"))


@query("validate_requests", "B12", with_views(_checked("requests"), "requests"))
def q_validate(spark, sf_dir):
    r = B.validate_requests(FX.requests(spark, sf_dir))
    return r.select("request_id", "pos", "date", F.array_join("reasons", ",").alias("reasons"), "is_valid")


@query("rejected_requests", "B12", with_views(
    f"SELECT request_id, pos, date, reasons FROM ({_checked('messy_requests')}) c WHERE NOT is_valid", "messy_requests"))
def q_rejected(spark, sf_dir):
    return _reasons(B.split_requests(FX.messy_requests(spark, sf_dir))[1])


@query("rejection_reasons", "B12", with_views(
    f"SELECT reasons, count(*) AS n FROM ({_checked('messy_requests')}) c GROUP BY reasons", "messy_requests"))
def q_reasons(spark, sf_dir):
    r = B.validate_requests(FX.messy_requests(spark, sf_dir))
    return r.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(F.count(F.lit(1)).alias("n"))


# B16 --------------------------------------------------------------------------
@query("edge_impute", "B16", with_views("""
SELECT site_id, date, coalesce(TAVG, first_value(TAVG IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY date
       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0.0E0) AS TAVG_filled
FROM weather_site""", "weather_site"))
def q_edge_impute(spark, sf_dir):
    w = FX.weather_site(spark, sf_dir)
    return w.select("site_id", "date", W.edge_impute("TAVG").alias("TAVG_filled"))


# B17 --------------------------------------------------------------------------
@query("clip", "B17", with_views("""
SELECT site_id, date, CASE WHEN TAVG IS NOT NULL THEN least(greatest(TAVG, 0.0E0), 10.0E0) END AS TAVG_clipped
FROM weather_site""", "weather_site"))
def q_clip(spark, sf_dir):
    w = FX.weather_site(spark, sf_dir)
    return w.select("site_id", "date", B.clip(F.col("TAVG"), 0, 10).alias("TAVG_clipped"))


# C1 ---------------------------------------------------------------------------
@query("join_daily", "C1", with_views("""
SELECT p.*, w.TMAX, w.TMIN, w.TAVG, w.PRCP, w.AWND
FROM pollen p JOIN weather_site w ON p.site_id = w.site_id AND p.date = w.date""", "pollen", "weather_site"))
def q_join_daily(spark, sf_dir):
    return C.join_daily(FX.pollen(spark, sf_dir), FX.weather_site(spark, sf_dir))


# C2 ---------------------------------------------------------------------------
@query("date_overlap", "C2", with_views("""
SELECT a.site_id, a_start, a_end, a_rows, b_start, b_end, b_rows,
       greatest(a_start, b_start) AS overlap_start, least(a_end, b_end) AS overlap_end
FROM (SELECT site_id, min(date) a_start, max(date) a_end, count(*) a_rows FROM pollen GROUP BY site_id) a
JOIN (SELECT site_id, min(date) b_start, max(date) b_end, count(*) b_rows FROM weather_site GROUP BY site_id) b
ON a.site_id = b.site_id""", "pollen", "weather_site"))
def q_date_overlap(spark, sf_dir):
    return C.date_overlap(FX.pollen(spark, sf_dir), FX.weather_site(spark, sf_dir), by=("site_id",))


@query("date_overlap_global", "C2", with_views("""
SELECT a_start, a_end, a_rows, b_start, b_end, b_rows,
       greatest(a_start, b_start) AS overlap_start, least(a_end, b_end) AS overlap_end
FROM (SELECT min(date) a_start, max(date) a_end, count(*) a_rows FROM pollen) a,
     (SELECT min(date) b_start, max(date) b_end, count(*) b_rows FROM weather_site) b""",
    "pollen", "weather_site"))
def q_date_overlap_global(spark, sf_dir):
    return C.date_overlap(FX.pollen(spark, sf_dir), FX.weather_site(spark, sf_dir))


# C3-C5 ------------------------------------------------------------------------
@query("common_dates", "C3", with_views(
    "SELECT site_id, date FROM pollen INTERSECT SELECT site_id, date FROM weather_site",
    "pollen", "weather_site"))
def q_common(spark, sf_dir):
    return C.common_dates(FX.pollen(spark, sf_dir), FX.weather_site(spark, sf_dir))


@query("left_only_dates", "C4", with_views(
    "SELECT site_id, date FROM pollen EXCEPT SELECT site_id, date FROM weather_site",
    "pollen", "weather_site"))
def q_left_only(spark, sf_dir):
    return C.left_only_dates(FX.pollen(spark, sf_dir), FX.weather_site(spark, sf_dir))


@query("right_only_dates", "C5", with_views(
    "SELECT site_id, date FROM weather_site EXCEPT SELECT site_id, date FROM pollen",
    "pollen", "weather_site"))
def q_right_only(spark, sf_dir):
    return C.right_only_dates(FX.pollen(spark, sf_dir), FX.weather_site(spark, sf_dir))


@query("date_set_counts", "C3,C4,C5", with_views("""
SELECT coalesce(a.site_id, b.site_id) AS site_id,
       cast(count_if(a.date IS NOT NULL AND b.date IS NOT NULL) AS bigint) AS common,
       cast(count_if(a.date IS NOT NULL AND b.date IS NULL) AS bigint) AS left_only,
       cast(count_if(a.date IS NULL AND b.date IS NOT NULL) AS bigint) AS right_only,
       coalesce(array_to_string(list_sort(list(CAST(a.date AS varchar)) FILTER (WHERE b.date IS NULL))[1:5], ','), '')
         AS left_only_first,
       coalesce(array_to_string(list_sort(list(CAST(b.date AS varchar)) FILTER (WHERE a.date IS NULL))[1:5], ','), '')
         AS right_only_first
FROM (SELECT DISTINCT site_id, date FROM pollen) a
FULL OUTER JOIN (SELECT DISTINCT site_id, date FROM weather_site) b
ON a.site_id = b.site_id AND a.date = b.date
GROUP BY coalesce(a.site_id, b.site_id)""", "pollen", "weather_site"))
def q_date_set_counts(spark, sf_dir):
    s = C.date_set_summary(FX.pollen(spark, sf_dir), FX.weather_site(spark, sf_dir))
    first = [F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
             for c in ("left_only_first", "right_only_first")]
    return s.select("site_id", "common", "left_only", "right_only", *first)


# C6 ---------------------------------------------------------------------------
@query("station_record_counts", "C6", with_views("""
SELECT STATION, count(*) AS records FROM weather_raw
WHERE STATION IN (SELECT STATION FROM weather_raw WHERE regexp_matches(NAME, '(?i)nation_1[0-4]$|nation_3$'))
GROUP BY STATION""", "weather_raw"))
def q_station_counts(spark, sf_dir):
    w = FX.weather_raw(spark, sf_dir)
    return C.station_record_counts(w, B.search_stations(w, "nation_1[0-4]$|nation_3$"))


# C8 ---------------------------------------------------------------------------
@query("broadcast_scalar", "C8", with_views("""
SELECT w.site_id, w.date, w.TMAX, g.tmax_mean, s.site_tmax_mean, w.TMAX - s.site_tmax_mean AS tmax_vs_site
FROM weather_site w, (SELECT avg(TMAX) AS tmax_mean FROM weather_site) g,
     (SELECT site_id, avg(TMAX) AS site_tmax_mean FROM weather_site GROUP BY site_id) s
WHERE w.site_id = s.site_id""", "weather_site"))
def q_broadcast_scalar(spark, sf_dir):
    w = FX.weather_site(spark, sf_dir).select("site_id", "date", "TMAX")
    w = C.broadcast_scalar(w, {"tmax_mean": F.avg("TMAX")})
    w = C.broadcast_scalar(w, {"site_tmax_mean": F.avg("TMAX")}, by=("site_id",))
    return w.withColumn("tmax_vs_site", F.col("TMAX") - F.col("site_tmax_mean"))
