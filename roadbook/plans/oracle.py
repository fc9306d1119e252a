"""DuckDB SQL twins of the fixtures and stages, for the correctness oracle.

Each query string is assembled from named CTEs so that the stage logic is
written once in SQL, independently of the DataFrame code it checks. DuckDB's
``dayofweek`` counts from 0 = Sunday, hence the ``+ 1`` below.
"""

from __future__ import annotations

BOX = "DEC_LATITUDE BETWEEN 39.867 AND 40.138 AND DEC_LONGITUDE BETWEEN -75.28 AND -74.956"

CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def with_(names: list[str], select: str) -> str:
    """``WITH`` the named CTEs (in the given order) followed by ``select``."""
    parts = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in names)
    return f"WITH {parts}\n{select.strip()}"


cte("crash", """
SELECT CAST(o_orderkey AS VARCHAR) AS CRN,
       CAST(year(o_orderdate) AS INTEGER) AS CRASH_YEAR,
       CAST(month(o_orderdate) AS INTEGER) AS CRASH_MONTH,
       CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE CAST(dayofweek(o_orderdate) + 1 AS INTEGER) END AS DAY_OF_WEEK,
       CAST(o_orderkey % 24 AS INTEGER) AS HOUR_OF_DAY,
       67 AS COUNTY,
       CASE WHEN starts_with(o_orderpriority, '1') THEN 1 ELSE 0 END AS PED_COUNT,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS MAX_SEVERITY_LEVEL,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 997 = 1 THEN 0.0::DOUBLE
            ELSE 39.80::DOUBLE + CAST(o_orderkey % 4000 AS DOUBLE) / 10000.0::DOUBLE END AS DEC_LATITUDE,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 997 = 1 THEN 0.0::DOUBLE
            ELSE -75.32::DOUBLE + CAST(o_custkey % 450 AS DOUBLE) / 1000.0::DOUBLE END AS DEC_LONGITUDE,
       CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN 'unknown'
            WHEN o_orderkey % 211 = 0 THEN strftime(CAST(o_orderdate AS DATE) + INTERVAL 12 MONTH, '%Y-%m-%d')
            ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS CRASH_DATE_TEXT
FROM orders
""")

cte("person", """
SELECT CAST(l_orderkey AS VARCHAR) AS CRN,
       CASE l_returnflag WHEN 'A' THEN 'PEDESTRIAN' WHEN 'N' THEN 'BICYCLIST' WHEN 'R' THEN 'DRIVER' END AS PERSON_TYPE,
       l_linenumber AS PERSON_NUM,
       CAST(l_suppkey % 9 AS INTEGER) AS INJ_SEVERITY
FROM lineitem
""")

cte("vehicle", """
SELECT CAST(l_orderkey AS VARCHAR) AS CRN, l_returnflag AS VEH_TYPE,
       CAST(l_linenumber AS VARCHAR) AS VEH_ROLE_CD, l_linestatus AS VEH_STATUS
FROM lineitem
""")

cte("roadway", """
SELECT CAST(l_orderkey AS VARCHAR) AS CRN, l_linenumber AS LANE_COUNT,
       CAST(l_suppkey AS VARCHAR) AS ROUTE, CAST(l_suppkey % 67 + 1 AS INTEGER) AS COUNTY
FROM lineitem
""")

HELMET = """CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Y'
            WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'N'
            WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'U'
            WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN ''
            WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
            WHEN l_partkey % 2 = 0 THEN ' y ' ELSE 'X' END"""

cte("cycle", f"""
SELECT CAST(l_orderkey AS VARCHAR) AS CRN, {HELMET} AS PC_HLMT_IND, {HELMET} AS HELMET_IND,
       CAST(l_quantity AS INTEGER) AS BIKE_UNITS
FROM lineitem WHERE l_linenumber = 1 AND l_quantity < 10
""")

cte("wx_daily", """
SELECT CAST(l_shipdate AS DATE) AS date, SUM(l_linenumber) AS s_ln, CAST(SUM(l_quantity) AS BIGINT) AS s_qty,
       COUNT(*) AS n, SUM(l_partkey) AS s_pk
FROM lineitem GROUP BY 1
""")

cte("wx_raw", """
SELECT date,
       CAST(((s_qty % 56) - 12 + 4) * 10 AS DOUBLE) AS TMAX,
       CAST(((s_qty % 56) - 12 - 4) * 10 AS DOUBLE) AS TMIN,
       CASE WHEN year(date) IN (1995, 1996) THEN NULL ELSE CAST(((s_qty % 56) - 12) * 10 AS DOUBLE) END AS TAVG,
       CAST(s_ln % 29 AS DOUBLE) / 2.0::DOUBLE AS PRCP,
       CAST(NULL AS DOUBLE) AS AWND,
       CAST(n % 23 AS DOUBLE) AS WSF2,
       CASE WHEN s_pk % 17 = 0 THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS SNOW,
       CAST(NULL AS DOUBLE) AS SNWD
FROM wx_daily
""")

cte("weather", """
SELECT date,
       TMAX / 10.0::DOUBLE AS temp_max_c, TMIN / 10.0::DOUBLE AS temp_min_c, TAVG / 10.0::DOUBLE AS temp_avg_c,
       PRCP AS precipitation_mm, AWND AS wind_speed_avg_ms, WSF2 AS wind_speed_max_ms,
       SNOW AS snowfall_mm, SNWD AS snow_depth_mm
FROM wx_raw
""")

# --- geographic stage -------------------------------------------------------
cte("geo_in", """
SELECT *, (coalesce(DEC_LATITUDE = 0 AND DEC_LONGITUDE = 0, false) OR DEC_LATITUDE IS NULL OR DEC_LONGITUDE IS NULL
           OR coalesce(DEC_LATITUDE < -90, false) OR coalesce(DEC_LATITUDE > 90, false)
           OR coalesce(DEC_LONGITUDE < -180, false) OR coalesce(DEC_LONGITUDE > 180, false)) AS _invalid
FROM crash
""")

cte("geo_rounded", """
SELECT * EXCLUDE (_invalid, DEC_LATITUDE, DEC_LONGITUDE),
       CASE WHEN DEC_LATITUDE IS NOT NULL AND DEC_LONGITUDE IS NOT NULL THEN round(DEC_LATITUDE, 6) ELSE DEC_LATITUDE END AS DEC_LATITUDE,
       CASE WHEN DEC_LATITUDE IS NOT NULL AND DEC_LONGITUDE IS NOT NULL THEN round(DEC_LONGITUDE, 6) ELSE DEC_LONGITUDE END AS DEC_LONGITUDE,
       CASE WHEN _invalid THEN 'INVALID' END AS _flag1,
       CASE WHEN coalesce(TRY_CAST(CAST(COUNTY AS VARCHAR) AS DOUBLE) <> 51, true) THEN 'NON_PHILLY_COUNTY' END AS COUNTY_QUALITY_FLAG
FROM geo_in
""")

cte("geo_flagged", f"""
SELECT * EXCLUDE (_flag1),
       CASE WHEN NOT coalesce({BOX}, false) AND DEC_LATITUDE IS NOT NULL THEN 'OUTSIDE_PHILLY' ELSE _flag1 END AS COORD_QUALITY_FLAG
FROM geo_rounded
""")

cte("geo", f"""
SELECT * FROM geo_flagged WHERE coalesce({BOX}, false) OR DEC_LATITUDE IS NULL
""")

# --- date reconstruction ----------------------------------------------------
WEEKDAY = """CASE WHEN {dow} IS NOT NULL THEN make_date({y}, {m}, 1)
     + CAST((({dow} - (dayofweek(make_date({y}, {m}, 1)) + 1)) % 7 + 7) % 7 AS INTEGER) END"""

cte("dated", f"""
SELECT * EXCLUDE (_wk),
       coalesce(_wk, make_date(CRASH_YEAR, CRASH_MONTH, 15)) AS crash_date,
       CASE WHEN _wk IS NULL THEN 15 END AS CRASH_DAY,
       CASE WHEN _wk IS NOT NULL THEN 'weekday_reconstructed' ELSE 'mid_month_fallback' END AS date_approximation_method
FROM (SELECT *, {WEEKDAY.format(dow='DAY_OF_WEEK', y='CRASH_YEAR', m='CRASH_MONTH')} AS _wk FROM geo)
""")

FEATURES = """
       CASE WHEN precipitation_mm IS NULL THEN NULL WHEN precipitation_mm <= 0.1 THEN 'none'
            WHEN precipitation_mm <= 2.5 THEN 'light' WHEN precipitation_mm <= 10 THEN 'moderate' ELSE 'heavy' END AS precip_category,
       CAST(coalesce(precipitation_mm > 2.5, false) OR coalesce(wind_speed_max_ms > 15, false)
            OR coalesce(snowfall_mm > 0, false) AS INTEGER) AS adverse_weather,
       CASE WHEN temp_avg_c IS NULL THEN NULL WHEN temp_avg_c <= 0 THEN 'cold' WHEN temp_avg_c <= 10 THEN 'cool'
            WHEN temp_avg_c <= 20 THEN 'mild' WHEN temp_avg_c <= 30 THEN 'warm' ELSE 'hot' END AS temp_category,
       CAST(coalesce(temp_avg_c < -5, false) OR coalesce(temp_avg_c > 35, false) AS INTEGER) AS extreme_temp"""

cte("crash_weather", f"""
SELECT j.*, {FEATURES}
FROM (SELECT d.*, w.* EXCLUDE (date) FROM dated d LEFT JOIN weather w ON w.date = d.crash_date) j
""")

cte("wx_long", """
SELECT date, datatype, value FROM (
  SELECT date, 'PRCP' AS datatype, CAST(s_ln % 29 AS DOUBLE) / 2.0::DOUBLE AS value FROM wx_daily
  UNION ALL SELECT date, 'TAVG', CASE WHEN year(date) IN (1995, 1996) THEN NULL ELSE CAST(((s_qty % 56) - 12) * 10 AS DOUBLE) END FROM wx_daily
  UNION ALL SELECT date, 'TMAX', CAST(((s_qty % 56) - 12 + 4) * 10 AS DOUBLE) FROM wx_daily
  UNION ALL SELECT date, 'TMIN', CAST(((s_qty % 56) - 12 - 4) * 10 AS DOUBLE) FROM wx_daily
  UNION ALL SELECT date, 'WSF2', CAST(n % 23 AS DOUBLE) FROM wx_daily
  UNION ALL SELECT date, 'SNOW', CASE WHEN s_pk % 17 = 0 THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END FROM wx_daily)
WHERE value IS NOT NULL
""")

CRASH_WEATHER = ["crash", "wx_daily", "wx_raw", "weather", "geo_in", "geo_rounded", "geo_flagged", "geo",
                 "dated", "crash_weather"]
