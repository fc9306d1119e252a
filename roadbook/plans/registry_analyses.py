"""Registered queries for the documented analyses."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from roadbook.operators import analyses as X
from roadbook.operators import dates as T
from roadbook.operators import weather as W
from roadbook.plans import fixtures as fx
from roadbook.plans import oracle as O
from roadbook.plans import stages
from roadbook.plans.registry import register
from roadbook.plans.registry_datasets import CW



@register("monthly_summary", O.with_(CW, """
SELECT CRASH_YEAR, CRASH_MONTH, COUNT(*) AS crashes, CAST(SUM(adverse_weather) AS BIGINT) AS adverse_crashes,
       round(AVG(temp_avg_c), 2) AS avg_temp_c, round(AVG(precipitation_mm), 2) AS avg_precip_mm
FROM crash_weather GROUP BY 1, 2"""))
def q_monthly_summary(spark, sf):
    return X.monthly_summary(stages.crash_weather(spark, sf))


@register("area_aggregate", O.with_(CW, """
SELECT CAST(floor(DEC_LATITUDE / 0.01::DOUBLE) AS BIGINT) AS cell_lat, CAST(floor(DEC_LONGITUDE / 0.01::DOUBLE) AS BIGINT) AS cell_lon,
       COUNT(*) AS crashes, MAX(MAX_SEVERITY_LEVEL) AS max_severity
FROM crash_weather WHERE DEC_LATITUDE IS NOT NULL AND DEC_LONGITUDE IS NOT NULL GROUP BY 1, 2"""))
def q_area_aggregate(spark, sf):
    return X.area_aggregate(stages.crash_weather(spark, sf))


@register("rename_detection", """
WITH inv AS (
  SELECT y.shard_year, c.name AS col FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS shard_year FROM orders) y,
    (VALUES ('o_orderkey'), ('o_custkey'), ('o_orderstatus'), ('o_totalprice'), ('o_orderdate'), ('o_orderpriority'),
            ('o_order_priority'), ('o_comment')) c(name)
  WHERE NOT (c.name = 'o_orderpriority' AND y.shard_year <= 1996)
    AND NOT (c.name = 'o_order_priority' AND y.shard_year > 1996)
    AND NOT (c.name = 'o_comment' AND y.shard_year > 1995)),
spans AS (SELECT col, MIN(shard_year) AS first_year, MAX(shard_year) AS last_year FROM inv GROUP BY 1)
SELECT a.col AS old_column, b.col AS new_column, a.last_year AS old_last, b.first_year AS new_first,
       CAST(levenshtein(upper(a.col), upper(b.col)) AS INTEGER) AS distance
FROM spans a, spans b
WHERE a.col <> b.col AND a.last_year < b.first_year AND levenshtein(upper(a.col), upper(b.col)) <= 2""")
def q_rename_detection(spark, sf):
    inv = fx.shard_inventory(spark, sf)
    years = inv.select("shard_year").distinct()
    extra = (years.filter(F.col("shard_year") <= 1996).select("shard_year", F.lit("o_order_priority").alias("column"))
             .unionByName(years.filter(F.col("shard_year") <= 1995).select("shard_year", F.lit("o_comment").alias("column"))))
    return X.rename_detection(inv.unionByName(extra))


O.cte("drifting", """
SELECT y.shard_year, c.name AS col, row_number() OVER (PARTITION BY y.shard_year ORDER BY c.place) - 1 AS ordinal
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS shard_year FROM orders) y,
  (VALUES ('CRN', 0, 0, 9999), ('DEC_LAT', 1, 0, 1995), ('DEC_LATITUDE', 1, 1996, 9999), ('DEC_LONG', 2, 0, 1995), ('DEC_LONGITUDE', 2, 1996, 9999),
          ('COUNTY', 3, 0, 9999), ('SEV', 4, 0, 1994), ('INJURY_LEVEL', 4, 1995, 9999), ('HOUR', 5, 0, 9999), ('LANE_CNT', 6, 0, 1996),
          ('NOTE', 6.5, 1997, 9999), ('LANE_COUNT', 7, 1997, 9999)) c(name, place, since, until)
WHERE y.shard_year BETWEEN c.since AND c.until""")


@register("rename_hints", O.with_(["drifting"], """,
placed AS (SELECT *, lag(col, 1, '') OVER w AS prev, lead(col, 1, '') OVER w AS next FROM drifting WINDOW w AS (PARTITION BY shard_year ORDER BY ordinal)),
o AS (SELECT * FROM placed QUALIFY row_number() OVER (PARTITION BY col ORDER BY shard_year DESC) = 1),
n AS (SELECT * FROM placed QUALIFY row_number() OVER (PARTITION BY col ORDER BY shard_year) = 1)
SELECT o.col AS old_column, n.col AS new_column, o.shard_year AS old_last, n.shard_year AS new_first,
  CAST(levenshtein(upper(o.col), upper(n.col)) AS INTEGER) AS distance, o.ordinal = n.ordinal AS same_place,
  o.prev = n.prev AND o.next = n.next AS same_neighbours
FROM o, n WHERE o.col <> n.col AND o.shard_year < n.shard_year
  AND (levenshtein(upper(o.col), upper(n.col)) <= 2 OR (o.prev = n.prev AND o.next = n.next)
       OR (o.ordinal = n.ordinal AND (starts_with(upper(o.col), upper(n.col)) OR starts_with(upper(n.col), upper(o.col)))))"""))
def q_rename_hints(spark, sf):
    """X3 by place and name: pairs of coordinate columns renamed at once, a renamed column between the same neighbours, a moved one."""
    years = fx.shard_inventory(spark, sf).select("shard_year").distinct()
    names = [("CRN", 0.0, 0, 9999), ("DEC_LAT", 1.0, 0, 1995), ("DEC_LATITUDE", 1.0, 1996, 9999), ("DEC_LONG", 2.0, 0, 1995), ("DEC_LONGITUDE", 2.0, 1996, 9999),
             ("COUNTY", 3.0, 0, 9999), ("SEV", 4.0, 0, 1994), ("INJURY_LEVEL", 4.0, 1995, 9999), ("HOUR", 5.0, 0, 9999), ("LANE_CNT", 6.0, 0, 1996),
             ("NOTE", 6.5, 1997, 9999), ("LANE_COUNT", 7.0, 1997, 9999)]
    listed = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(at).alias("at"), F.lit(a).alias("since"), F.lit(b).alias("until")) for c, at, a, b in names])
    drifting = years.select("shard_year", F.inline(listed)).filter(F.col("shard_year").between(F.col("since"), F.col("until")))
    order = Window.partitionBy("shard_year").orderBy("at")
    inv = drifting.select("shard_year", "column", (F.row_number().over(order) - 1).alias("ordinal"))
    return X.rename_hints(inv).drop("similarity")


@register("low_precision_flag", O.with_(CW, f"""
SELECT CRN, coalesce(({{lp}} < 4) OR ({{op}} < 4), false) AS low_precision FROM crash_weather"""
    .replace("{lp}", "CASE WHEN DEC_LATITUDE IS NULL THEN NULL WHEN contains(CAST(DEC_LATITUDE AS VARCHAR), '.') THEN length(split_part(CAST(DEC_LATITUDE AS VARCHAR), '.', -1)) ELSE 0 END")
    .replace("{op}", "CASE WHEN DEC_LONGITUDE IS NULL THEN NULL WHEN contains(CAST(DEC_LONGITUDE AS VARCHAR), '.') THEN length(split_part(CAST(DEC_LONGITUDE AS VARCHAR), '.', -1)) ELSE 0 END")))
def q_low_precision(spark, sf):
    return X.low_precision_flag(stages.crash_weather(spark, sf)).select("CRN", "low_precision")


@register("duplicate_detection", O.with_(["cycle"], "SELECT CRN, COUNT(*) AS n FROM cycle GROUP BY 1 HAVING COUNT(*) > 1"))
def q_duplicate_detection(spark, sf):
    return X.duplicate_keys(fx.cycle(spark, sf))


@register("referential_integrity", O.with_(["crash", "geo_in", "geo_rounded", "geo_flagged", "geo", "person"], """
SELECT * FROM person p WHERE NOT EXISTS (SELECT 1 FROM geo g WHERE g.CRN = p.CRN)"""))
def q_referential_integrity(spark, sf):
    return X.orphans(fx.person(spark, sf), stages.crash_geographic(spark, sf))


@register("numeric_outliers", """
WITH long AS (
  SELECT 'l_quantity' AS field, CAST(l_quantity AS DOUBLE) AS value FROM lineitem
  UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT 'l_tax', l_tax FROM lineitem),
v AS (SELECT * FROM long WHERE value IS NOT NULL AND NOT isnan(value)),
q AS (SELECT field, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM v GROUP BY 1),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT f.field, q1, q3, iqr, lower, upper, COUNT(*) FILTER (WHERE value < lower OR value > upper) AS n_outliers,
       COUNT(*) AS n_values
FROM v JOIN f ON v.field = f.field GROUP BY ALL""")
def q_numeric_outliers(spark, sf):
    return X.numeric_outliers(fx.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


O.cte("wx_wd", """
SELECT CAST(year(date) AS INTEGER) AS CRASH_YEAR, CAST(month(date) AS INTEGER) AS CRASH_MONTH,
       CAST(dayofweek(date) + 1 AS INTEGER) AS DAY_OF_WEEK,
       AVG(temp_avg_c) AS temp_avg_c_wdavg, AVG(precipitation_mm) AS precipitation_mm_wdavg, COUNT(*) AS wx_days_wdavg
FROM weather GROUP BY 1, 2, 3
""")


@register("weekday_multi_weather", O.with_(["crash", "crash_dated_all", "wx_daily", "wx_raw", "weather", "wx_wd"], """
SELECT d.CRN, d.CRASH_YEAR, d.CRASH_MONTH, d.DAY_OF_WEEK, round(w.temp_avg_c_wdavg, 6) AS temp_avg_c_wdavg,
       round(w.precipitation_mm_wdavg, 6) AS precipitation_mm_wdavg, w.wx_days_wdavg
FROM crash_dated_all d LEFT JOIN wx_wd w USING (CRASH_YEAR, CRASH_MONTH, DAY_OF_WEEK)"""))
def q_weekday_multi_weather(spark, sf):
    wx = stages.weather_table(spark, sf).select("date", "temp_avg_c", "precipitation_mm")
    dated = T.reconstruct_dates(fx.crash(spark, sf))
    out = X.weekday_multi_weather(dated, W.weather_by_weekday(wx))
    return out.select("CRN", "CRASH_YEAR", "CRASH_MONTH", "DAY_OF_WEEK",
                      F.round("temp_avg_c_wdavg", 6).alias("temp_avg_c_wdavg"),
                      F.round("precipitation_mm_wdavg", 6).alias("precipitation_mm_wdavg"), "wx_days_wdavg")


@register("adverse_vs_clear", O.with_(CW, "SELECT CRASH_MONTH, adverse_weather, COUNT(*) AS crashes FROM crash_weather GROUP BY 1, 2"))
def q_adverse_vs_clear(spark, sf):
    return X.adverse_vs_clear(stages.crash_weather(spark, sf))


@register("helmet_by_severity", O.with_(CW + ["person", "vehicle", "cycle", "vsum2", "j_cycle", "j_cyc_person", "cyclist"], """
SELECT MAX_SEVERITY_LEVEL,
       NULLIF(COUNT(*) FILTER (WHERE h = 'Y'), 0) AS Y, NULLIF(COUNT(*) FILTER (WHERE h = 'N'), 0) AS N,
       NULLIF(COUNT(*) FILTER (WHERE h = 'U'), 0) AS U
FROM (SELECT *, CASE WHEN upper(trim(HELMET_IND)) IN ('Y', 'N', 'U') THEN upper(trim(HELMET_IND)) ELSE 'U' END AS h FROM cyclist)
GROUP BY 1"""))
def q_helmet_by_severity(spark, sf):
    return X.helmet_by_severity(stages.cyclist(spark, sf))


@register("season_hour_patterns", O.with_(CW + ["person", "vehicle", "cycle", "vsum2", "j_cycle", "j_cyc_person", "cyclist"], """
SELECT CRASH_MONTH, COUNT(DISTINCT CRN) AS crashes FROM cyclist GROUP BY 1"""))
def q_season(spark, sf):
    return X.by_month(stages.cyclist(spark, sf))


@register("pedestrian_by_hour", O.with_(CW + ["person", "vehicle", "vsum1", "j_ped_person", "pedestrian"], """
SELECT HOUR_OF_DAY, COUNT(DISTINCT CRN) AS crashes FROM pedestrian GROUP BY 1"""))
def q_ped_hour(spark, sf):
    return X.by_hour(stages.pedestrian(spark, sf))


@register("person_type_gap", O.with_(["crash", "person"], """
SELECT * FROM crash c WHERE PED_COUNT > 0
  AND NOT EXISTS (SELECT 1 FROM person p WHERE p.PERSON_TYPE = 'PEDESTRIAN' AND p.CRN = c.CRN)"""))
def q_person_type_gap(spark, sf):
    return X.person_type_gap(fx.crash(spark, sf), fx.person(spark, sf))
