"""Registered queries for joins/datasets (J, D, F5-F7, X13, X15), quality (Q) and validation (V)."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadbook.operators import datasets as D
from roadbook.operators import quality as Q
from roadbook.operators import validate as V
from roadbook.operators.joins import join_suffixed
from roadbook.plans import fixtures as fx
from roadbook.plans import oracle as O
from roadbook.plans import stages
from roadbook.plans.registry import ORACLE, register
from roadbook.session import materialize

CW = O.CRASH_WEATHER

O.cte("vsum2", """
SELECT CRN, coalesce(string_agg(DISTINCT VEH_TYPE, ', ' ORDER BY VEH_TYPE), '') AS VEH_TYPE,
       coalesce(string_agg(DISTINCT VEH_ROLE_CD, ', ' ORDER BY VEH_ROLE_CD), '') AS VEH_ROLE_CD
FROM vehicle WHERE CRN IS NOT NULL GROUP BY CRN
""")
O.cte("vsum1", """
SELECT CRN, coalesce(string_agg(DISTINCT VEH_TYPE, ', ' ORDER BY VEH_TYPE), '') AS VEH_TYPE
FROM vehicle WHERE CRN IS NOT NULL GROUP BY CRN
""")
O.cte("j_cycle", "SELECT cw.*, cy.* EXCLUDE (CRN) FROM crash_weather cw JOIN cycle cy ON cw.CRN = cy.CRN")
O.cte("j_cyc_person", """
SELECT c.*, p.* EXCLUDE (CRN) FROM j_cycle c
LEFT JOIN (SELECT * FROM person WHERE PERSON_TYPE IN ('PEDALCYCLIST', 'BICYCLIST')) p ON c.CRN = p.CRN
""")
O.cte("cyclist", "SELECT j.*, v.* EXCLUDE (CRN) FROM j_cyc_person j LEFT JOIN vsum2 v ON j.CRN = v.CRN")
O.cte("j_ped_person", """
SELECT c.*, p.* EXCLUDE (CRN) FROM (SELECT * FROM crash_weather WHERE PED_COUNT > 0) c
LEFT JOIN (SELECT * FROM person WHERE PERSON_TYPE = 'PEDESTRIAN') p ON c.CRN = p.CRN
""")
O.cte("pedestrian", "SELECT j.*, v.* EXCLUDE (CRN) FROM j_ped_person j LEFT JOIN vsum1 v ON j.CRN = v.CRN")
O.cte("full_integrated", """
SELECT c.*, r.* EXCLUDE (CRN, COUNTY), r.COUNTY AS COUNTY_roadway FROM crash_weather c LEFT JOIN roadway r ON c.CRN = r.CRN
""")

# ------------------------------------------------------------------ filters


@register("filter_person_cyclist", O.with_(["person"], "SELECT * FROM person WHERE PERSON_TYPE IN ('PEDALCYCLIST', 'BICYCLIST')"))
def q_filter_cyclist(spark, sf):
    return D.filter_cyclists(fx.person(spark, sf))


@register("filter_person_pedestrian", O.with_(["person"], "SELECT * FROM person WHERE PERSON_TYPE = 'PEDESTRIAN'"))
def q_filter_pedestrian(spark, sf):
    return D.filter_pedestrians(fx.person(spark, sf))


@register("filter_ped_count", O.with_(["crash"], "SELECT * FROM crash WHERE PED_COUNT > 0"))
def q_filter_ped_count(spark, sf):
    return D.filter_ped_count(fx.crash(spark, sf))

# -------------------------------------------------------------------- joins


@register("join_crash_cycle", O.with_(CW + ["cycle", "j_cycle"], "SELECT * FROM j_cycle"))
def q_join_crash_cycle(spark, sf):
    return join_suffixed(stages.crash_weather(spark, sf), fx.cycle(spark, sf), "CRN", "inner", "_cycle")


@register("join_cyclist_persons", O.with_(CW + ["cycle", "person", "j_cycle", "j_cyc_person"], "SELECT * FROM j_cyc_person"))
def q_join_cyclist_persons(spark, sf):
    c = join_suffixed(stages.crash_weather(spark, sf), fx.cycle(spark, sf), "CRN", "inner", "_cycle")
    return join_suffixed(c, D.filter_cyclists(fx.person(spark, sf)), "CRN", "left", "_person")


@register("vehicle_summary", O.with_(["vehicle", "vsum2"], "SELECT * FROM vsum2"))
def q_vehicle_summary(spark, sf):
    return D.vehicle_summary(fx.vehicle(spark, sf))


@register("join_vehicle_summary", O.with_(CW + ["vehicle", "vsum2"], """
SELECT c.*, v.* EXCLUDE (CRN) FROM crash_weather c LEFT JOIN vsum2 v ON c.CRN = v.CRN"""))
def q_join_vehicle_summary(spark, sf):
    return join_suffixed(stages.crash_weather(spark, sf), D.vehicle_summary(fx.vehicle(spark, sf)), "CRN", "left",
                         "_veh", fanout_safe=False)


@register("join_pedestrian_persons", O.with_(CW + ["person", "j_ped_person"], "SELECT * FROM j_ped_person"))
def q_join_pedestrian_persons(spark, sf):
    c = D.filter_ped_count(stages.crash_weather(spark, sf))
    return join_suffixed(c, D.filter_pedestrians(fx.person(spark, sf)), "CRN", "left", "_person")


@register("join_roadway", O.with_(["crash", "roadway"], """
SELECT c.CRN, c.CRASH_YEAR, r.* EXCLUDE (CRN) FROM crash c LEFT JOIN roadway r ON c.CRN = r.CRN"""))
def q_join_roadway(spark, sf):
    """J6 alone, over the whole tables."""
    return join_suffixed(fx.crash(spark, sf).select("CRN", "CRASH_YEAR"), fx.roadway(spark, sf), "CRN", "left", "_roadway")


@register("join_roadway_split", ORACLE["join_roadway"])
def q_join_roadway_split(spark, sf):
    """J6 with keys split by their number of rows (here from four rows on, so that both ways have work)."""
    return join_suffixed(fx.crash(spark, sf).select("CRN", "CRASH_YEAR"), fx.roadway(spark, sf), "CRN", "left", "_roadway", split_rows=3)


@register("suffix_collisions", O.with_(["crash", "roadway"], """
SELECT c.*, r.* EXCLUDE (CRN, COUNTY), r.COUNTY AS COUNTY_roadway FROM crash c LEFT JOIN roadway r ON c.CRN = r.CRN"""))
def q_suffix_collisions(spark, sf):
    return join_suffixed(fx.crash(spark, sf), fx.roadway(spark, sf), "CRN", "left", "_roadway")

# ----------------------------------------------------------------- datasets


@register("cyclist_focused", O.with_(CW + ["person", "vehicle", "cycle", "vsum2", "j_cycle", "j_cyc_person", "cyclist"],
                                     "SELECT * FROM cyclist"))
def q_cyclist(spark, sf):
    return stages.cyclist(spark, sf)


@register("pedestrian_focused", O.with_(CW + ["person", "vehicle", "vsum1", "j_ped_person", "pedestrian"],
                                        "SELECT * FROM pedestrian"))
def q_pedestrian(spark, sf):
    return stages.pedestrian(spark, sf)


@register("full_integrated", O.with_(CW + ["roadway", "full_integrated"], "SELECT * FROM full_integrated"))
def q_full(spark, sf):
    return stages.full(spark, sf)


@register("reference_tables", O.with_(["person"], "SELECT * FROM person"))
def q_reference_tables(spark, sf):
    return D.reference_tables(fx.person(spark, sf), fx.vehicle(spark, sf))["person"]


@register("reference_tables_vehicle", O.with_(["vehicle"], "SELECT * FROM vehicle"))
def q_reference_tables_vehicle(spark, sf):
    return D.reference_tables(fx.person(spark, sf), fx.vehicle(spark, sf))["vehicle"]


def _person_year(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").cast("string").alias("CRN"), F.year("l_shipdate").alias("DATA_YEAR"),
                     fx._person_type(F.col("l_returnflag")).alias("PERSON_TYPE"), F.col("l_linenumber").alias("PERSON_NUM"))


@register("join_crn_year", O.with_(["crash"], """
SELECT c.*, p.PERSON_TYPE, p.PERSON_NUM
FROM (SELECT *, CRASH_YEAR AS DATA_YEAR FROM crash) c
LEFT JOIN (SELECT CAST(l_orderkey AS VARCHAR) AS CRN, CAST(year(l_shipdate) AS INTEGER) AS DATA_YEAR,
                  CASE l_returnflag WHEN 'A' THEN 'PEDESTRIAN' WHEN 'N' THEN 'BICYCLIST' WHEN 'R' THEN 'DRIVER' END AS PERSON_TYPE,
                  l_linenumber AS PERSON_NUM FROM lineitem) p
ON c.CRN = p.CRN AND c.DATA_YEAR = p.DATA_YEAR"""))
def q_join_crn_year(spark, sf):
    c = fx.crash(spark, sf).withColumn("DATA_YEAR", F.col("CRASH_YEAR"))
    return D.join_on_crn_and_year(c, _person_year(spark, sf))


def _remaining(spark, sf):
    o = fx.table(spark, sf, "orders")
    li = fx.table(spark, sf, "lineitem")
    flag = o.select(F.col("o_orderkey").cast("string").alias("CRN"),
                    (F.col("o_orderstatus") == "F").cast("int").alias("FATAL_OR_MAJ_INJ"))
    commveh = li.filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")).select(
        F.col("l_orderkey").cast("string").alias("CRN"), F.col("l_suppkey").alias("CARRIER"))
    trailveh = li.filter(F.col("l_quantity") > 45).select(
        F.col("l_orderkey").cast("string").alias("CRN"), F.col("l_partkey").alias("TRAILER_ID"))
    return {"FLAG": flag, "COMMVEH": commveh, "TRAILVEH": trailveh}


@register("join_remaining_categories", O.with_(["crash"], """
SELECT c.*, f.FATAL_OR_MAJ_INJ, coalesce(f.n, 0) AS flag_rows, coalesce(cm.n, 0) AS commveh_rows, cm.CARRIER_min, cm.CARRIER_distinct,
       coalesce(t.n, 0) AS trailveh_rows, t.TRAILER_ID_min, t.TRAILER_ID_distinct
FROM crash c
LEFT JOIN (SELECT CAST(o_orderkey AS VARCHAR) AS CRN, CAST(o_orderstatus = 'F' AS INTEGER) AS FATAL_OR_MAJ_INJ,
                  CAST(1 AS BIGINT) AS n FROM orders) f ON c.CRN = f.CRN
LEFT JOIN (SELECT CAST(l_orderkey AS VARCHAR) AS CRN, COUNT(*) AS n, MIN(l_suppkey) AS CARRIER_min, COUNT(DISTINCT l_suppkey) AS CARRIER_distinct
           FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O' GROUP BY 1) cm ON c.CRN = cm.CRN
LEFT JOIN (SELECT CAST(l_orderkey AS VARCHAR) AS CRN, COUNT(*) AS n, MIN(l_partkey) AS TRAILER_ID_min,
                  COUNT(DISTINCT l_partkey) AS TRAILER_ID_distinct FROM lineitem WHERE l_quantity > 45 GROUP BY 1) t
  ON c.CRN = t.CRN"""))
def q_join_remaining(spark, sf):
    return D.join_remaining_categories(fx.crash(spark, sf), _remaining(spark, sf))

# ------------------------------------------------------------------ quality

LL = dict(lat="DEC_LATITUDE", lon="DEC_LONGITUDE")
QBOX_OUT = ("NOT (DEC_LATITUDE IS NULL OR DEC_LONGITUDE IS NULL) AND coalesce(DEC_LATITUDE < 39.867 OR DEC_LATITUDE > 40.138 "
            "OR DEC_LONGITUDE < -75.28 OR DEC_LONGITUDE > -74.956, false)")


@register("qc_missing_coords", O.with_(["crash"], """
SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE DEC_LATITUDE IS NULL OR DEC_LONGITUDE IS NULL) AS missing_coordinates,
       round(CAST(COUNT(*) FILTER (WHERE DEC_LATITUDE IS NULL OR DEC_LONGITUDE IS NULL) AS DOUBLE) * 100.0 / COUNT(*), 2) AS missing_pct
FROM crash"""))
def q_qc_missing(spark, sf):
    return Q.qc_missing_coords(fx.crash(spark, sf), **LL)


@register("qc_geo_valid", O.with_(["crash"], f"""
SELECT CRN, NOT (DEC_LATITUDE IS NULL OR DEC_LONGITUDE IS NULL) AND NOT ({QBOX_OUT}) AS geo_valid FROM crash"""))
def q_qc_geo_valid(spark, sf):
    return Q.qc_geo_valid(fx.crash(spark, sf), **LL).select("CRN", "geo_valid")


@register("qc_geo_bounds_report", O.with_(["crash"], f"""
SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE {QBOX_OUT}) AS out_of_bounds,
       round(CAST(COUNT(*) FILTER (WHERE {QBOX_OUT}) AS DOUBLE) * 100.0 / COUNT(*), 2) AS out_of_bounds_pct,
       COUNT(*) FILTER (WHERE NOT (DEC_LATITUDE IS NULL OR DEC_LONGITUDE IS NULL) AND NOT ({QBOX_OUT})) AS valid_records,
       COUNT(*) - COUNT(*) FILTER (WHERE NOT (DEC_LATITUDE IS NULL OR DEC_LONGITUDE IS NULL) AND NOT ({QBOX_OUT})) AS invalid_records
FROM crash"""))
def q_qc_geo_bounds(spark, sf):
    return Q.qc_geo_bounds_report(fx.crash(spark, sf), **LL)


@register("qc_county_distribution", O.with_(["roadway"], """
SELECT CAST(COUNTY AS VARCHAR) AS county, COUNT(*) AS n FROM roadway WHERE COUNTY IS NOT NULL GROUP BY 1"""))
def q_qc_county_distribution(spark, sf):
    return Q.qc_county_distribution(fx.roadway(spark, sf))


@register("qc_county_miscoded", O.with_(["crash"], """
SELECT CRN, COUNTY, coalesce((SELECT COUNT(DISTINCT CAST(COUNTY AS VARCHAR)) = 1
                                     AND coalesce(TRY_CAST(MIN(CAST(COUNTY AS VARCHAR)) AS DOUBLE) = 67, false) FROM crash), false)
       AS county_miscoded FROM crash"""))
def q_qc_county_miscoded(spark, sf):
    return Q.qc_county_miscoded(fx.crash(spark, sf)).select("CRN", "COUNTY", "county_miscoded")


@register("qc_county_miscoded_mixed", O.with_(["roadway"], """
SELECT CRN, COUNTY, coalesce((SELECT COUNT(DISTINCT CAST(COUNTY AS VARCHAR)) = 1
                                     AND coalesce(TRY_CAST(MIN(CAST(COUNTY AS VARCHAR)) AS DOUBLE) = 67, false) FROM roadway), false)
       AS county_miscoded FROM roadway"""))
def q_qc_county_miscoded_mixed(spark, sf):
    return Q.qc_county_miscoded(fx.roadway(spark, sf)).select("CRN", "COUNTY", "county_miscoded")


DP = ("CASE WHEN {c} IS NULL THEN NULL WHEN contains(CAST({c} AS VARCHAR), '.') "
      "THEN length(split_part(CAST({c} AS VARCHAR), '.', -1)) ELSE 0 END")


@register("qc_precision", O.with_(["crash", "geo_in", "geo_rounded", "geo_flagged", "geo"], f"""
SELECT CAST(MIN({DP.format(c='DEC_LATITUDE')}) AS INTEGER) AS lat_min_decimals, CAST(MAX({DP.format(c='DEC_LATITUDE')}) AS INTEGER) AS lat_max_decimals,
       CAST(MIN({DP.format(c='DEC_LONGITUDE')}) AS INTEGER) AS lon_min_decimals, CAST(MAX({DP.format(c='DEC_LONGITUDE')}) AS INTEGER) AS lon_max_decimals
FROM geo"""))
def q_qc_precision(spark, sf):
    return Q.qc_precision(stages.crash_geographic(spark, sf), **LL)


@register("qc_round_coords", O.with_(["crash"], """
SELECT CRN, round(DEC_LATITUDE, 6) AS DEC_LATITUDE_standardized, round(DEC_LONGITUDE, 6) AS DEC_LONGITUDE_standardized FROM crash"""))
def q_qc_round(spark, sf):
    return Q.qc_round_coords(fx.crash(spark, sf), **LL).select("CRN", "DEC_LATITUDE_standardized", "DEC_LONGITUDE_standardized")


@register("qc_parse_dates", O.with_(["crash"], """
SELECT CRN, TRY_CAST(CRASH_DATE_TEXT AS DATE) AS CRASH_DATE_TEXT_parsed,
       CAST(year(TRY_CAST(CRASH_DATE_TEXT AS DATE)) AS INTEGER) AS CRASH_YEAR_from_date,
       coalesce(CRASH_YEAR <> year(TRY_CAST(CRASH_DATE_TEXT AS DATE)), true) AS CRASH_YEAR_mismatch
FROM crash"""))
def q_qc_parse_dates(spark, sf):
    return Q.qc_parse_dates(fx.crash(spark, sf), "CRASH_DATE_TEXT").select(
        "CRN", "CRASH_DATE_TEXT_parsed", "CRASH_YEAR_from_date", "CRASH_YEAR_mismatch")


@register("qc_year_mismatch", O.with_(["crash"], """
SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE TRY_CAST(CRASH_DATE_TEXT AS DATE) IS NULL) AS parse_failures,
       COUNT(*) FILTER (WHERE coalesce(CRASH_YEAR <> year(TRY_CAST(CRASH_DATE_TEXT AS DATE)), true)) AS year_mismatches
FROM crash"""))
def q_qc_year_mismatch(spark, sf):
    return Q.qc_date_report(fx.crash(spark, sf), "CRASH_DATE_TEXT")


@register("qc_helmet_values", O.with_(["cycle"], "SELECT PC_HLMT_IND AS value, COUNT(*) AS n FROM cycle GROUP BY 1"))
def q_qc_helmet_values(spark, sf):
    return Q.qc_helmet_values(fx.cycle(spark, sf))


@register("qc_helmet_invalid", O.with_(["cycle"], """
SELECT CAST(coalesce(SUM(n), 0) AS BIGINT) AS invalid_count, COUNT(*) AS unexpected_values
FROM (SELECT PC_HLMT_IND, COUNT(*) AS n FROM cycle WHERE PC_HLMT_IND IS NOT NULL AND PC_HLMT_IND NOT IN ('Y', 'N', 'U', '')
      GROUP BY 1)"""))
def q_qc_helmet_invalid(spark, sf):
    return Q.qc_helmet_invalid(fx.cycle(spark, sf))


@register("qc_helmet_unexpected", O.with_(["cycle"], """
SELECT PC_HLMT_IND AS value, COUNT(*) AS n FROM cycle WHERE PC_HLMT_IND IS NOT NULL AND PC_HLMT_IND NOT IN ('Y', 'N', 'U', '')
GROUP BY 1"""))
def q_qc_helmet_unexpected(spark, sf):
    return Q.qc_helmet_unexpected(fx.cycle(spark, sf))


@register("qc_helmet_blank", O.with_(["cycle"], "SELECT CRN, coalesce(nullif(PC_HLMT_IND, ''), 'U') AS PC_HLMT_IND FROM cycle"))
def q_qc_helmet_blank(spark, sf):
    return Q.qc_helmet_blank(fx.cycle(spark, sf)).select("CRN", "PC_HLMT_IND")


QARGS = dict(lat="DEC_LATITUDE", lon="DEC_LONGITUDE", date_col="CRASH_DATE_TEXT")


@register("qc_run_all", O.with_(["crash"], f"""
SELECT CRN, NOT (DEC_LATITUDE IS NULL OR DEC_LONGITUDE IS NULL) AND NOT ({QBOX_OUT}) AS geo_valid,
       coalesce((SELECT COUNT(DISTINCT CAST(COUNTY AS VARCHAR)) = 1
                        AND coalesce(TRY_CAST(MIN(CAST(COUNTY AS VARCHAR)) AS DOUBLE) = 67, false) FROM crash), false) AS county_miscoded,
       round(DEC_LATITUDE, 6) AS DEC_LATITUDE_standardized, round(DEC_LONGITUDE, 6) AS DEC_LONGITUDE_standardized,
       TRY_CAST(CRASH_DATE_TEXT AS DATE) AS CRASH_DATE_TEXT_parsed,
       coalesce(CRASH_YEAR <> year(TRY_CAST(CRASH_DATE_TEXT AS DATE)), true) AS CRASH_YEAR_mismatch
FROM crash"""))
def q_qc_run_all(spark, sf):
    out = Q.qc_run_all(fx.crash(spark, sf), "CRASH", **QARGS)
    return out.select("CRN", "geo_valid", "county_miscoded", "DEC_LATITUDE_standardized", "DEC_LONGITUDE_standardized",
                      "CRASH_DATE_TEXT_parsed", "CRASH_YEAR_mismatch")


O.cte("qc_checks", f"""
SELECT * FROM (
  SELECT 'geographic_bounds' AS "check", 'missing_coordinates' AS issue,
         COUNT(*) FILTER (WHERE DEC_LATITUDE IS NULL OR DEC_LONGITUDE IS NULL) AS count, COUNT(*) AS _total FROM crash
  UNION ALL SELECT 'geographic_bounds', 'out_of_bounds', COUNT(*) FILTER (WHERE {QBOX_OUT}), COUNT(*) FROM crash
  UNION ALL SELECT 'county_coding', 'york_county_miscoding',
         CASE WHEN COUNT(DISTINCT CAST(COUNTY AS VARCHAR)) = 1 AND coalesce(TRY_CAST(MIN(CAST(COUNTY AS VARCHAR)) AS DOUBLE) = 67, false)
              THEN COUNT(COUNTY) ELSE 0 END, COUNT(*) FROM crash
  UNION ALL SELECT 'date_consistency', 'parse_failure', COUNT(*) FILTER (WHERE TRY_CAST(CRASH_DATE_TEXT AS DATE) IS NULL), COUNT(*) FROM crash
  UNION ALL SELECT 'date_consistency', 'year_mismatch',
         COUNT(*) FILTER (WHERE coalesce(CRASH_YEAR <> year(TRY_CAST(CRASH_DATE_TEXT AS DATE)), true)), COUNT(*) FROM crash
) WHERE count > 0
""")


@register("qc_checks", O.with_(["crash", "qc_checks"], """
SELECT "check", issue, count, round(CAST(count AS DOUBLE) * 100.0 / _total, 2) AS pct FROM qc_checks"""))
def q_qc_checks(spark, sf):
    return Q.qc_checks(fx.crash(spark, sf), "CRASH", **QARGS)


@register("qc_report", O.with_(["crash", "qc_checks"], """
SELECT CAST(5 AS BIGINT) AS total_checks, COUNT(DISTINCT "check") AS checks_with_issues, COUNT(*) AS total_issues FROM qc_checks"""))
def q_qc_report(spark, sf):
    c = fx.crash(spark, sf)
    performed = Q.performed_checks(c, "CRASH", lat="DEC_LATITUDE", lon="DEC_LONGITUDE", date_col="CRASH_DATE_TEXT")
    return Q.qc_report(Q.qc_checks(c, "CRASH", **QARGS), performed)

# --------------------------------------------------------------- validation

FULL = CW + ["roadway", "full_integrated"]
PCT = "round(CAST({n} AS DOUBLE) * 100.0 / {d}, 2)"


@register("val_date_methods", O.with_(FULL, "SELECT COUNT(*) AS total_records, " + ", ".join(
    f"COUNT(*) FILTER (WHERE date_approximation_method = '{m}') AS {m}, "
    + PCT.format(n=f"COUNT(*) FILTER (WHERE date_approximation_method = '{m}')", d="COUNT(*)") + f" AS {m}_pct"
    for m in ("exact_day", "weekday_reconstructed", "mid_month_fallback", "mid_month_only")) + " FROM full_integrated"))
def q_val_date_methods(spark, sf):
    return V.val_date_methods(stages.full(spark, sf))


TEMPORAL = f"""
SELECT CAST(MIN(year(crash_date)) AS INTEGER) AS first_year, CAST(MAX(year(crash_date)) AS INTEGER) AS last_year,
       COUNT(DISTINCT year(crash_date)) AS total_years,
       round(COUNT(crash_date) / COUNT(DISTINCT year(crash_date)), 1) AS crashes_per_year_avg,
       COUNT(*) AS total_records, COUNT(*) FILTER (WHERE dayofmonth(crash_date) = 1) AS day_1_crashes,
       {PCT.format(n="COUNT(*) FILTER (WHERE dayofmonth(crash_date) = 1)", d="COUNT(*)")} AS day_1_percentage,
       COUNT(DISTINCT dayofmonth(crash_date)) AS days_with_crashes
FROM full_integrated"""


@register("val_year_range", O.with_(FULL, TEMPORAL))
def q_val_year_range(spark, sf):
    return V.val_temporal(stages.full(spark, sf))


@register("val_crashes_per_year", O.with_(CW, TEMPORAL.replace("full_integrated", "crash_weather")))
def q_val_crashes_per_year(spark, sf):
    return V.val_temporal(stages.crash_weather(spark, sf))


@register("val_day_histogram", O.with_(FULL, """
SELECT CAST(dayofmonth(crash_date) AS INTEGER) AS day, COUNT(*) AS n FROM full_integrated WHERE crash_date IS NOT NULL GROUP BY 1"""))
def q_val_day_histogram(spark, sf):
    return V.val_day_histogram(stages.full(spark, sf))


@register("val_top_days", O.with_(FULL, """
SELECT CAST(dayofmonth(crash_date) AS INTEGER) AS day, COUNT(*) AS n FROM full_integrated WHERE crash_date IS NOT NULL
GROUP BY 1 ORDER BY day LIMIT 5"""))
def q_val_top_days(spark, sf):
    return V.val_top_days(stages.full(spark, sf))


@register("val_top_days_by_count", O.with_(FULL, """
SELECT CAST(dayofmonth(crash_date) AS INTEGER) AS day, COUNT(*) AS n FROM full_integrated WHERE crash_date IS NOT NULL
GROUP BY 1 ORDER BY n DESC, day LIMIT 5"""))
def q_val_top_days_by_count(spark, sf):
    return V.val_top_days(stages.full(spark, sf), parity=False)


@register("val_geo_coverage", O.with_(FULL, f"""
SELECT COUNT(*) FILTER (WHERE DEC_LATITUDE IS NOT NULL AND DEC_LONGITUDE IS NOT NULL) AS total_with_coords,
       {PCT.format(n="COUNT(*) FILTER (WHERE DEC_LATITUDE IS NOT NULL AND DEC_LONGITUDE IS NOT NULL)", d="COUNT(*)")} AS percent_with_coords,
       MIN(DEC_LATITUDE) FILTER (WHERE DEC_LONGITUDE IS NOT NULL) AS lat_min, MAX(DEC_LATITUDE) FILTER (WHERE DEC_LONGITUDE IS NOT NULL) AS lat_max,
       MIN(DEC_LONGITUDE) FILTER (WHERE DEC_LATITUDE IS NOT NULL) AS lon_min, MAX(DEC_LONGITUDE) FILTER (WHERE DEC_LATITUDE IS NOT NULL) AS lon_max
FROM full_integrated"""))
def q_val_geo_coverage(spark, sf):
    return V.val_geo_coverage(stages.full(spark, sf))


@register("val_weather_coverage", O.with_(FULL, f"""
SELECT COUNT(temp_max_c) AS crashes_with_weather, {PCT.format(n="COUNT(temp_max_c)", d="COUNT(*)")} AS percent_with_weather,
       MIN(temp_max_c) AS temp_min, MAX(temp_max_c) AS temp_max,
       COUNT(*) FILTER (WHERE precipitation_mm > 0) AS crashes_with_precipitation,
       {PCT.format(n="COUNT(*) FILTER (WHERE precipitation_mm > 0)", d="COUNT(precipitation_mm)")} AS percent_with_precipitation
FROM full_integrated"""))
def q_val_weather_coverage(spark, sf):
    return V.val_weather_coverage(stages.full(spark, sf))


@register("val_completeness", O.with_(FULL, f"""
SELECT name AS "column", non_null, {PCT.format(n="non_null", d="(SELECT COUNT(*) FROM full_integrated)")} AS completeness_pct
FROM (UNPIVOT (SELECT COUNT(COLUMNS(*)) FROM full_integrated) ON COLUMNS(*) INTO NAME name VALUE non_null)"""))
def q_val_completeness(spark, sf):
    return V.val_completeness(stages.full(spark, sf))


@register("val_completeness_footers", ORACLE["val_completeness"])
def q_val_completeness_footers(spark, sf):
    """V8 of the written dataset: no data page is read."""
    from roadbook.sources import footers, sinks
    path = _scratch(spark, "full-integrated")
    sinks.write_parquet(stages.full(spark, sf), path, partition_by=["CRASH_YEAR"])
    return footers.completeness(spark, path)


O.cte("per_col", f"""
SELECT name, non_null, {PCT.format(n="non_null", d="(SELECT COUNT(*) FROM full_integrated)")} AS pct
FROM (UNPIVOT (SELECT COUNT(COLUMNS(*)) FROM full_integrated) ON COLUMNS(*) INTO NAME name VALUE non_null)
""")


@register("val_completeness_overall", O.with_(FULL + ["per_col"], f"""
SELECT (SELECT COUNT(*) FROM full_integrated) AS total_records, COUNT(*) AS total_fields,
       {PCT.format(n="SUM(non_null)", d="((SELECT COUNT(*) FROM full_integrated) * COUNT(*))")} AS overall_completeness_pct,
       COUNT(*) FILTER (WHERE pct = 100.0) AS fields_with_100pct_completeness,
       COUNT(*) FILTER (WHERE pct < 90.0) AS fields_below_90pct_completeness
FROM per_col"""))
def q_val_completeness_overall(spark, sf):
    return V.val_completeness_overall(stages.full(spark, sf))


def _report_sql() -> str:
    """V10 oracle: every section's one-row SQL, unpivoted to (section, metric, value text)."""
    methods = ("exact_day", "weekday_reconstructed", "mid_month_fallback", "mid_month_only")
    dm = "SELECT COUNT(*) AS total_records, " + ", ".join(
        f"COUNT(*) FILTER (WHERE date_approximation_method = '{m}') AS {m}, "
        + PCT.format(n=f"COUNT(*) FILTER (WHERE date_approximation_method = '{m}')", d="COUNT(*)") + f" AS {m}_pct"
        for m in methods) + " FROM full_integrated"
    sections = [
        ("date_approximation", dm, ["total_records"] + [x for m in methods for x in (m, f"{m}_pct")]),
        ("temporal_distribution", TEMPORAL, ["first_year", "last_year", "total_years", "crashes_per_year_avg",
                                             "total_records", "day_1_crashes", "day_1_percentage", "days_with_crashes"]),
        ("geographic_coverage", GEO_COVERAGE, ["total_with_coords", "percent_with_coords", "lat_min", "lat_max",
                                               "lon_min", "lon_max"]),
        ("weather_integration", WEATHER_COVERAGE, ["crashes_with_weather", "percent_with_weather", "temp_min", "temp_max",
                                                  "crashes_with_precipitation", "percent_with_precipitation"]),
        ("data_quality", COMPLETENESS_OVERALL, ["total_records", "total_fields", "overall_completeness_pct",
                                                "fields_with_100pct_completeness", "fields_below_90pct_completeness"]),
    ]
    parts = []
    for name, sql, metrics in sections:
        for mtr in metrics:
            parts.append(f"SELECT '{name}' AS section, '{mtr}' AS metric, CAST({mtr} AS VARCHAR) AS value FROM ({sql})")
    parts.append("""SELECT 'most_common_days', 'day_' || CAST(day AS VARCHAR), CAST(n AS VARCHAR) FROM (
        SELECT day(crash_date) AS day, COUNT(*) AS n FROM full_integrated WHERE crash_date IS NOT NULL GROUP BY 1 ORDER BY n DESC, day LIMIT 5)""")
    parts.append("""SELECT 'fields', column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END
        FROM (DESCRIBE full_integrated)""")
    parts.append("SELECT 'metadata', 'coordinate_system', 'EPSG:4326'")
    return O.with_(FULL + ["per_col"], "\nUNION ALL\n".join(parts))


GEO_COVERAGE = f"""
SELECT COUNT(*) FILTER (WHERE DEC_LATITUDE IS NOT NULL AND DEC_LONGITUDE IS NOT NULL) AS total_with_coords,
       {PCT.format(n="COUNT(*) FILTER (WHERE DEC_LATITUDE IS NOT NULL AND DEC_LONGITUDE IS NOT NULL)", d="COUNT(*)")} AS percent_with_coords,
       MIN(DEC_LATITUDE) FILTER (WHERE DEC_LONGITUDE IS NOT NULL) AS lat_min, MAX(DEC_LATITUDE) FILTER (WHERE DEC_LONGITUDE IS NOT NULL) AS lat_max,
       MIN(DEC_LONGITUDE) FILTER (WHERE DEC_LATITUDE IS NOT NULL) AS lon_min, MAX(DEC_LONGITUDE) FILTER (WHERE DEC_LATITUDE IS NOT NULL) AS lon_max
FROM full_integrated"""

WEATHER_COVERAGE = f"""
SELECT COUNT(temp_max_c) AS crashes_with_weather, {PCT.format(n="COUNT(temp_max_c)", d="COUNT(*)")} AS percent_with_weather,
       MIN(temp_max_c) AS temp_min, MAX(temp_max_c) AS temp_max,
       COUNT(*) FILTER (WHERE precipitation_mm > 0) AS crashes_with_precipitation,
       {PCT.format(n="COUNT(*) FILTER (WHERE precipitation_mm > 0)", d="COUNT(precipitation_mm)")} AS percent_with_precipitation
FROM full_integrated"""

COMPLETENESS_OVERALL = f"""
SELECT (SELECT COUNT(*) FROM full_integrated) AS total_records, COUNT(*) AS total_fields,
       {PCT.format(n="SUM(non_null)", d="((SELECT COUNT(*) FROM full_integrated) * COUNT(*))")} AS overall_completeness_pct,
       COUNT(*) FILTER (WHERE pct = 100.0) AS fields_with_100pct_completeness,
       COUNT(*) FILTER (WHERE pct < 90.0) AS fields_below_90pct_completeness
FROM per_col"""


@register("val_report", _report_sql())
def q_val_report(spark, sf):
    return V.val_report(stages.full(spark, sf), metadata={"coordinate_system": "EPSG:4326"})

# ------------------------------------------------------ sinks (round trips)


def _scratch(spark, name):
    import os
    import uuid

    from roadbook.session import checkpoint_dir
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


@register("sink_parquet", O.with_(["wx_daily", "wx_raw", "weather"], "SELECT * FROM weather"))
def q_sink_parquet(spark, sf):
    from roadbook.sources import sinks
    path = _scratch(spark, "sink-parquet")
    sinks.write_parquet(stages.weather_table(spark, sf), path)
    return sinks.read_parquet(spark, path)


@register("sink_csv", O.with_(["wx_daily", "wx_raw", "weather"], """
SELECT strftime(date, '%Y-%m-%d') AS date, CAST(temp_max_c AS VARCHAR) AS temp_max_c, CAST(temp_min_c AS VARCHAR) AS temp_min_c,
       CAST(temp_avg_c AS VARCHAR) AS temp_avg_c, CAST(precipitation_mm AS VARCHAR) AS precipitation_mm,
       CAST(wind_speed_avg_ms AS VARCHAR) AS wind_speed_avg_ms, CAST(wind_speed_max_ms AS VARCHAR) AS wind_speed_max_ms,
       CAST(snowfall_mm AS VARCHAR) AS snowfall_mm, CAST(snow_depth_mm AS VARCHAR) AS snow_depth_mm
FROM weather"""))
def q_sink_csv(spark, sf):
    from roadbook.sources import sinks
    path = _scratch(spark, "sink-csv")
    sinks.write_csv(stages.weather_table(spark, sf), path)
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
         "labels", "conversations"]


@register("dataset_catalog_footers", " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, COUNT(*) AS records, (SELECT COUNT(*) FROM (DESCRIBE {t}))::INTEGER AS fields, true AS has_size FROM {t}" for t in GIVEN))
def q_dataset_catalog_footers(spark, sf):
    """K5 of the given tables from their footers."""
    from roadbook.sources import footers
    tables = footers.catalog(spark, {t: f"{sf.rstrip('/')}/{t}.parquet" for t in GIVEN})
    return tables.select("dataset", "records", F.col("fields").cast("int").alias("fields"), (F.col("size_bytes") > 0).alias("has_size"))


@register("dataset_run_summary", O.with_(CW + ["person", "vehicle", "cycle", "roadway", "vsum1", "vsum2", "j_cycle",
                                                "j_cyc_person", "cyclist", "j_ped_person", "pedestrian", "full_integrated"], """
SELECT 'cyclist_focused' AS dataset, 'success' AS status, COUNT(*) AS rows, (SELECT COUNT(*) FROM (DESCRIBE cyclist))::INTEGER AS columns FROM cyclist
UNION ALL SELECT 'pedestrian_focused', 'success', COUNT(*), (SELECT COUNT(*) FROM (DESCRIBE pedestrian))::INTEGER FROM pedestrian
UNION ALL SELECT 'full_integrated', 'success', COUNT(*), (SELECT COUNT(*) FROM (DESCRIBE full_integrated))::INTEGER FROM full_integrated
UNION ALL SELECT 'person', 'success', COUNT(*), (SELECT COUNT(*) FROM (DESCRIBE person))::INTEGER FROM person
UNION ALL SELECT 'vehicle', 'success', COUNT(*), (SELECT COUNT(*) FROM (DESCRIBE vehicle))::INTEGER FROM vehicle"""))
def q_dataset_run_summary(spark, sf):
    person, vehicle = fx.person(spark, sf), fx.vehicle(spark, sf)
    cw = materialize(stages.crash_weather(spark, sf), "crash_weather")      # three datasets read it
    return D.dataset_run_summary({
        "cyclist_focused": D.cyclist_dataset(cw, fx.cycle(spark, sf), person, vehicle),
        "pedestrian_focused": D.pedestrian_dataset(cw, person, vehicle),
        "full_integrated": D.full_integrated(cw, fx.roadway(spark, sf)),
        "person": person, "vehicle": vehicle})


@register("sink_json_report", O.with_(["crash", "geo_in", "geo_rounded", "geo_flagged"], f"""
SELECT COUNT(*) AS total_records,
       COUNT(*) FILTER (WHERE DEC_LATITUDE IS NOT NULL AND DEC_LONGITUDE IS NOT NULL) AS records_with_coords,
       COUNT(*) FILTER (WHERE _flag_inv) AS invalid_coords,
       COUNT(*) FILTER (WHERE COORD_QUALITY_FLAG = 'OUTSIDE_PHILLY') AS outside_bounds,
       COUNT(*) FILTER (WHERE COUNTY_QUALITY_FLAG IS NOT NULL) AS county_mismatches,
       COUNT(*) FILTER (WHERE coalesce({O.BOX}, false) OR DEC_LATITUDE IS NULL) AS final_records
FROM (SELECT *, DEC_LATITUDE IS NULL OR DEC_LONGITUDE IS NULL OR COORD_QUALITY_FLAG = 'INVALID'
             OR (COORD_QUALITY_FLAG = 'OUTSIDE_PHILLY' AND coalesce(DEC_LATITUDE = 0 AND DEC_LONGITUDE = 0, false)) AS _flag_inv
      FROM geo_flagged)"""))
def q_sink_json_report(spark, sf):
    from roadbook.operators.geo import geo_stats
    from roadbook.sources import sinks
    rep = geo_stats(fx.crash(spark, sf))
    path = _scratch(spark, "sink-json")
    sinks.write_json_report(rep, path)
    return spark.read.schema(rep.schema).json(path)


@register("scan_observations_json", O.with_(["wx_daily", "wx_long"], """
SELECT date, datatype, 'STATION' AS station, value FROM wx_long"""))
def q_scan_observations_json(spark, sf):
    from roadbook.sources import observations as OB
    path = _scratch(spark, "obs-pages")
    OB.write_observation_pages(fx.weather_long(spark, sf), path)
    return OB.read_observation_pages(spark, path, multi_line=False).select("date", "datatype", "station", "value")


#: Rows per page, and which pages are torn or left out when they are landed, by request and page number.
PAGE, TORN, LOST = 100, (11, 3), (13, 5)
O.cte("obs_pages", f"""
SELECT request, CAST(offset_ AS BIGINT) AS "offset", COUNT(*) AS n, any_value(total) AS total,
       (request + offset_ // {PAGE}) % {TORN[0]} = {TORN[1]} AS torn, (request + offset_ // {PAGE}) % {LOST[0]} = {LOST[1]} AS lost
FROM (SELECT *, (row_number() OVER (PARTITION BY request ORDER BY date, datatype) - 1) // {PAGE} * {PAGE} + 1 AS offset_,
        COUNT(*) OVER (PARTITION BY request) AS total
      FROM (SELECT CAST(year(date) AS INTEGER) AS request, date, datatype FROM wx_long))
GROUP BY request, offset_
""")
OBS_PAGES = ["wx_daily", "wx_long", "obs_pages"]


def _damaged_pages(spark, sf):
    """Observation pages by request, landed with torn and lost ones among them."""
    from roadbook.sources import observations as OB
    path = _scratch(spark, "obs-requests")
    pages = OB.request_pages(fx.weather_long(spark, sf), PAGE)

    def hit(rule):
        return (F.col("request") + F.expr(f"offset div {PAGE}")) % rule[0] == rule[1]

    torn = F.when(hit(TORN), F.expr("left(value, length(value) - 10)")).otherwise(F.col("value"))
    pages.filter(~hit(LOST)).select("request", torn.alias("value")).write.partitionBy("request").text(path)
    return OB.observation_pages(spark, path, multi_line=False, request=F.col("request"))


@register("observation_page_report", O.with_(OBS_PAGES, """
SELECT request, MAX(total) AS total, CAST(SUM(CASE WHEN torn OR lost THEN 0 ELSE n END) AS BIGINT) AS rows,
  COUNT(*) FILTER (WHERE NOT torn AND NOT lost) AS pages, CAST(0 AS BIGINT) AS short, COUNT(*) FILTER (WHERE torn AND NOT lost) AS torn,
  COUNT(*) FILTER (WHERE torn OR lost) AS missing, CAST(0 AS BIGINT) AS repeated, NOT bool_or(torn OR lost) AS complete
FROM obs_pages GROUP BY request"""))
def q_observation_page_report(spark, sf):
    """Rows and pages of each request against what its metadata promise."""
    from roadbook.sources import observations as OB
    return OB.page_report(_damaged_pages(spark, sf))


@register("observation_missing_pages", O.with_(OBS_PAGES, """
SELECT request, "offset", n AS due FROM obs_pages WHERE torn OR lost"""))
def q_observation_missing_pages(spark, sf):
    """Offsets to fetch again."""
    from roadbook.sources import observations as OB
    return OB.missing_pages(_damaged_pages(spark, sf))


@register("observation_torn_pages", O.with_(OBS_PAGES, """
SELECT request, 'not JSON' AS fault, COUNT(*) AS pages FROM obs_pages WHERE torn AND NOT lost GROUP BY request"""))
def q_observation_torn_pages(spark, sf):
    """The quarantine, by request and reason."""
    from roadbook.sources import observations as OB
    return OB.torn_pages(_damaged_pages(spark, sf)).groupBy("request", "fault").agg(F.count("*").alias("pages"))


@register("dataset_catalog", O.with_(CW + ["person"], """
SELECT 'crash_weather' AS dataset, COUNT(*) AS records, (SELECT COUNT(*) FROM (DESCRIBE crash_weather))::INTEGER AS fields, true AS has_size
FROM crash_weather
UNION ALL SELECT 'weather_daily', COUNT(*), (SELECT COUNT(*) FROM (DESCRIBE weather))::INTEGER, true FROM weather
UNION ALL SELECT 'person', COUNT(*), (SELECT COUNT(*) FROM (DESCRIBE person))::INTEGER, true FROM person"""))
def q_dataset_catalog(spark, sf):
    """K5 over written stage outputs; the byte sizes depend on the encoder, so only their presence is compared."""
    from roadbook.sources import sinks
    outputs = {"crash_weather": stages.crash_weather(spark, sf), "weather_daily": stages.weather_table(spark, sf),
               "person": fx.person(spark, sf)}
    paths = {}
    for name, df in outputs.items():
        paths[name] = _scratch(spark, f"catalog-{name}")
        sinks.write_parquet(df, paths[name], partition_by=["CRASH_YEAR"] if "CRASH_YEAR" in df.columns else None)
    return sinks.dataset_catalog(spark, paths).select("dataset", "records", F.col("fields").cast("int").alias("fields"),
                                                      (F.col("size_bytes") > 0).alias("has_size"))


O.cte("full_per_crash", "SELECT DISTINCT CRN, date_approximation_method, crash_date FROM full_integrated")


@register("val_date_methods_per_crash", O.with_(FULL + ["full_per_crash"], "SELECT COUNT(*) AS total_records, " + ", ".join(
    f"COUNT(*) FILTER (WHERE date_approximation_method = '{m}') AS {m}, "
    + PCT.format(n=f"COUNT(*) FILTER (WHERE date_approximation_method = '{m}')", d="COUNT(*)") + f" AS {m}_pct"
    for m in ("exact_day", "weekday_reconstructed", "mid_month_fallback", "mid_month_only")) + " FROM full_per_crash"))
def q_val_date_methods_per_crash(spark, sf):
    return V.val_date_methods(stages.full(spark, sf), per="crash")


@register("val_year_range_per_crash", O.with_(FULL + ["full_per_crash"], TEMPORAL.replace("FROM full_integrated", "FROM full_per_crash")))
def q_val_year_range_per_crash(spark, sf):
    return V.val_temporal(stages.full(spark, sf), per="crash")


@register("val_day_histogram_per_crash", O.with_(FULL + ["full_per_crash"], """
SELECT CAST(dayofmonth(crash_date) AS INTEGER) AS day, COUNT(*) AS n FROM full_per_crash WHERE crash_date IS NOT NULL GROUP BY 1"""))
def q_val_day_histogram_per_crash(spark, sf):
    return V.val_day_histogram(stages.full(spark, sf), per="crash")


@register("val_top_days_per_crash", O.with_(FULL + ["full_per_crash"], """
SELECT CAST(dayofmonth(crash_date) AS INTEGER) AS day, COUNT(*) AS n FROM full_per_crash WHERE crash_date IS NOT NULL
GROUP BY 1 ORDER BY n DESC, day LIMIT 5"""))
def q_val_top_days_per_crash(spark, sf):
    return V.val_top_days(stages.full(spark, sf), per="crash", parity=False)
