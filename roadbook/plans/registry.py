"""

Every query reads the driver's tables (through the fixture projections) in
full; none uses id subsets or caps. ``scan_sample`` samples: that is what S2 asks for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadbook.operators import areas as A
from roadbook.operators import dates as T
from roadbook.operators import geo as G
from roadbook.operators import weather as W
from roadbook.plans import fixtures as fx
from roadbook.plans import oracle as O
from roadbook.plans import stages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


W_NAMES = ["temp_max_c", "temp_min_c", "temp_avg_c", "precipitation_mm", "wind_speed_avg_ms",
           "wind_speed_max_ms", "snowfall_mm", "snow_depth_mm"]

# ---------------------------------------------------------------- T: dates

DATE_COLS = "CRN, crash_date, date_approximation_method, CRASH_DAY"


def _crash_with_day(spark, sf):
    """CRASH plus a CRASH_DAY that is present on most rows but not all."""
    return fx.crash(spark, sf, with_day=True)


O.cte("crash_day", """
SELECT c.*, CASE WHEN o.o_orderkey % 7 <> 0 THEN CAST(dayofmonth(o.o_orderdate) AS INTEGER) END AS CRASH_DAY
FROM crash c JOIN orders o ON c.CRN = CAST(o.o_orderkey AS VARCHAR)
""")


@register("date_exact", O.with_(["crash", "crash_day"], """
SELECT CRN, CASE WHEN CRASH_DAY IS NOT NULL THEN make_date(CRASH_YEAR, CRASH_MONTH, CRASH_DAY) END AS crash_date,
       'exact_day' AS date_approximation_method, CRASH_DAY FROM crash_day"""))
def q_date_exact(spark, sf):
    return T.reconstruct_dates(_crash_with_day(spark, sf)).select(*DATE_COLS.split(", "))


O.cte("crash_dated_all", f"""
SELECT * EXCLUDE (_wk),
       coalesce(_wk, make_date(CRASH_YEAR, CRASH_MONTH, 15)) AS crash_date,
       CASE WHEN _wk IS NULL THEN 15 END AS CRASH_DAY,
       CASE WHEN _wk IS NOT NULL THEN 'weekday_reconstructed' ELSE 'mid_month_fallback' END AS date_approximation_method
FROM (SELECT *, {O.WEEKDAY.format(dow='DAY_OF_WEEK', y='CRASH_YEAR', m='CRASH_MONTH')} AS _wk FROM crash)
""")


@register("date_weekday", O.with_(["crash", "crash_dated_all"], f"""
SELECT {DATE_COLS} FROM crash_dated_all WHERE date_approximation_method = 'weekday_reconstructed'"""))
def q_date_weekday(spark, sf):
    d = T.reconstruct_dates(fx.crash(spark, sf))
    return d.filter(F.col("date_approximation_method") == "weekday_reconstructed").select(*DATE_COLS.split(", "))


@register("date_mid_month_fallback", O.with_(["crash", "crash_dated_all"], f"""
SELECT {DATE_COLS} FROM crash_dated_all WHERE date_approximation_method = 'mid_month_fallback'"""))
def q_date_fallback(spark, sf):
    d = T.reconstruct_dates(fx.crash(spark, sf))
    return d.filter(F.col("date_approximation_method") == "mid_month_fallback").select(*DATE_COLS.split(", "))


@register("date_mid_month_only", O.with_(["crash"], """
SELECT CRN, make_date(CRASH_YEAR, CRASH_MONTH, 15) AS crash_date, 'mid_month_only' AS date_approximation_method,
       15 AS CRASH_DAY FROM crash"""))
def q_date_mid_only(spark, sf):
    return T.reconstruct_dates(fx.crash(spark, sf).drop("DAY_OF_WEEK")).select(*DATE_COLS.split(", "))


@register("date_method_tag", O.with_(["crash", "crash_dated_all"], """
SELECT date_approximation_method, COUNT(*) AS n FROM crash_dated_all GROUP BY 1"""))
def q_date_method_tag(spark, sf):
    return T.method_counts(T.reconstruct_dates(fx.crash(spark, sf)))


@register("date_stats", O.with_(["crash", "crash_dated_all"], """
SELECT COUNT(*) AS total_crashes, COUNT(crash_date) AS crashes_with_dates,
       COUNT(*) FILTER (WHERE date_approximation_method = 'exact_day') AS exact_day,
       COUNT(*) FILTER (WHERE date_approximation_method = 'weekday_reconstructed') AS weekday_reconstructed,
       COUNT(*) FILTER (WHERE date_approximation_method = 'mid_month_fallback') AS mid_month_fallback,
       COUNT(*) FILTER (WHERE date_approximation_method = 'mid_month_only') AS mid_month_only,
       MIN(crash_date) AS min_date, MAX(crash_date) AS max_date
FROM crash_dated_all"""))
def q_date_stats(spark, sf):
    return T.date_stats(T.reconstruct_dates(fx.crash(spark, sf)))


@register("date_rowwise", O.with_(["crash", "crash_day"], f"""
SELECT CRN, coalesce(_ex, _wk, make_date(CRASH_YEAR, CRASH_MONTH, 15)) AS crash_date,
       CASE WHEN _ex IS NOT NULL THEN 'exact_day' WHEN _wk IS NOT NULL THEN 'weekday_reconstructed'
            ELSE 'mid_month_fallback' END AS date_approximation_method,
       CASE WHEN _ex IS NULL AND _wk IS NULL THEN 15 ELSE CRASH_DAY END AS CRASH_DAY
FROM (SELECT *, CASE WHEN CRASH_DAY IS NOT NULL THEN make_date(CRASH_YEAR, CRASH_MONTH, CRASH_DAY) END AS _ex,
             {O.WEEKDAY.format(dow='DAY_OF_WEEK', y='CRASH_YEAR', m='CRASH_MONTH')} AS _wk FROM crash_day)"""))
def q_date_rowwise(spark, sf):
    return T.reconstruct_dates(_crash_with_day(spark, sf), mode="row").select(*DATE_COLS.split(", "))


@register("weekday_balance", O.with_(["crash", "crash_dated_all"], """
SELECT CAST(dayofweek(crash_date) + 1 AS INTEGER) AS weekday, COUNT(*) AS n,
       COUNT(*) FILTER (WHERE dayofmonth(crash_date) > 7) AS day_after_7,
       COUNT(*) FILTER (WHERE crash_date IS NULL) AS missing_date
FROM crash_dated_all WHERE date_approximation_method = 'weekday_reconstructed' GROUP BY 1"""))
def q_weekday_balance(spark, sf):
    return T.weekday_balance(T.reconstruct_dates(fx.crash(spark, sf)))

# -------------------------------------------------------------- W: weather


@register("weather_pivot", O.with_(["wx_daily", "wx_raw"], """
SELECT date, TMAX, TMIN, TAVG, PRCP, AWND, WSF2, SNOW, SNWD FROM wx_raw"""))
def q_weather_pivot(spark, sf):
    return W.pivot_long(fx.weather_long(spark, sf), order_col="obs_id")


@register("pivot_first", """
SELECT CAST(ts AS DATE) AS date,
       arg_min(value, event_id) FILTER (WHERE event_type = 'click') AS click,
       arg_min(value, event_id) FILTER (WHERE event_type = 'error') AS error,
       arg_min(value, event_id) FILTER (WHERE event_type = 'purchase') AS purchase,
       arg_min(value, event_id) FILTER (WHERE event_type = 'signup') AS signup,
       arg_min(value, event_id) FILTER (WHERE event_type = 'view') AS "view"
FROM events WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY 1""")
def q_pivot_first(spark, sf):
    return W.pivot_long(fx.events_long(spark, sf), type_col="event_type", order_col="event_id",
                        types=["click", "error", "purchase", "signup", "view"])


@register("weather_scale", O.with_(["wx_daily", "wx_raw", "weather"], "SELECT * FROM weather"))
def q_weather_scale(spark, sf):
    return stages.weather_table(spark, sf)


@register("rename_weather", O.with_(["wx_daily", "wx_raw"], """
SELECT date, TMAX AS temp_max_c, TMIN AS temp_min_c, TAVG AS temp_avg_c, PRCP AS precipitation_mm FROM wx_raw"""))
def q_rename_weather(spark, sf):
    """F2 alone: the pivoted observations renamed, not scaled."""
    wide = W.pivot_long(fx.weather_long(spark, sf), order_col="obs_id")
    return W.rename_weather(wide).select("date", "temp_max_c", "temp_min_c", "temp_avg_c", "precipitation_mm")


@register("weather_sort", O.with_(["wx_daily", "wx_raw", "weather"], "SELECT date, temp_max_c, row_number() OVER (ORDER BY date) AS place FROM weather"))
def q_weather_sort(spark, sf):
    """Days in date order, each with its place: the rows before it in its partition and in the partitions before."""
    days = stages.weather_table(spark, sf).select("date", "temp_max_c").orderBy("date").withColumn("at", F.monotonically_increasing_id())
    part, row = F.shiftrightunsigned("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = days.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)       # one row per partition
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = days.withColumn("part", part).join(sizes, "part")
    return placed.select("date", "temp_max_c", (F.col("before") + row + 1).alias("place"))


@register("weather_join", O.with_(O.CRASH_WEATHER[:-1], """
SELECT d.*, w.* EXCLUDE (date) FROM dated d LEFT JOIN weather w ON w.date = d.crash_date"""))
def q_weather_join(spark, sf):
    dated = T.reconstruct_dates(stages.crash_geographic(spark, sf))
    return W.join_weather(dated, stages.weather_table(spark, sf))


@register("drop_temp_columns", O.with_(O.CRASH_WEATHER[:-1], """
SELECT d.*, w.* EXCLUDE (date) FROM dated d LEFT JOIN weather w ON w.date = d.crash_date"""))
def q_drop_temp_columns(spark, sf):
    """the joined rows; no join key of the weather side is left among their columns."""
    return W.join_weather(T.reconstruct_dates(stages.crash_geographic(spark, sf)), stages.weather_table(spark, sf))


@register("weather_match_stats", O.with_(O.CRASH_WEATHER[:-1], """
SELECT COUNT(*) AS total_crashes, COUNT(w.date) AS weather_row_matched,
       COUNT(w.temp_avg_c) AS crashes_matched, COUNT(*) - COUNT(w.temp_avg_c) AS crashes_unmatched
FROM dated d LEFT JOIN weather w ON w.date = d.crash_date"""))
def q_weather_match_stats(spark, sf):
    dated = T.reconstruct_dates(stages.crash_geographic(spark, sf))
    return W.match_stats(dated, stages.weather_table(spark, sf))


def _features(spark, sf, cols):
    return stages.crash_weather(spark, sf).select("CRN", *cols)


@register("precip_category", O.with_(O.CRASH_WEATHER, "SELECT CRN, precipitation_mm, precip_category FROM crash_weather"))
def q_precip_category(spark, sf):
    return _features(spark, sf, ["precipitation_mm", "precip_category"])


@register("temp_category", O.with_(O.CRASH_WEATHER, "SELECT CRN, temp_avg_c, temp_category FROM crash_weather"))
def q_temp_category(spark, sf):
    return _features(spark, sf, ["temp_avg_c", "temp_category"])


@register("adverse_weather", O.with_(O.CRASH_WEATHER, """
SELECT CRN, precipitation_mm, wind_speed_max_ms, snowfall_mm, adverse_weather FROM crash_weather"""))
def q_adverse_weather(spark, sf):
    return _features(spark, sf, ["precipitation_mm", "wind_speed_max_ms", "snowfall_mm", "adverse_weather"])


@register("extreme_temp", O.with_(O.CRASH_WEATHER, "SELECT CRN, temp_avg_c, extreme_temp FROM crash_weather"))
def q_extreme_temp(spark, sf):
    return _features(spark, sf, ["temp_avg_c", "extreme_temp"])


@register("weather_pipeline", O.with_(O.CRASH_WEATHER, "SELECT * FROM crash_weather"))
def q_weather_pipeline(spark, sf):
    return stages.crash_weather(spark, sf)


@register("weather_feature_counts", O.with_(O.CRASH_WEATHER, """
SELECT precip_category, temp_category, COUNT(*) AS crashes, CAST(SUM(adverse_weather) AS BIGINT) AS adverse,
       CAST(SUM(extreme_temp) AS BIGINT) AS extreme FROM crash_weather GROUP BY 1, 2"""))
def q_weather_feature_counts(spark, sf):
    return flagship(stages.crash_weather(spark, sf))


def flagship(cw: DataFrame) -> DataFrame:
    """Crash counts by precipitation and temperature category."""
    return cw.groupBy("precip_category", "temp_category").agg(
        F.count(F.lit(1)).alias("crashes"),
        F.sum("adverse_weather").cast("bigint").alias("adverse"),
        F.sum("extreme_temp").cast("bigint").alias("extreme"))

# -------------------------------------------------------------- G: geography


O.cte("crash_text", """
SELECT CRN, CASE WHEN CAST(CRN AS BIGINT) % 89 = 0 THEN 'n/a' WHEN CAST(CRN AS BIGINT) % 97 = 0 THEN 'NaN'
                 ELSE CAST(DEC_LATITUDE AS VARCHAR) END AS DEC_LATITUDE,
       CASE WHEN CAST(CRN AS BIGINT) % 83 = 0 THEN '' ELSE CAST(DEC_LONGITUDE AS VARCHAR) END AS DEC_LONGITUDE
FROM crash
""")


def _crash_text(spark, sf):
    c = fx.crash(spark, sf)
    k = F.col("CRN").cast("bigint")
    return c.select("CRN",
                    F.when(k % 89 == 0, F.lit("n/a")).when(k % 97 == 0, F.lit("NaN"))
                    .otherwise(F.col("DEC_LATITUDE").cast("string")).alias("DEC_LATITUDE"),
                    F.when(k % 83 == 0, F.lit("")).otherwise(F.col("DEC_LONGITUDE").cast("string")).alias("DEC_LONGITUDE"))


@register("geo_coerce", O.with_(["crash", "crash_text"], """
SELECT CRN, CASE WHEN isnan(TRY_CAST(DEC_LATITUDE AS DOUBLE)) THEN NULL ELSE TRY_CAST(DEC_LATITUDE AS DOUBLE) END AS DEC_LATITUDE,
       CASE WHEN isnan(TRY_CAST(DEC_LONGITUDE AS DOUBLE)) THEN NULL ELSE TRY_CAST(DEC_LONGITUDE AS DOUBLE) END AS DEC_LONGITUDE
FROM crash_text"""))
def q_geo_coerce(spark, sf):
    return G.coerce_coords(_crash_text(spark, sf))


@register("geo_invalid_flag", O.with_(["crash", "geo_in"], """
SELECT CRN, DEC_LATITUDE, DEC_LONGITUDE, CASE WHEN _invalid THEN 'INVALID' END AS COORD_QUALITY_FLAG FROM geo_in"""))
def q_geo_invalid_flag(spark, sf):
    return G.flag_invalid_coords(fx.crash(spark, sf)).select("CRN", "DEC_LATITUDE", "DEC_LONGITUDE", "COORD_QUALITY_FLAG")


@register("geo_round", O.with_(["crash", "geo_in", "geo_rounded"], "SELECT CRN, DEC_LATITUDE, DEC_LONGITUDE FROM geo_rounded"))
def q_geo_round(spark, sf):
    return G.round_coords(fx.crash(spark, sf)).select("CRN", "DEC_LATITUDE", "DEC_LONGITUDE")


O.cte("roadway_county", "SELECT COUNTY FROM roadway")


@register("geo_county_top5", O.with_(["roadway"], """
SELECT CAST(COUNTY AS VARCHAR) AS county, COUNT(*) AS n FROM roadway WHERE COUNTY IS NOT NULL
GROUP BY 1 ORDER BY n DESC, county ASC LIMIT 5"""))
def q_geo_county_top5(spark, sf):
    return G.county_counts(fx.roadway(spark, sf), top=5)


@register("geo_county_flag", O.with_(["roadway"], """
SELECT CRN, LANE_COUNT, COUNTY, CASE WHEN coalesce(TRY_CAST(CAST(COUNTY AS VARCHAR) AS DOUBLE) <> 51, true)
       THEN 'NON_PHILLY_COUNTY' END AS COUNTY_QUALITY_FLAG FROM roadway"""))
def q_geo_county_flag(spark, sf):
    return G.flag_county(fx.roadway(spark, sf)).select("CRN", "LANE_COUNT", "COUNTY", "COUNTY_QUALITY_FLAG")


@register("geo_stats", O.with_(["crash", "geo_in", "geo_rounded", "geo_flagged"], f"""
SELECT COUNT(*) AS total_records,
       COUNT(*) FILTER (WHERE DEC_LATITUDE IS NOT NULL AND DEC_LONGITUDE IS NOT NULL) AS records_with_coords,
       COUNT(*) FILTER (WHERE _flag_inv) AS invalid_coords,
       COUNT(*) FILTER (WHERE COORD_QUALITY_FLAG = 'OUTSIDE_PHILLY') AS outside_bounds,
       COUNT(*) FILTER (WHERE COUNTY_QUALITY_FLAG IS NOT NULL) AS county_mismatches,
       COUNT(*) FILTER (WHERE coalesce({O.BOX}, false) OR DEC_LATITUDE IS NULL) AS final_records
FROM (SELECT *, DEC_LATITUDE IS NULL OR DEC_LONGITUDE IS NULL OR COORD_QUALITY_FLAG = 'INVALID'
             OR (COORD_QUALITY_FLAG = 'OUTSIDE_PHILLY' AND coalesce(DEC_LATITUDE = 0 AND DEC_LONGITUDE = 0, false)) AS _flag_inv
      FROM geo_flagged)"""))
def q_geo_stats(spark, sf):
    return G.geo_stats(fx.crash(spark, sf))


@register("filter_bbox_keep_null", O.with_(["crash"], f"""
SELECT CRN, DEC_LATITUDE, DEC_LONGITUDE FROM crash WHERE DEC_LATITUDE IS NULL OR coalesce({O.BOX}, false)"""))
def q_filter_bbox(spark, sf):
    """F8 alone, on coordinates as they are: no coercion, rounding or flags."""
    return G.filter_box(fx.crash(spark, sf)).select("CRN", "DEC_LATITUDE", "DEC_LONGITUDE")


@register("geo_pipeline", O.with_(["crash", "geo_in", "geo_rounded", "geo_flagged", "geo"], "SELECT * FROM geo"))
def q_geo_pipeline(spark, sf):
    return G.geo_pipeline(fx.crash(spark, sf))


@register("flag_outside", O.with_(["crash", "geo_in", "geo_rounded", "geo_flagged"], "SELECT * FROM geo_flagged"))
def q_flag_outside(spark, sf):
    return stages.crash_geographic(spark, sf, drop_outside=False)


@register("geo_boundary", O.with_(["crash", "geo_in", "geo_rounded", "geo_flagged"], f"""
SELECT CRN, DEC_LATITUDE, DEC_LONGITUDE FROM geo_flagged WHERE coalesce({O.BOX}, false) OR DEC_LATITUDE IS NULL"""))
def q_geo_boundary(spark, sf):
    g = stages.crash_geographic(spark, sf, drop_outside=False)
    return G.filter_polygon(g).select("CRN", "DEC_LATITUDE", "DEC_LONGITUDE")


O.cte("patrol_edges", """
SELECT s_suppkey AS area_id, x + u1 * side AS ax, y + v1 * side AS ay, x + u2 * side AS bx, y + v2 * side AS by_
FROM (SELECT s_suppkey, -75.30::DOUBLE + CAST(s_suppkey * 37 % 350 AS DOUBLE) / 1000.0::DOUBLE AS x,
             39.85::DOUBLE + CAST(s_suppkey * 53 % 300 AS DOUBLE) / 1000.0::DOUBLE AS y,
             0.008::DOUBLE + CAST(s_suppkey % 7 AS DOUBLE) * 0.004::DOUBLE AS side FROM supplier),
     (VALUES (0.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE, 0.125::DOUBLE), (1.0, 0.125, 0.875, 1.0), (0.875, 1.0, 0.5, 0.25),
             (0.5, 0.25, 0.125, 1.0), (0.125, 1.0, 0.0, 0.0)) c(u1, v1, u2, v2)
""")
O.cte("patrolled", """
SELECT c.CRN, c.MAX_SEVERITY_LEVEL, e.area_id
FROM crash c JOIN (SELECT area_id, CASE WHEN ay <= by_ THEN ax ELSE bx END AS x1, least(ay, by_) AS y1,
                          CASE WHEN ay <= by_ THEN bx ELSE ax END AS x2, greatest(ay, by_) AS y2 FROM patrol_edges) e
  ON c.DEC_LATITUDE >= e.y1 AND c.DEC_LATITUDE < e.y2
 AND c.DEC_LONGITUDE < (e.x2 - e.x1) * (c.DEC_LATITUDE - e.y1) / (e.y2 - e.y1) + e.x1
GROUP BY ALL HAVING COUNT(*) % 2 = 1
""")


@register("geo_areas", O.with_(["crash", "patrol_edges", "patrolled"], """
SELECT CRN, DEC_LATITUDE, DEC_LONGITUDE FROM crash WHERE DEC_LATITUDE IS NULL OR CRN IN (SELECT CRN FROM patrolled)"""))
def q_geo_areas(spark, sf):
    """G7 with as many concave polygons as suppliers."""
    cover = A.cell_cover(fx.patrol_areas(spark, sf))
    return A.filter_areas(fx.crash(spark, sf), cover, boundary=False).select("CRN", "DEC_LATITUDE", "DEC_LONGITUDE")


@register("area_polygons", O.with_(["crash", "patrol_edges", "patrolled"], """
SELECT area_id, COUNT(*) AS crashes, MAX(MAX_SEVERITY_LEVEL) AS max_severity FROM patrolled GROUP BY 1"""))
def q_area_polygons(spark, sf):
    """X2 by polygon."""
    return A.area_totals(fx.crash(spark, sf), A.cell_cover(fx.patrol_areas(spark, sf)))


@register("geo_point", O.with_(["crash", "geo_in", "geo_rounded", "geo_flagged", "geo"], """
SELECT CRN, CASE WHEN DEC_LATITUDE IS NOT NULL AND DEC_LONGITUDE IS NOT NULL THEN DEC_LONGITUDE END AS lon,
       CASE WHEN DEC_LATITUDE IS NOT NULL AND DEC_LONGITUDE IS NOT NULL THEN DEC_LATITUDE END AS lat,
       CASE WHEN DEC_LATITUDE IS NOT NULL AND DEC_LONGITUDE IS NOT NULL THEN 4326 END AS srid
FROM geo"""))
def q_geo_point(spark, sf):
    g = G.add_point(stages.crash_geographic(spark, sf))
    return g.select("CRN", F.col("geometry.lon").alias("lon"), F.col("geometry.lat").alias("lat"),
                    F.col("geometry.srid").alias("srid"))
