"""Daily weather: long-to-wide reshape, join to crashes, derived features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.constants import (ADVERSE_PRECIP_MM, ADVERSE_SNOW_MM, ADVERSE_WIND_MS, EXTREME_COLD_C,
                                EXTREME_HOT_C, PRECIP_BINS, PRECIP_TOP, TEMP_BINS, TEMP_TOP,
                                TEMPERATURE_COLUMNS, TEMPERATURE_SCALE, WEATHER_NAMES)
from roadbook.functions.numeric import is_true
from roadbook.operators.joins import join_small, suffix_clashes


def pivot_long(long_df: DataFrame, key: str = "date", type_col: str = "datatype", value_col: str = "value",
               order_col: str | None = None, types: list[str] | None = None) -> DataFrame:
    """Long (key, type, value) rows -> one row per key, one column per type.

    Keeps the first non-null value per (key, type) by ``order_col`` (ingest
    order); without one, the smallest value. The type list is fixed so the
    schema does not depend on the data; Spark's pivot aggregates by (key,
    type) first, so each key group is tiny before the pivot.
    """
    types = list(types if types is not None else WEATHER_NAMES)
    rows = long_df.filter(F.col(value_col).isNotNull() & ~F.isnan(F.col(value_col).cast("double")))
    agg = (F.min_by(value_col, order_col) if order_col else F.min(value_col)).alias("v")
    return rows.groupBy(key).pivot(type_col, types).agg(agg)


def rename_weather(wide: DataFrame, names: dict | None = None) -> DataFrame:
    """observation codes to column names; columns that aren't known keep theirs."""
    return wide.withColumnsRenamed(dict(names or WEATHER_NAMES))


def weather_daily(long_df: DataFrame, date_col: str = "date", order_col: str | None = None,
                  scale: float = TEMPERATURE_SCALE, names: dict | None = None) -> DataFrame:
    """Pivot observations by date, rename the codes, scale temperatures.

    ``scale`` divides the temperature columns (raw station data is in tenths
    of a degree); pass 1 when the source already reports degrees.
    """
    names = dict(names or WEATHER_NAMES)
    wide = pivot_long(long_df.withColumn(date_col, F.to_date(date_col)), key=date_col,
                      order_col=order_col, types=list(names))
    wide = rename_weather(wide, names)
    scaled = {c: F.col(c).cast("double") / F.lit(float(scale)) for c in TEMPERATURE_COLUMNS if c in wide.columns}
    others = {c: F.col(c).cast("double") for c in names.values() if c in wide.columns and c not in scaled}
    return wide.withColumns({**scaled, **others})


def join_weather(crash: DataFrame, weather: DataFrame, date_col: str = "crash_date",
                 weather_date: str = "date") -> DataFrame:
    """Every crash keeps its row; weather columns attach by calendar date.

    Right-side name clashes get ``_weather``. The weather side is one row per
    date; adaptive execution sees its exact size and chooses the join.
    """
    w = weather.withColumn("_wx_date", F.to_date(weather_date)).drop(weather_date)
    w = suffix_clashes(crash.columns, w, ["_wx_date"], "_weather")
    joined = join_small(crash.withColumn("_wx_date", F.to_date(date_col)), w, "_wx_date", "left")
    return joined.drop("_wx_date")


def match_stats(crash: DataFrame, weather: DataFrame, date_col: str = "crash_date",
                weather_date: str = "date") -> DataFrame:
    """Crashes with a weather row, and crashes with an average temperature.

    The second number is the stage's historical "matched" counter; the first
    is whether a weather row exists for the date at all.
    """
    w = weather.select(F.to_date(weather_date).alias("_wx_date"), F.lit(True).alias("_wx_row"),
                       F.col("temp_avg_c").alias("_wx_tavg"))
    j = join_small(crash.select(F.to_date(date_col).alias("_wx_date")), w, "_wx_date", "left")
    return j.agg(
        F.count(F.lit(1)).alias("total_crashes"),
        F.count_if(F.col("_wx_row").isNotNull()).alias("weather_row_matched"),
        F.count_if(F.col("_wx_tavg").isNotNull()).alias("crashes_matched"),
        F.count_if(F.col("_wx_tavg").isNull()).alias("crashes_unmatched"),
    )


def _right_closed_bins(c, bins, top):
    expr = F.when(F.col(c).isNull(), F.lit(None).cast("string"))
    for edge, label in bins:
        expr = expr.when(F.col(c) <= F.lit(edge), F.lit(label))
    return expr.otherwise(F.lit(top))


def add_weather_features(df: DataFrame) -> DataFrame:
    """precipitation/temperature categories and the two 0/1 flags.

    Bins are right-closed; a missing value gives a NULL category and a 0 flag.
    Each part is added only when its source column exists.
    """
    out = {}
    if "precipitation_mm" in df.columns:
        out["precip_category"] = _right_closed_bins("precipitation_mm", PRECIP_BINS, PRECIP_TOP)
        adverse = is_true(F.col("precipitation_mm") > ADVERSE_PRECIP_MM)
        if "wind_speed_max_ms" in df.columns:
            adverse = adverse | is_true(F.col("wind_speed_max_ms") > ADVERSE_WIND_MS)
        if "snowfall_mm" in df.columns:
            adverse = adverse | is_true(F.col("snowfall_mm") > ADVERSE_SNOW_MM)
        out["adverse_weather"] = adverse.cast("int")
    if "temp_avg_c" in df.columns:
        out["temp_category"] = _right_closed_bins("temp_avg_c", TEMP_BINS, TEMP_TOP)
        t = F.col("temp_avg_c")
        out["extreme_temp"] = (is_true(t < EXTREME_COLD_C) | is_true(t > EXTREME_HOT_C)).cast("int")
    return df.withColumns(out)


def weather_by_weekday(weather: DataFrame, date_col: str = "date") -> DataFrame:
    """X8 helper: weather averaged over all days of a (year, month, weekday)."""
    d = F.to_date(date_col)
    cols = [c for c in weather.columns if c != date_col]
    return (weather.groupBy(F.year(d).alias("wx_year"), F.month(d).alias("wx_month"),
                            F.dayofweek(d).alias("wx_weekday"))
            .agg(*[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias("wx_days")))
