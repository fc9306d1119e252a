"""Approximate crash-date reconstruction (year, month, weekday -> calendar date)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.constants import (FALLBACK_DAY, METHOD_EXACT, METHOD_FALLBACK, METHOD_MID_ONLY,
                                METHOD_WEEKDAY)
from roadbook.functions.dates import first_weekday_in_month, safe_date, to_int_code


def reconstruct_dates(df: DataFrame, year_col: str = "CRASH_YEAR", month_col: str = "CRASH_MONTH",
                      dow_col: str = "DAY_OF_WEEK", day_col: str = "CRASH_DAY",
                      mode: str = "table") -> DataFrame:
    """Add ``crash_date`` (date), ``date_approximation_method`` and ``day_col``.

    ``mode="table"`` keeps the table-level switch: if the day column exists and
    holds any value, every row uses (year, month, day) and is tagged
    ``exact_day`` even where its own day is missing. The "any value" test is
    a scalar subquery, so the decision is computed once by Spark, never by
    collecting rows. Otherwise rows use the first occurrence of their weekday
    in the month, falling back to the 15th (which is also written to the day
    column). Without either column every row gets the 15th.

    ``mode="row"`` is the documented per-row chain: exact day when present,
    else weekday, else the 15th.

    The day column is always present in the output (as int).
    """
    if year_col not in df.columns or month_col not in df.columns:
        raise ValueError(f"date reconstruction needs {year_col} and {month_col}")
    y, m = to_int_code(df, year_col), to_int_code(df, month_col)
    has_day_col = day_col in df.columns
    has_dow_col = dow_col in df.columns
    day = to_int_code(df, day_col) if has_day_col else F.lit(None).cast("int")
    dow = to_int_code(df, dow_col) if has_dow_col else F.lit(None).cast("int")
    exact = safe_date(y, m, day)
    weekday = first_weekday_in_month(y, m, dow)
    mid = safe_date(y, m, F.lit(FALLBACK_DAY))
    fifteen = F.lit(FALLBACK_DAY).cast("int")

    if mode == "row":
        date = F.coalesce(exact, weekday, mid)
        method = (F.when(exact.isNotNull(), F.lit(METHOD_EXACT))
                  .when(weekday.isNotNull(), F.lit(METHOD_WEEKDAY))
                  .otherwise(F.lit(METHOD_FALLBACK if has_dow_col or has_day_col else METHOD_MID_ONLY)))
        new_day = F.when(exact.isNull() & weekday.isNull(), fifteen).otherwise(day)
    elif mode == "table":
        if has_dow_col:
            wk_date = F.coalesce(weekday, mid)
            wk_method = F.when(weekday.isNotNull(), F.lit(METHOD_WEEKDAY)).otherwise(F.lit(METHOD_FALLBACK))
            wk_day = F.when(weekday.isNull(), fifteen).otherwise(day)
        else:
            wk_date, wk_method, wk_day = mid, F.lit(METHOD_MID_ONLY), fifteen
        if has_day_col:
            any_day = df.select(F.count(F.col(day_col)) > 0).scalar()
            date = F.when(any_day, exact).otherwise(wk_date)
            method = F.when(any_day, F.lit(METHOD_EXACT)).otherwise(wk_method)
            new_day = F.when(any_day, day).otherwise(wk_day)
        else:
            date, method, new_day = wk_date, wk_method, wk_day
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.withColumns({
        day_col: new_day.cast("int"),
        "crash_date": date,
        "date_approximation_method": method,
    })


def date_stats(df: DataFrame) -> DataFrame:
    """One-row summary: totals, counts by method and the date range."""
    m = F.col("date_approximation_method")
    return df.agg(
        F.count(F.lit(1)).alias("total_crashes"),
        F.count("crash_date").alias("crashes_with_dates"),
        F.count_if(m == METHOD_EXACT).alias("exact_day"),
        F.count_if(m == METHOD_WEEKDAY).alias("weekday_reconstructed"),
        F.count_if(m == METHOD_FALLBACK).alias("mid_month_fallback"),
        F.count_if(m == METHOD_MID_ONLY).alias("mid_month_only"),
        F.min("crash_date").alias("min_date"),
        F.max("crash_date").alias("max_date"),
    )


def method_counts(df: DataFrame) -> DataFrame:
    """Crash count per approximation method."""
    return df.groupBy("date_approximation_method").agg(F.count(F.lit(1)).alias("n"))


def weekday_balance(df: DataFrame, day_col: str = "crash_date") -> DataFrame:
    """Sanity summary for weekday-reconstructed dates (days 1-7, weekday spread).

    One row per weekday: crashes, how many reconstructed dates fall outside
    days 1-7 of the month, and how many dates are missing.
    """
    d = F.col(day_col)
    wk = df.filter(F.col("date_approximation_method") == METHOD_WEEKDAY)
    return wk.groupBy(F.dayofweek(d).alias("weekday")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.dayofmonth(d) > 7).alias("day_after_7"),
        F.count_if(d.isNull()).alias("missing_date"),
    )
