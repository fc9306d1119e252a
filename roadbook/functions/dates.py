"""Date construction that returns NULL instead of failing under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int_code(df: DataFrame, name: str) -> Column:
    """An integer code the way Python ``int(value)`` reads it.

    Numeric columns truncate (``int(3.0) == 3``); text columns must hold an
    integer literal (``int('3.0')`` fails, so ``'3.0'`` -> NULL).
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, IntegralType):
        return F.col(name).try_cast("int")
    if isinstance(dtype, NumericType):
        x = F.col(name).cast("double")
        return F.when(F.isnan(x), F.lit(None)).otherwise(x.try_cast("int")).cast("int")
    return F.trim(F.col(name).cast("string")).try_cast("int")


def _first_of_month(y: Column, m: Column) -> Column:
    return F.when(y.between(1, 9999) & m.between(1, 12), F.make_date(y, m, F.lit(1)))


def safe_date(y, m, d) -> Column:
    """``date(y, m, d)`` or NULL when the parts do not form a calendar date.

    ``make_date`` raises on bad parts under ANSI mode, so it is only reached
    through a validity guard (CASE evaluates lazily).
    """
    y, m, d = _c(y), _c(m), _c(d)
    first = _first_of_month(y, m)
    ok = d.between(1, 31) & (d <= F.dayofmonth(F.last_day(first)))
    return F.when(first.isNotNull() & ok, F.make_date(y, m, d))


def first_weekday_in_month(y, m, dow) -> Column:
    """First date in month ``m`` of year ``y`` that falls on weekday ``dow``.

    ``dow`` uses 1 = Sunday ... 7 = Saturday, which is also Spark's
    ``dayofweek`` encoding; codes outside 1..7 wrap modulo 7.
    """
    first = _first_of_month(_c(y), _c(m))
    offset = F.pmod(_c(dow) - F.dayofweek(first), F.lit(7))
    return F.when(_c(dow).isNotNull(), F.date_add(first, offset))
