"""Coordinate validation, county coding and the bounding-box filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.constants import (BOUNDARY, BOUNDS, COORD_DECIMALS, FLAG_COUNTY, FLAG_INVALID, FLAG_OUTSIDE,
                                HOME_COUNTY, LAT_COL, LON_COL)
from roadbook.functions.coords import in_box, in_box_rounded, point_in_polygon, point_struct, point_wkt
from roadbook.functions.numeric import is_true, not_equal_or_missing, to_number


def _ensure_flag(df: DataFrame, name: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast("string"))


def coerce_coords(df: DataFrame, lat: str = LAT_COL, lon: str = LON_COL) -> DataFrame:
    """G1: coordinates to double; unparseable text and NaN become NULL."""
    return df.withColumns({c: to_number(c, already_double=dict(df.dtypes)[c] == "double") for c in (lat, lon)})


def invalid_coord_expr(lat: str = LAT_COL, lon: str = LON_COL):
    la, lo = F.col(lat), F.col(lon)
    return (is_true((la == 0) & (lo == 0)) | la.isNull() | lo.isNull()
            | is_true(la < -90) | is_true(la > 90) | is_true(lo < -180) | is_true(lo > 180))


def flag_invalid_coords(df: DataFrame, lat: str = LAT_COL, lon: str = LON_COL) -> DataFrame:
    """``COORD_QUALITY_FLAG = 'INVALID'`` for (0,0), missing or out-of-range points."""
    df = _ensure_flag(df, "COORD_QUALITY_FLAG")
    return df.withColumn("COORD_QUALITY_FLAG",
                         F.when(invalid_coord_expr(lat, lon), F.lit(FLAG_INVALID)).otherwise(F.col("COORD_QUALITY_FLAG")))


def round_coords(df: DataFrame, lat: str = LAT_COL, lon: str = LON_COL, decimals: int = COORD_DECIMALS) -> DataFrame:
    """Round both coordinates in place where both are present."""
    both = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    return df.withColumns({c: F.when(both, F.round(c, decimals)).otherwise(F.col(c)) for c in (lat, lon)})


def county_counts(df: DataFrame, county: str = "COUNTY", top: int | None = 5) -> DataFrame:
    """Records per county (NULL excluded), largest first, ties by code."""
    out = (df.filter(F.col(county).isNotNull())
           .groupBy(F.col(county).cast("string").alias("county"))
           .agg(F.count(F.lit(1)).alias("n")))
    if top is not None:
        out = out.orderBy(F.desc("n"), F.asc("county")).limit(top)
    return out


def flag_county(df: DataFrame, county: str = "COUNTY", home: int = HOME_COUNTY) -> DataFrame:
    """``COUNTY_QUALITY_FLAG`` for any code other than ``home`` (NULL included).

    Text codes are compared by value, so ``'51'`` counts as home.
    """
    df = _ensure_flag(df, "COUNTY_QUALITY_FLAG")
    if county not in df.columns:
        return df
    off = not_equal_or_missing(F.col(county).cast("string").try_cast("double"), F.lit(float(home)))
    return df.withColumn("COUNTY_QUALITY_FLAG",
                         F.when(off, F.lit(FLAG_COUNTY)).otherwise(F.col("COUNTY_QUALITY_FLAG")))


def box_keep_expr(lat: str = LAT_COL, lon: str = LON_COL, bounds: dict = BOUNDS):
    return is_true(in_box(lat, lon, bounds)) | F.col(lat).isNull()


def outside_expr(lat: str = LAT_COL, lon: str = LON_COL, bounds: dict = BOUNDS):
    return ~is_true(in_box(lat, lon, bounds)) & F.col(lat).isNotNull()


def flag_outside(df: DataFrame, lat: str = LAT_COL, lon: str = LON_COL, bounds: dict = BOUNDS) -> DataFrame:
    """``COORD_QUALITY_FLAG = 'OUTSIDE_PHILLY'`` for points with a latitude outside the box."""
    df = _ensure_flag(df, "COORD_QUALITY_FLAG")
    return df.withColumn("COORD_QUALITY_FLAG",
                         F.when(outside_expr(lat, lon, bounds), F.lit(FLAG_OUTSIDE)).otherwise(F.col("COORD_QUALITY_FLAG")))


def filter_box(df: DataFrame, lat: str = LAT_COL, lon: str = LON_COL, bounds: dict = BOUNDS) -> DataFrame:
    """F8: keep rows inside the box (inclusive) or without a latitude."""
    return df.filter(box_keep_expr(lat, lon, bounds))


def filter_polygon(df: DataFrame, lat: str = LAT_COL, lon: str = LON_COL,
                   vertices=BOUNDARY, keep_missing: bool = True) -> DataFrame:
    """Keep points inside a polygon; the polygon's box is tested first."""
    xs = [v[0] for v in vertices]
    ys = [v[1] for v in vertices]
    box = {"lat_min": min(ys), "lat_max": max(ys), "lon_min": min(xs), "lon_max": max(xs)}
    inside = is_true(in_box(lat, lon, box)) & is_true(point_in_polygon(lon, lat, vertices))
    return df.filter(inside | F.col(lat).isNull()) if keep_missing else df.filter(inside)


def add_point(df: DataFrame, lat: str = LAT_COL, lon: str = LON_COL) -> DataFrame:
    """Point geometry as ``struct<lon, lat, srid>`` and WKT text."""
    return df.withColumns({"geometry": point_struct(lon, lat), "geometry_wkt": point_wkt(lon, lat)})


def geo_stats(df: DataFrame, lat: str = LAT_COL, lon: str = LON_COL, county: str = "COUNTY",
              bounds: dict = BOUNDS, home: int = HOME_COUNTY) -> DataFrame:
    """The stage counters in one aggregate pass over the coerced input."""
    la, lo = to_number(lat), to_number(lon)
    both = la.isNotNull() & lo.isNotNull()
    rla = F.when(both, F.round(la, COORD_DECIMALS)).otherwise(la)
    rlo = F.when(both, F.round(lo, COORD_DECIMALS)).otherwise(lo)
    inb = is_true(in_box(rla, rlo, bounds))
    invalid = (is_true((la == 0) & (lo == 0)) | la.isNull() | lo.isNull() | is_true(la < -90)
               | is_true(la > 90) | is_true(lo < -180) | is_true(lo > 180))
    aggs = [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(both).alias("records_with_coords"),
        F.count_if(invalid).alias("invalid_coords"),
        F.count_if(~inb & rla.isNotNull()).alias("outside_bounds"),
    ]
    if county in df.columns:
        off = not_equal_or_missing(F.col(county).cast("string").try_cast("double"), F.lit(float(home)))
        aggs.append(F.count_if(off).alias("county_mismatches"))
    else:
        aggs.append(F.lit(0).cast("bigint").alias("county_mismatches"))
    aggs.append(F.count_if(inb | rla.isNull()).alias("final_records"))
    return df.agg(*aggs)


def geo_pipeline(df: DataFrame, lat: str = LAT_COL, lon: str = LON_COL, county: str = "COUNTY",
                 bounds: dict = BOUNDS, home: int = HOME_COUNTY, drop_outside: bool = True) -> DataFrame:
    """Coerce, flag invalid, round, flag county, flag outside, then filter.

    ``drop_outside=False`` is the flag-only mode: every row is kept and the
    outside points carry ``OUTSIDE_PHILLY``. In the default mode the box
    filter is applied right after coercion (on the rounded-equivalent test
    of :func:`in_box_rounded`), so the scan-level predicate stays small and
    the flags and rounding are computed only for kept rows; an outside flag
    can never survive the filter, so it is not computed there.
    """
    if lat not in df.columns or lon not in df.columns:
        return _ensure_flag(_ensure_flag(df, "COORD_QUALITY_FLAG"), "COUNTY_QUALITY_FLAG")
    out = coerce_coords(df, lat, lon)
    if drop_outside:
        out = out.filter(is_true(in_box_rounded(lat, lon, bounds)) | F.col(lat).isNull())
    out = flag_invalid_coords(out, lat, lon)
    out = round_coords(out, lat, lon)
    out = flag_county(_ensure_flag(out, "COUNTY_QUALITY_FLAG"), county, home)
    return out if drop_outside else flag_outside(out, lat, lon, bounds)
