"""Point and box predicates on (lon, lat) columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadbook.constants import BOUNDARY, SRID


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_box(lat, lon, bounds: dict) -> Column:
    """Inclusive box test; NULL when a coordinate is missing."""
    lat, lon = _c(lat), _c(lon)
    return (lat.between(bounds["lat_min"], bounds["lat_max"])
            & lon.between(bounds["lon_min"], bounds["lon_max"]))


def in_box_rounded(lat, lon, bounds: dict, decimals: int = 6) -> Column:
    """``in_box(round(lat), round(lon))`` without rounding every row.

    Rounding to ``decimals`` places moves a value by at most half a unit in
    the last place, so it can only change the box test for values that lie
    that close to a bound; only those rows evaluate the rounded test (CASE
    evaluates its branches lazily). Same result, a fraction of the cost.
    """
    lat, lon = _c(lat), _c(lon)
    eps = 10.0 ** (-decimals)
    near = F.lit(False)
    for c, lo_k, hi_k in ((lat, "lat_min", "lat_max"), (lon, "lon_min", "lon_max")):
        near = near | (F.abs(c - F.lit(bounds[lo_k])) <= eps) | (F.abs(c - F.lit(bounds[hi_k])) <= eps)
    return F.when(near, in_box(F.round(lat, decimals), F.round(lon, decimals), bounds)).otherwise(in_box(lat, lon, bounds))


def decimal_places(c) -> Column:
    """Digits after the decimal point in the value's text form; NULL for NULL."""
    s = _c(c).cast("string")
    return (F.when(s.isNull(), F.lit(None).cast("int"))
            .when(s.contains("."), F.length(F.substring_index(s, ".", -1)))
            .otherwise(F.lit(0)))


def point_in_polygon(lon, lat, vertices: list[tuple[float, float]] = BOUNDARY,
                     include_boundary: bool = True) -> Column:
    """Even-odd ray casting over a closed vertex list, as one ``aggregate``.

    The vertex list is a literal array of structs, so the test stays a
    codegen'd expression; callers prefilter by the polygon's box. Points on
    an edge count as inside when ``include_boundary`` (matching the
    inclusive box test).
    """
    lon, lat = _c(lon), _c(lat)
    pts = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in vertices])
    edges = F.arrays_zip(F.slice(pts, 1, len(vertices) - 1).alias("a"),
                         F.slice(pts, 2, len(vertices) - 1).alias("b"))

    def step(acc, e):
        a, b = e["a"], e["b"]
        crosses = (a["y"] > lat) != (b["y"] > lat)
        x_at = (b["x"] - a["x"]) * (lat - a["y"]) / (b["y"] - a["y"]) + a["x"]
        return F.when(crosses & (lon < x_at), ~acc).otherwise(acc)

    inside = F.aggregate(edges, F.lit(False), step)
    if include_boundary:
        def on_edge(e):
            a, b = e["a"], e["b"]
            cross = (b["x"] - a["x"]) * (lat - a["y"]) - (b["y"] - a["y"]) * (lon - a["x"])
            return ((cross == 0) & lon.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"]))
                    & lat.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"])))
        inside = inside | F.exists(edges, on_edge)
    return F.when(lon.isNotNull() & lat.isNotNull(), inside)


def point_struct(lon, lat) -> Column:
    """Point as ``struct<lon, lat, srid>``; NULL when either coordinate is missing."""
    lon, lat = _c(lon), _c(lat)
    return F.when(lon.isNotNull() & lat.isNotNull(),
                  F.struct(lon.alias("lon"), lat.alias("lat"), F.lit(SRID).alias("srid")))


def point_wkt(lon, lat) -> Column:
    """Point as WKT text; NULL when either coordinate is missing."""
    lon, lat = _c(lon), _c(lat)
    return F.when(lon.isNotNull() & lat.isNotNull(),
                  F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")")))
