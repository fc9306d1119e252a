"""Points in many polygons by a cover of grid cells (G7, X2 beyond one literal polygon).

``cell_cover`` cuts each area into the cells of a square grid. A cell that no
edge touches lies inside the area as a whole, so its points need no test; a
cell that an edge touches keeps the few edges that can lie to the right of its
points. Points then meet cells by an equi-join on the cell, never every
polygon, and a point is tested against the edges of its own cell's row only.

``area_totals`` pairs no point with an area that holds its whole cell: such cells
add their totals, and crowded cells on an edge are split first.

An area is one row with an id and its rings (holes and parts alike: a point
with an odd number of edges to its right is inside). Edges are read in one
direction whichever way a ring runs, so two areas that share an edge agree
about it: in a tiling, each point belongs to exactly one area.

Cases: rings are closed if they aren't; rings of fewer than three corners, null
or non-finite corners and null rings hold no point; areas without an id take no
part; equal ids are one area; points with a null or non-finite coordinate lie
nowhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbook.constants import LAT_COL, LON_COL
from roadbook.operators.joins import join_small

#: Side of a grid cell in degrees: about a kilometre.
CELL = 0.01
#: Cells overlap by this share of their side when edges are dealt to them, far above any rounding of a double.
_PAD = 1e-6
RINGS = "array<array<struct<lon: double, lat: double>>>"
EDGE = ("x1", "y1", "x2", "y2")
#: ``area_totals`` splits a cell with more than CROWD places into SPLIT x SPLIT cells, LEVELS times at most.
CROWD, SPLIT, LEVELS = 256, 4, 3


def rings_from_geojson(c: str) -> Column:
    """Rings of a GeoJSON Polygon or MultiPolygon text; null for anything else."""
    def corners(rings):
        return F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(
            F.get(p, F.lit(0)).alias("lon"), F.get(p, F.lit(1)).alias("lat"))))

    one = F.from_json(c, "type string, coordinates array<array<array<double>>>")
    many = F.from_json(c, "type string, coordinates array<array<array<array<double>>>>")
    return (F.when(one["type"] == "Polygon", corners(one["coordinates"]))
            .when(many["type"] == "MultiPolygon", corners(F.flatten(many["coordinates"]))))


def edges(areas: DataFrame, area_id: str = "area_id", rings: str = "rings") -> DataFrame:
    """(area_id, x1, y1, x2, y2): the edges of all rings, each from its lower to its upper end."""
    def finite(v):
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))

    ring = areas.where(F.col(area_id).isNotNull()).select(F.col(area_id).alias("area_id"), F.explode(F.col(rings).cast(RINGS)).alias("r"))
    ring = ring.where((F.size("r") >= 3) & F.forall("r", lambda p: finite(p["lon"]) & finite(p["lat"])))
    ring = ring.select("area_id", F.when(F.element_at("r", 1) == F.element_at("r", -1), F.col("r"))
                       .otherwise(F.concat("r", F.slice("r", 1, 1))).alias("r"))
    n = F.size("r") - 1
    pair = ring.select("area_id", F.slice("r", F.lit(1), n).alias("a"), F.slice("r", F.lit(2), n).alias("b"))
    pair = pair.select("area_id", F.inline(F.arrays_zip("a", "b")))
    lower = (F.col("a.lat") < F.col("b.lat")) | ((F.col("a.lat") == F.col("b.lat")) & (F.col("a.lon") <= F.col("b.lon")))
    first, last = F.when(lower, F.col("a")).otherwise(F.col("b")), F.when(lower, F.col("b")).otherwise(F.col("a"))
    return pair.select("area_id", first["lon"].alias("x1"), first["lat"].alias("y1"), last["lon"].alias("x2"), last["lat"].alias("y2"))


def _inside(near: Column, base: Column, lon: Column, lat: Column) -> Column:
    """Odd number of edges to the right of a point; ``base``: parity of the edges that aren't listed."""
    def step(odd, e):
        right = F.when((e["y1"] > lat) != (e["y2"] > lat),
                       lon < (e["x2"] - e["x1"]) * (lat - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]).otherwise(False)
        return odd != right

    return F.aggregate(near, base, step)


def _on_edge(near: Column, lon: Column, lat: Column) -> Column:
    return F.exists(near, lambda e: ((e["x2"] - e["x1"]) * (lat - e["y1"]) - (e["y2"] - e["y1"]) * (lon - e["x1"]) == 0)
                    & lat.between(e["y1"], e["y2"]) & lon.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])))


def _cell(v: Column, cell: float) -> Column:
    return F.floor(v / F.lit(cell)).cast("long")


def _cells(rows: DataFrame, cell: float) -> DataFrame:
    """Cells (area_id, cell_x, cell_y, near, base) of rows of cells: ``all``, edges placed in the row, and ``odd``, parity of those left out."""
    at = F.col("cell_x")

    def beside(k):
        return k["through"] & (k["c0"] > at)     # to the right of every point of the cell, from below it to above it

    near = F.filter("all", lambda k: (k["c1"] >= at) & ~beside(k))
    base = F.col("odd") != (F.size(F.filter("all", beside)) % 2 == 1)
    touched = F.exists("all", lambda k: (k["c0"] <= at) & (k["c1"] >= at))
    cells = rows.select("area_id", "cell_x", "cell_y", near.alias("near"), base.alias("base"), touched.alias("touched"))
    centre = _inside(F.col("near"), F.col("base"), (F.col("cell_x") + 0.5) * F.lit(cell), (F.col("cell_y") + 0.5) * F.lit(cell))
    return cells.where(F.col("touched") | centre).select(
        "area_id", "cell_x", "cell_y", F.when(F.col("touched"), F.transform("near", lambda k: F.struct(
            *[k[c].alias(c) for c in EDGE]))).alias("near"), "base")


def _placed(e, cell_y: Column, cell: float) -> Column:
    """An edge with the cells ``c0`` to ``c1`` that it meets in a row of cells; ``through``: it runs from below the row to above it."""
    pad, y = cell * _PAD, cell_y * F.lit(cell)
    x1, y1, x2, y2 = (e[c] for c in EDGE)

    def x_at(v):
        return F.when(y1 == y2, x1).otherwise((x2 - x1) * (v - y1) / (y2 - y1) + x1)

    # where the edge runs within the row of cells
    low, high = F.greatest(y1, y - pad), F.least(y2, y + cell + pad)
    left = F.when(y1 == y2, F.least(x1, x2)).otherwise(F.least(x_at(low), x_at(high)))
    right = F.when(y1 == y2, F.greatest(x1, x2)).otherwise(F.greatest(x_at(low), x_at(high)))
    return F.struct(*[e[c].alias(c) for c in EDGE], _cell(left - pad, cell).alias("c0"), _cell(right + pad, cell).alias("c1"),
                    ((y1 < y - pad) & (y2 > y + cell + pad)).alias("through"))


def cell_cover(areas: DataFrame, area_id: str = "area_id", rings: str = "rings", cell: float = CELL) -> DataFrame:
    """(area_id, cell_x, cell_y, near, base): cells that an area touches.

    ``near`` is null where the cell lies inside as a whole. Edges are grouped by
    area and row of cells, so no group is larger than one area's part of a row.
    """
    pad = cell * _PAD
    e = edges(areas, area_id, rings)
    e = e.withColumn("cell_y", F.explode(F.sequence(_cell(F.col("y1") - pad, cell), _cell(F.col("y2") + pad, cell))))
    e = e.select("area_id", "cell_y", _placed({c: F.col(c) for c in EDGE}, F.col("cell_y"), cell).alias("e"))
    rows = e.groupBy("area_id", "cell_y").agg(F.collect_list("e").alias("all"), F.min("e.c0").alias("m0"), F.max("e.c1").alias("m1"))
    return _cells(rows.select("area_id", "cell_y", "all", F.lit(False).alias("odd"), F.explode(F.sequence("m0", "m1")).alias("cell_x")), cell)


def _split(cells: DataFrame, cell: float) -> DataFrame:
    """The cells of side ``cell`` within cells of ``SPLIT`` times that side; those outside the area go."""
    pad, parts = cell * _PAD, F.sequence(F.lit(0), F.lit(SPLIT - 1))
    rows = cells.select("area_id", "cell_x", "near", "base", F.explode(F.transform(parts, lambda k: F.col("cell_y") * SPLIT + k)).alias("cell_y"))
    y = F.col("cell_y") * F.lit(cell)
    # edges above or below a row have no part in it
    met = F.filter("near", lambda k: (k["y1"] <= y + cell + pad) & (k["y2"] >= y - pad))
    rows = rows.select("area_id", "cell_x", "cell_y", F.transform(met, lambda k: _placed(k, F.col("cell_y"), cell)).alias("all"), F.col("base").alias("odd"))
    return _cells(rows.select("area_id", "cell_y", "all", "odd", F.explode(F.transform(parts, lambda k: F.col("cell_x") * SPLIT + k)).alias("cell_x")), cell)


def _joined(points: DataFrame, cover: DataFrame, how: str, lat: str, lon: str, cell: float, boundary: bool) -> DataFrame:
    p, c = points.alias("p"), cover.alias("c")
    x, y = F.col(f"p.`{lon}`").cast("double"), F.col(f"p.`{lat}`").cast("double")
    usable = [v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")) for v in (x, y)]
    on = ((F.when(usable[0], _cell(x, cell)) == F.col("c.cell_x")) & (F.when(usable[1], _cell(y, cell)) == F.col("c.cell_y")))
    hit = _inside(F.col("c.near"), F.col("c.base"), x, y)
    if boundary:
        hit = hit | _on_edge(F.col("c.near"), x, y)
    # adaptive execution broadcasts a cover of known small size; beyond it, a hot cell's points are split
    return p.join(c, on & F.when(F.col("c.near").isNull(), F.lit(True)).otherwise(hit), how)


def locate(points: DataFrame, cover: DataFrame, lat: str = LAT_COL, lon: str = LON_COL, cell: float = CELL,
           boundary: bool = False) -> DataFrame:
    """Each point with each ``area_id`` that it lies in; points outside all areas go.

    ``cell`` must be that of the cover. ``boundary``: points on an edge belong to
    every area that has it (else to one side only).
    """
    if "area_id" in {c.lower() for c in points.columns}:
        raise ValueError("the points have a column area_id already")
    return _joined(points, cover, "inner", lat, lon, cell, boundary).select("p.*", "c.area_id")


def filter_areas(points: DataFrame, cover: DataFrame, lat: str = LAT_COL, lon: str = LON_COL, cell: float = CELL,
                 boundary: bool = True, keep_missing: bool = True) -> DataFrame:
    """G7 for any number of polygons: points inside at least one, and those without a latitude."""
    inside = _joined(points, cover, "left_semi", lat, lon, cell, boundary).select("p.*")
    return inside.unionByName(points.where(F.col(lat).isNull())) if keep_missing else inside


def _places(points: DataFrame, lat: str, lon: str, severity: str) -> DataFrame:
    """(lat, lon, n, worst): points at the same place are one row."""
    p = points.select(F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"), F.col(severity).alias("severity"))
    for v in ("lat", "lon"):
        p = p.where(F.col(v).isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return p.groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("n"), F.max("severity").alias("worst"))


def _at_level(places: DataFrame, level: int, cell: float) -> DataFrame:
    side = cell / SPLIT ** level
    return places.select("*", F.lit(level).alias("level"), _cell(F.col("lon"), side).alias("cell_x"), _cell(F.col("lat"), side).alias("cell_y"))


def _crowded(places: DataFrame, level: int, cell: float) -> DataFrame:
    """(cell_x, cell_y) of the cells of a level that hold more than ``CROWD`` places."""
    return _at_level(places, level, cell).groupBy("cell_x", "cell_y").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD).select("cell_x", "cell_y")


def _targets(places: DataFrame, cell: float) -> DataFrame:
    """What cells are joined with: each place in its smallest cell, and the totals of every cell, of all levels (``whole``)."""
    rest, out, on = places, None, ["cell_x", "cell_y"]
    for level in range(LEVELS + 1):
        here = _at_level(rest, level, cell)
        totals = here.groupBy("level", *on).agg(F.sum("n").alias("n"), F.max("worst").alias("worst")).select(
            "level", *on, F.lit(True).alias("whole"), *[F.lit(None).cast("double").alias(c) for c in ("lat", "lon")], "n", "worst")
        last = level == LEVELS
        small = here if last else join_small(here, _crowded(places, level, cell), on, "left_anti")
        part = totals.unionByName(small.withColumn("whole", F.lit(False)))
        out = part if out is None else out.unionByName(part)
        if not last:
            rest = join_small(here, _crowded(places, level, cell), on, "left_semi").select(*places.columns)
    return out


def _refined(cover: DataFrame, places: DataFrame, cell: float) -> DataFrame:
    """The cover with cells that an edge touches split wherever many places are: (level, cell_x, cell_y, whole, area_id, near, base)."""
    rest, out, on = cover, None, ["cell_x", "cell_y"]
    # a fixed number: adaptive execution would merge partitions by their bytes, but a cell's work is its split
    parts = int(cover.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for level in range(LEVELS + 1):
        if level < LEVELS:
            marked = join_small(rest, _crowded(places, level, cell).withColumn("crowd", F.lit(True)), on, "left")
            split = F.col("near").isNotNull() & F.col("crowd").isNotNull()
        else:
            marked, split = rest, F.lit(False)
        part = marked.where(~split).select(F.lit(level).alias("level"), *on, F.col("near").isNull().alias("whole"), "area_id", "near", "base")
        out = part if out is None else out.unionByName(part)
        if level < LEVELS:
            dealt = marked.where(split).drop("crowd").repartition(parts, "area_id", *on)
            rest = _split(dealt, cell / SPLIT ** (level + 1))
    return out


def area_totals(points: DataFrame, cover: DataFrame, lat: str = LAT_COL, lon: str = LON_COL, cell: float = CELL,
                severity: str = "MAX_SEVERITY_LEVEL") -> DataFrame:
    """X2 by polygon: count and worst severity per area that holds a point.

    Points aren't paired with the areas that they lie in. A cell inside an area
    adds its totals as one row; only cells that an edge touches meet their single
    places, and those are split until they hold at most ``CROWD`` of them (or
    ``LEVELS`` times). Work follows the length of the areas' edges, in cells,
    not the number of points times the number of areas.
    """
    places = _places(points, lat, lon, severity)
    c, t = _refined(cover, places, cell).alias("c"), _targets(places, cell).alias("t")
    on = [F.col(f"c.{k}") == F.col(f"t.{k}") for k in ("level", "cell_x", "cell_y", "whole")]
    hit = F.when(F.col("c.whole"), F.lit(True)).otherwise(_inside(F.col("c.near"), F.col("c.base"), F.col("t.lon"), F.col("t.lat")))
    return c.join(t, [*on, hit]).groupBy("c.area_id").agg(F.sum("t.n").alias("crashes"), F.max("t.worst").alias("max_severity"))
