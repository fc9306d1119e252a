"""Points in polygons by the cell cover equal a plain ray test of every point against every edge."""

import json
import random

import pytest
from pyspark.sql import functions as F

from roadbook.operators import areas as A

POINTS = "pid long, lat double, lon double"
AREAS = f"area_id string, rings {A.RINGS}"


def odd(rings, x, y):
    n = 0
    for r in rings:
        r = r if r[0] == r[-1] else [*r, r[0]]
        for a, b in zip(r, r[1:]):
            (x1, y1), (x2, y2) = sorted((a, b), key=lambda p: (p[1], p[0]))
            if (y1 > y) != (y2 > y):
                n += x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return n % 2 == 1


def star(rng, x, y, size, corners):
    """A concave ring: corners around a centre at changing distances."""
    import math
    return [(x + size * rng.uniform(0.2, 1) * math.cos(2 * math.pi * k / corners),
             y + size * rng.uniform(0.2, 1) * math.sin(2 * math.pi * k / corners)) for k in range(corners)]


def hits(spark, points, areas, **more):
    cover = A.cell_cover(spark.createDataFrame(areas, AREAS), cell=more.get("cell", A.CELL))
    got = A.locate(spark.createDataFrame(points, POINTS), cover, "lat", "lon", **more)
    return sorted((r.pid, r.area_id) for r in got.collect())


@pytest.mark.parametrize("cell", [0.003, 0.01, 0.5])
def test_concave_areas_with_holes_and_parts(spark, cell):
    rng = random.Random(3)
    areas = [(f"a{k}", [star(rng, rng.uniform(-75.1, -75), rng.uniform(39.9, 40), rng.uniform(0.005, 0.06), rng.randint(3, 40))
                        for _ in range(rng.randint(1, 3))]) for k in range(25)]
    points = [(i, rng.uniform(39.85, 40.05), rng.uniform(-75.15, -74.95)) for i in range(1500)]
    # corners, places on edges and on cell borders
    points += [(5000 + i, y, x) for i, (x, y) in enumerate(p for _, rings in areas for r in rings for p in r)]
    points += [(9000 + i, 39.9 + 0.01 * (i % 10), -75.1 + 0.01 * (i // 10)) for i in range(100)]
    want = sorted((i, a) for i, y, x in points for a, rings in areas if odd(rings, x, y))
    assert len(want) > 500
    assert hits(spark, points, areas, cell=cell) == want


def test_each_point_of_a_tiling_has_one_area(spark):
    rng = random.Random(5)
    at = [[(-75.1 + 0.02 * i + rng.uniform(-0.008, 0.008) * (0 < i < 5), 39.9 + 0.02 * j + rng.uniform(-0.008, 0.008) * (0 < j < 5))
           for i in range(6)] for j in range(6)]
    areas = []
    for j in range(5):
        for i in range(5):
            ring = [at[j][i], at[j][i + 1], at[j + 1][i + 1], at[j + 1][i]]
            areas.append((f"{i},{j}", [ring if (i + j) % 2 else ring[::-1]]))
    points = []
    for j in range(5):
        for i in range(5):     # shared corners and points on shared edges
            (x1, y1), (x2, y2) = at[j][i], at[j][i + 1]
            points += [(len(points) + k, y1 + (y2 - y1) * k / 7, x1 + (x2 - x1) * k / 7) for k in range(7) if j]
    points += [(10_000 + i, rng.uniform(39.9001, 39.9999), rng.uniform(-75.0999, -75.0001)) for i in range(800)]
    got = hits(spark, points, areas)
    assert [p for p, _ in got] == sorted(p for p, _, _ in points)


def test_points_on_the_boundary(spark):
    square = [("s", [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]]), ("t", [[(1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0)]])]
    points = [(1, 0.0, 0.0), (2, 1.0, 1.0), (3, 0.5, 1.0), (4, 0.5, 0.5), (5, 1.0, 0.25), (6, 1.0000001, 0.5), (7, 0.5, 2.0)]
    assert hits(spark, points, square, boundary=True) == [(1, "s"), (2, "s"), (2, "t"), (3, "s"), (3, "t"), (4, "s"), (5, "s"), (7, "t")]
    assert hits(spark, points, square) == [(1, "s"), (3, "t"), (4, "s")]


def test_missing_and_broken_rows(spark):
    square = [(0.0, 0.0), (0.05, 0.0), (0.05, 0.05), (0.0, 0.05), (0.0, 0.0)]
    areas = [("ok", [square]), ("ok", [[(0.1, 0.1), (0.15, 0.1), (0.1, 0.15)]]), (None, [square]), ("null", None), ("line", [square[:2]]),
             ("empty", []), ("hole", [square, None]), ("nan", [[*square, (float("nan"), 0.0)]]), ("corner", [[*square, None]])]
    points = [(1, 0.02, 0.02), (1, 0.02, 0.02), (2, None, 0.02), (3, 0.02, None), (4, float("nan"), 0.02), (5, 0.02, float("inf")),
              (6, 0.11, 0.11), (7, 50.0, 50.0), (None, 0.02, 0.02)]
    cover = A.cell_cover(spark.createDataFrame(areas, AREAS))
    df = spark.createDataFrame(points, POINTS).withColumn("near", F.lit("x")).withColumn("cell_x", F.lit(1))
    got = A.locate(df, cover, "lat", "lon")
    assert got.columns == ["pid", "lat", "lon", "near", "cell_x", "area_id"]
    assert sorted(((r.pid, r.area_id) for r in got.collect()), key=str) == [
        (1, "hole"), (1, "hole"), (1, "ok"), (1, "ok"), (6, "ok"), (None, "hole"), (None, "ok")]
    kept = A.filter_areas(df, cover, "lat", "lon")
    assert kept.columns == df.columns
    assert sorted((r.pid for r in kept.collect()), key=str) == [1, 1, 2, 6, None]
    assert sorted((r.pid for r in A.filter_areas(df, cover, "lat", "lon", keep_missing=False).collect()), key=str) == [1, 1, 6, None]
    assert A.locate(df.limit(0), cover, "lat", "lon").count() == 0
    assert A.locate(df, A.cell_cover(spark.createDataFrame([], AREAS)), "lat", "lon").count() == 0
    with pytest.raises(ValueError):
        A.locate(df.withColumnRenamed("near", "Area_ID"), cover, "lat", "lon")


def test_geojson(spark):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    texts = [json.dumps({"type": "Polygon", "coordinates": [ring, ring]}), json.dumps({"type": "MultiPolygon", "coordinates": [[ring], [ring, ring]]}),
             json.dumps({"type": "Point", "coordinates": [0, 0]}), "torn {", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", A.rings_from_geojson("t").cast(A.RINGS).alias("r"))
    assert [None if r.r is None else len(r.r) for r in got.orderBy("i").collect()] == [2, 3, None, None, None]
    assert [tuple(p) for p in got.orderBy("i").first().r[0]] == [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]


def test_points_meet_cells_by_an_equi_join(spark):
    from roadbook.plans import registry
    plan = registry.QUERIES["area_polygons"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "HashJoin" in plan or "SortMergeJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def crowd(rng):
    """Points at all densities: even ones, one crowded block, one very crowded corner and one place with many points."""
    xy = [(rng.uniform(-75.1, -75), rng.uniform(39.9, 40)) for _ in range(600)]
    xy += [(rng.uniform(-75.05, -75.04), rng.uniform(39.95, 39.96)) for _ in range(600)]
    xy += [(rng.uniform(-75.0448, -75.0447), rng.uniform(39.9533, 39.9534)) for _ in range(400)] + [(-75.0447, 39.9533)] * 300
    return [(i, y, x, rng.choice([None, 1, 2, 3, 4])) for i, (x, y) in enumerate(xy)] + [(-1, None, -75.0, 9), (-2, 39.95, float("nan"), 9)]


@pytest.mark.parametrize("crowded", [3, 40, 256])
def test_totals_at_all_densities(spark, monkeypatch, crowded):
    monkeypatch.setattr(A, "CROWD", crowded)
    rng = random.Random(11)
    points = crowd(rng)
    areas = [(f"a{k}", [star(rng, rng.uniform(-75.07, -75.02), rng.uniform(39.94, 39.97), rng.choice([0.0002, 0.004, 0.03]), rng.randint(3, 20))
                        for _ in range(rng.randint(1, 2))]) for k in range(20)]
    # areas with edges within the most crowded corner
    areas += [(f"b{k}", [star(rng, -75.04475, 39.95335, 0.00008 * (k + 1), 9)]) for k in range(5)] + [("far", [star(rng, 10, 10, 0.1, 5)])]
    want = {}
    for a, rings in areas:
        inside = [s for _, y, x, s in points if y is not None and x == x and odd(rings, x, y)]
        if inside:
            want[a] = (len(inside), max((s for s in inside if s is not None), default=None))
    assert len(want) > 10
    df = spark.createDataFrame(points, "pid long, DEC_LATITUDE double, DEC_LONGITUDE double, MAX_SEVERITY_LEVEL int")
    got = A.area_totals(df, A.cell_cover(spark.createDataFrame(areas, AREAS)))
    assert dict(got.dtypes) == {"area_id": "string", "crashes": "bigint", "max_severity": "int"}
    assert {r.area_id: (r.crashes, r.max_severity) for r in got.collect()} == want


def test_totals_do_not_pair_points_with_areas(spark):
    """Rows that the join of ``area_totals`` meets: 20 large areas over 4,000 points, 1,500 of them at one place."""
    rng = random.Random(2)
    xy = [(rng.uniform(-75.1, -75), rng.uniform(39.9, 40)) for _ in range(500)] + [(-75.043, 39.951)] * 1500
    xy += [(rng.uniform(-75.06, -75.05), rng.uniform(39.95, 39.96)) for _ in range(2000)]
    df = spark.createDataFrame([(i, y, x, 1) for i, (x, y) in enumerate(xy)], "pid long, DEC_LATITUDE double, DEC_LONGITUDE double, MAX_SEVERITY_LEVEL int")
    areas = [(f"a{k}", [star(rng, -75.05, 39.95, 0.05, 12)]) for k in range(20)]
    cover = A.cell_cover(spark.createDataFrame(areas, AREAS))
    totals = A.area_totals(df, cover)
    pairs = A.locate(df, cover).count()
    totals.collect()

    def joined(plan):
        found = [plan] if "Join" in plan.nodeName() and "INNER" in plan.toString().split("\n")[0].upper() else []
        if plan.nodeName() == "AdaptiveSparkPlan":
            return joined(plan.executedPlan())
        if plan.nodeName().endswith("QueryStage"):
            return joined(plan.plan())
        kids = plan.children()
        return found + [x for i in range(kids.size()) for x in joined(kids.apply(i))]

    joins = joined(totals._jdf.queryExecution().executedPlan())
    assert joins
    rows = sum(j.metrics().apply("numOutputRows").value() for j in joins)
    assert pairs > 20_000 and rows < pairs / 5
