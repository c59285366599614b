import math
import random

import pytest
from pyspark.sql import functions as F

from cinderlake.functions import geometry as g
from cinderlake.operators import spatial as sp

RINGS = "array<array<struct<x:double,y:double>>>"


def square(x, y, w=1.0, h=1.0):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


# two squares sharing an edge, one with a hole, one in two parts
PARISHES = [
    ("010101", [square(0.0, 0.0)]),
    ("010102", [square(1.0, 0.0)]),
    ("010201", [square(0.0, 1.0), square(0.25, 1.25, 0.5, 0.5)]),
    ("020101", [square(3.0, 0.0)]),
    ("020101", [square(4.0, 0.0)]),
]
POINTS = {
    "inside": (0.5, 0.5, ["010101"]), "shared edge": (1.0, 0.5, ["010101", "010102"]),
    "corner": (1.0, 1.0, ["010101", "010102", "010201"]), "hole": (0.5, 1.5, []), "hole border": (0.25, 1.5, ["010201"]),
    "beside hole": (0.1, 1.5, ["010201"]), "second part": (4.5, 0.5, ["020101"]), "part border": (4.0, 0.5, ["020101"]),
    "outside": (9.0, 9.0, []), "level with vertices": (-1.0, 1.0, []), "no coordinates": (None, 0.5, []),
}


@pytest.fixture
def parishes(spark):
    return spark.createDataFrame(PARISHES, f"code string, rings {RINGS}")


@pytest.fixture
def points(spark):
    return spark.createDataFrame([(n, x, y) for n, (x, y, _) in POINTS.items()], "name string, lon double, lat double")


@pytest.mark.parametrize("cell", [0.3, 1.0, 7.0])
@pytest.mark.parametrize("limit", [0, sp.BROADCAST_BYTES])
def test_points_in_polygons(points, parishes, rows, cell, limit):
    hits = sp.points_in_polygons(points, parishes, x="lon", y="lat", cell=cell, broadcast_bytes=limit)
    assert rows(hits, "name", "id_rel_lau") == sorted((n, c) for n, (_, _, codes) in POINTS.items() for c in codes)


def test_first_match_only(points, parishes, rows):
    hits = sp.points_in_polygons(points, parishes, x="lon", y="lat", cell=1.0, tie="first", key="name")
    assert rows(hits, "name", "id_rel_lau") == sorted((n, min(c)) for n, (_, _, c) in POINTS.items() if c)


def test_random_triangles_against_half_planes(spark, rows):
    rnd = random.Random(5)
    shapes = []
    for i in range(12):
        a, b, c = [(rnd.uniform(-5, 5), rnd.uniform(-5, 5)) for _ in range(3)]
        shapes.append((f"t{i}", [[a, b, c, a]]))
    pts = [(i, rnd.uniform(-5, 5), rnd.uniform(-5, 5)) for i in range(300)]

    def side(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    want = []
    for i, x, y in pts:
        for name, [[a, b, c, _]] in shapes:
            s = [side(a, b, (x, y)), side(b, c, (x, y)), side(c, a, (x, y))]
            if min(s) >= 0 or max(s) <= 0:
                want.append((i, name))
    df = spark.createDataFrame(pts, "i int, lon double, lat double")
    polys = spark.createDataFrame(shapes, f"code string, rings {RINGS}")
    hits = sp.points_in_polygons(df, polys, x="lon", y="lat", cell=0.8)
    assert sorted((r["i"], r["id_rel_lau"]) for r in hits.collect()) == sorted(want)


def test_broadcast_only_when_measured_small(points, parishes):
    small = sp.points_in_polygons(points, parishes, x="lon", y="lat", cell=1.0)
    assert "broadcast" in small._jdf.queryExecution().optimizedPlan().toString()
    large = sp.points_in_polygons(points, parishes, x="lon", y="lat", cell=1.0, broadcast_bytes=0)
    assert "strategy=broadcast" not in large._jdf.queryExecution().optimizedPlan().toString()


def test_dissolved_outline(parishes, rows):
    units = parishes.withColumn("unit", F.substring("code", 1, 2))
    edges = sp.dissolved_edges(units, "unit")
    length = edges.groupBy("code").agg(F.sum(F.abs(F.col("x2") - F.col("x1")) + F.abs(F.col("y2") - F.col("y1"))).alias("l"))
    # L-shape of three squares (8) with a hole (2); two squares side by side (6)
    assert rows(length, "code", "l") == [("01", 10.0), ("02", 6.0)]


def test_perimeters(spark, rows):
    parts = [
        (1, 0, [square(0.0, 0.0, 2.0, 2.0)]), (1, 1, [square(5.0, 5.0)]), (2, 0, []), (2, 1, [square(0.0, 0.0, 2.0, 0.0)]),
        (3, 0, [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]]), (4, 0, [square(0.0, 0.0, 4.0, 4.0), square(1.0, 1.0)]),
        (5, 0, None), (6, 0, [[(0.0, 0.0), (1e-7, 0.0), (1e-7, 1e-7), (0.0, 0.0)]]),
    ]
    df = spark.createDataFrame(parts, f"fire_id int, part int, rings {RINGS}")
    good = sp.perimeter_parts(df)
    assert rows(good.withColumn("area", F.round("area", 9)), "fire_id", "part", "area") == [(1, 0, 4.0), (1, 1, 1.0), (4, 0, 15.0)]
    fact = spark.createDataFrame([(1,), (2,), (4,)], "id int")
    attached = sp.attach_perimeters(fact, good).withColumn("perimeter_area", F.round("perimeter_area", 9))
    assert rows(attached, "id", "perimeter_parts", "perimeter_area") == [
        (1, 2, 5.0), (2, None, None), (4, 1, 15.0)]


def test_ring_area_sign(spark):
    df = spark.createDataFrame([([square(0.0, 0.0, 2.0, 3.0)],)], f"rings {RINGS}")
    assert df.select(g.signed_area(F.col("rings")[0]), g.polygon_area("rings")).first() == (6.0, 6.0)


def test_weather_cell(spark):
    df = spark.createDataFrame([(37.315, -8.3042)], "lat double, lon double")
    row = sp.snap_to_weather_cell(df, 0.25).first()
    assert (row["cell_lat"], row["cell_lon"]) == (37.25, -8.25)


@pytest.mark.parametrize("bucket", [None, 0.5, 40.0])
def test_nearest_station(spark, bucket):
    rnd = random.Random(3)
    stations = [(f"s{i}", rnd.uniform(0, 10), rnd.uniform(0, 10)) for i in range(15)]
    pts = [(i, rnd.uniform(-30, 40), rnd.uniform(-5, 15)) for i in range(60)]
    df = spark.createDataFrame(pts, "id int, lon double, lat double")
    st = spark.createDataFrame(stations, "station string, lon double, lat double")
    got = {r["id"]: (r["station"], r["distance"]) for r in sp.nearest_station(df, st, key="id", bucket=bucket).collect()}
    assert len(got) == len(pts)
    for i, x, y in pts:
        d, name = min((math.dist((x, y), (sx, sy)), s) for s, sx, sy in stations)
        assert got[i][0] == name and got[i][1] == pytest.approx(d)


def test_border_points_at_the_default_cell(spark):
    ring = [(1.0, 1.0), (1.7, 1.0), (1.7, 3.4), (1.0, 3.4), (1.0, 1.0)]
    shapes = spark.createDataFrame([("a", [[{"x": x, "y": y} for x, y in ring]])], f"code string, rings {RINGS}")
    points = [(0, 1.7, 1.5), (1, 1.0, 3.4), (2, 1.3, 1.0), (3, 1.7, 3.4), (4, 1.8, 1.5)]
    df = spark.createDataFrame(points, "id int, lon double, lat double")
    for cell in (0.1, 0.25, 0.3, 1.0):
        got = sp.points_in_polygons(df, shapes, x="lon", y="lat", cell=cell)
        assert sorted(r["id"] for r in got.collect()) == [0, 1, 2, 3], cell


def test_first_match_per_year_and_id(spark):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    shapes = spark.createDataFrame([(c, [[{"x": x, "y": y} for x, y in ring]]) for c in "ab"], f"code string, rings {RINGS}")
    df = spark.createDataFrame([(2001, "i", 0.5, 0.5), (2002, "i", 0.5, 0.5)], "ANO int, id string, lon double, lat double")
    got = sp.points_in_polygons(df, shapes, x="lon", y="lat", cell=0.1, tie="first", key=["ANO", "id"])
    assert sorted((r["ANO"], r["id_rel_lau"]) for r in got.collect()) == [(2001, "a"), (2002, "a")]


def test_nearest_station_with_missing_and_crowded_coordinates(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 1e5 - 100, 0.0), (3, float("nan"), 0.0), (4, None, 1.0)], "id int, lon double, lat double")
    stations = [("s1", 0.0, 0.0), ("s3", 1e5, 0.0), ("s4", float("nan"), 1.0)] + [(f"t{k}", 5e4 + k * 1e-9, 0.0) for k in range(60)]
    got = {r["id"]: r["station"] for r in sp.nearest_station(points, spark.createDataFrame(stations, "station string, lon double, lat double"), key="id").collect()}
    assert got == {1: "s1", 2: "s3"}


def test_equal_parts_of_a_perimeter_count_once(spark):
    ring = [[{"x": x, "y": y} for x, y in [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]]]
    parts = spark.createDataFrame([(1, 1, ring), (1, 2, ring), (2, 1, ring)], f"fire_id int, part int, rings {RINGS}")
    assert sorted((r["fire_id"], r["part"]) for r in sp.perimeter_parts(parts).collect()) == [(1, 1), (2, 1)]


def test_nearest_station_holds_no_row_for_each_pair(spark, monkeypatch):
    """Two thousand points beside three hundred stations of one bucket: rows for points and arrays only."""
    monkeypatch.setattr(sp, "TOGETHER", 50)
    stations = [(f"s{k:03}", math.cos(k), math.sin(k)) for k in range(300)]
    points = [(k, math.cos(k / 7) * 2, math.sin(k / 7) * 2) for k in range(2000)]
    met = []

    def seen(df):
        if "hit" in df.columns:
            plan = df._jdf.queryExecution().optimizedPlan()
            met.append("collect_list" in plan.toString())
        return sp_cut(df)

    sp_cut = sp.cut_lineage
    monkeypatch.setattr(sp, "cut_lineage", seen)
    near = sp.nearest_station(spark.createDataFrame(points, "id long, lon double, lat double"),
                              spark.createDataFrame(stations, "station string, lon double, lat double"), key="id", bucket=10.0)
    got = {r["id"]: r["station"] for r in near.collect()}
    want = {k: min((math.sqrt((x - a) ** 2 + (y - b) ** 2), s) for s, a, b in stations)[1] for k, x, y in points}
    assert got == want and met and all(met)
