"""Unions, polygon faults and outlines against brute force."""

import math
import random

import pytest

from cinderlake.operators import outlines, overlay
from cinderlake.plans import perimeters

RINGS = "array<array<struct<x:double,y:double>>>"


def points(*pairs):
    return [{"x": float(x), "y": float(y)} for x, y in pairs]


def closed(*pairs):
    return points(*pairs, pairs[0])


def slab_area(parts):
    """Area of a union by slabs between all heights of points and crossings."""
    edges = []
    for rings in parts:
        for k, ring in enumerate(rings):
            ring = [(p["x"], p["y"]) for p in ring]
            twice = sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:]))
            if (twice > 0) != (k == 0):
                ring = ring[::-1]
            edges += [(*p, *q) for p, q in zip(ring, ring[1:]) if p[1] != q[1] and twice]
    slope = [(e[2] - e[0]) / (e[3] - e[1]) for e in edges]
    heights = {e[k] for e in edges for k in (1, 3)}
    for i, a in enumerate(edges):
        for j, b in enumerate(edges[:i]):
            if slope[i] != slope[j]:
                y = ((b[0] - slope[j] * b[1]) - (a[0] - slope[i] * a[1])) / (slope[i] - slope[j])
                if all(min(e[1], e[3]) < y < max(e[1], e[3]) for e in (a, b)):
                    heights.add(y)
    heights, area = sorted(heights), 0.0
    for low, high in zip(heights, heights[1:]):
        mid, wound = (low + high) / 2, 0
        hits = sorted((e[0] + s * (mid - e[1]), -1 if e[3] > e[1] else 1) for e, s in zip(edges, slope) if min(e[1], e[3]) < mid < max(e[1], e[3]))
        for (x, turn), (onward, _) in zip(hits, hits[1:]):
            wound += turn
            area += (onward - x) * (high - low) if wound > 0 else 0
    return area


def invented_parts(rng, snap):
    def at(v):
        return float(round(v)) if snap else v

    parts = []
    for _ in range(rng.randint(1, 12)):
        x, y, r, kind = rng.uniform(-5, 9), rng.uniform(-5, 9), rng.uniform(1, 4), rng.random()
        if kind < 0.5:
            turns = sorted(rng.uniform(0, 6.28) for _ in range(rng.randint(3, 7)))
            rings = [closed(*[(at(x + r * math.cos(t)), at(y + r * math.sin(t))) for t in turns])]
        else:
            left, low, side = at(x), at(y), at(r)
            rings = [closed((left, low), (left + side, low), (left + side, low + side), (left, low + side))]
            if kind > 0.7:
                rings.append(closed((left + side / 4, low + side / 4), (left + side / 2, low + side / 4), (left + side / 4, low + side / 2)))
        parts.append([ring[::-1] if rng.random() < 0.5 else ring for ring in rings])
    return parts


def test_union_areas_of_overlapping_parts(spark):
    rng = random.Random(3)
    fires = {f: invented_parts(rng, f % 3 == 0) for f in range(40)}
    fires[40] = [[closed((0, 0), (4, 0), (4, 4), (0, 4))]] * 3
    fires[None] = fires[1]
    rows = [(f, n, rings) for f, parts in fires.items() for n, rings in enumerate(parts)]
    found = {r["fire_id"]: r["area"] for r in overlay.union_areas(spark.createDataFrame(rows, f"fire_id long, part int, rings {RINGS}")).collect()}
    assert found[40] == 16
    for fire, parts in fires.items():
        assert found.get(fire, 0.0) == pytest.approx(slab_area(parts), rel=1e-9, abs=1e-12)


def test_one_fire_of_very_many_parts(spark):
    # A hundred bands across a hundred others: all but the gaps between them.
    bands = [closed((0, k), (100, k), (100, k + 0.5), (0, k + 0.5)) for k in range(100)]
    bands += [closed((k, 0), (k + 0.5, 0), (k + 0.5, 100), (k, 100)) for k in range(100)]
    parts = spark.createDataFrame([(1, n, [b]) for n, b in enumerate(bands)], f"fire_id long, part int, rings {RINGS}")
    assert overlay.union_areas(parts).collect()[0]["area"] == pytest.approx(7500, rel=1e-12)


FAULTS = {
    "square": ([closed((0, 0), (4, 0), (4, 4), (0, 4))], None),
    "hole": ([closed((0, 0), (4, 0), (4, 4), (0, 4)), closed((1, 1), (2, 1), (1, 2))], None),
    "hole in a corner": ([closed((0, 0), (4, 0), (4, 4), (0, 4)), closed((0, 0), (2, 1), (1, 2))], None),
    "repeated point": ([closed((0, 0), (0, 0), (4, 0), (4, 4))], None),
    "spiral": ([closed((0, 0), (9, 0), (9, 9), (1, 9), (1, 2), (7, 2), (7, 7), (3, 7), (3, 4), (5, 4), (5, 5), (4, 5), (4, 6), (6, 6), (6, 3), (2, 3), (2, 8), (8, 8), (8, 1), (0, 1))], None),
    "bow-tie": ([closed((0, 0), (4, 4), (4, 0), (0, 5))], "crossing"),
    "touching": ([closed((0, 0), (2, 2), (4, 0), (4, 4), (2, 2), (0, 4))], "crossing"),
    "spike": ([closed((0, 0), (4, 0), (8, 0), (4, 0), (4, 4))], "crossing"),
    "crossing hole": ([closed((0, 0), (4, 0), (4, 4), (0, 4)), closed((1, 1), (6, 1), (1, 2))], "crossing"),
    "line": ([closed((0, 0), (1, 1), (2, 2))], "flat"),
    "open": ([points((0, 0), (4, 0), (4, 4), (1, 1))], "open"),
    "nothing": ([], "open"),
    "far": ([closed((3e9, 3e9), (3e9 + 4, 3e9 + 4), (3e9 + 4, 3e9), (3e9, 3e9 + 5))], "crossing"),
}


def test_faults(spark):
    parts = spark.createDataFrame([(name, rings) for name, (rings, _) in FAULTS.items()], f"name string, rings {RINGS}")
    found = {r["name"]: r["fault"] for r in overlay.ring_faults(parts, ["name"]).collect()}
    assert found == {name: fault for name, (_, fault) in FAULTS.items() if fault}


def test_perimeters_of_a_fact(spark):
    square, shifted, bow = closed((0, 0), (4, 0), (4, 4), (0, 4)), closed((2, 0), (6, 0), (6, 4), (2, 4)), FAULTS["bow-tie"][0][0]
    parts = spark.createDataFrame([(1, 1, [square]), (1, 2, [shifted]), (1, 2, [bow]), (2, 1, [bow]), (None, 1, [square])], f"fire_id long, part int, rings {RINGS}")
    fact = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    found = sorted(map(tuple, perimeters.attach_united(fact, parts).collect()))
    assert found == [(1, 2, pytest.approx(24.0)), (2, None, None), (3, None, None)]


def test_outlines(spark):
    units = {
        "ring": [(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)], "touch": [(0, 0), (1, 1)],
        "two": [(0, 0), (5, 5), (6, 5)], "gaps": [(x, y) for x in range(4) for y in range(4) if (x, y) not in ((1, 1), (2, 2))],
        "long": [(x, 0) for x in range(300)]}
    squares = [(unit, [closed((x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1))]) for unit, cells in units.items() for x, y in cells]
    frame = spark.createDataFrame(squares, f"code string, rings {RINGS}")
    found = {}
    for r in outlines.outline_rings(frame, "code").collect():
        assert r["ring"][0] == r["ring"][-1] and r["hole"] == (r["area"] < 0)
        found.setdefault(r["code"], []).append((r["area"], len(r["ring"])))
    assert {u: sorted(v) for u, v in found.items()} == {
        "ring": [(-1.0, 5), (9.0, 13)], "touch": [(1.0, 5), (1.0, 5)], "two": [(1.0, 5), (2.0, 7)], "gaps": [(-2.0, 9), (16.0, 17)], "long": [(300.0, 603)]}
    assert outlines.unit_outlines(frame.limit(0), "code").count() == 0


def test_small_shapes_need_no_grid(spark, monkeypatch):
    """Cell by cell gives the same as in one row, and is not used for shapes of few edges."""
    rng = random.Random(5)
    rows = [(f, n, rings) for f in range(12) for n, rings in enumerate(invented_parts(rng, f % 2 == 0)[:5])]
    hole = closed((0, 0), (4, 0), (4, 4), (0, 4))
    rows += [(None, 1, [hole]), (20, 1, [hole, hole])]
    parts = spark.createDataFrame(rows, f"fire_id long, part int, rings {RINGS}")
    cells = {r["fire_id"]: r["area"] for r in overlay._grid_unions(parts, "fire_id").collect()}
    named = spark.createDataFrame([(name, rings) for name, (rings, _) in FAULTS.items() if name != "far"], f"name string, rings {RINGS}")

    def grid(*_):
        raise AssertionError("cut at a grid")

    monkeypatch.setattr(overlay, "cut_edges", grid)
    found = {r["fire_id"]: r["area"] for r in overlay.union_areas(parts).collect()}
    assert found == {fire: pytest.approx(area, rel=1e-9) for fire, area in cells.items()} and 20 not in found
    faults = {r["name"]: r["fault"] for r in overlay.ring_faults(named, ["name"]).collect()}
    assert faults == {name: fault for name, (_, fault) in FAULTS.items() if fault and name != "far"}


def test_stars_and_rounds(spark):
    star = [(math.cos(2.4 * math.pi * k / 3), math.sin(2.4 * math.pi * k / 3)) for k in range(5)]
    shapes = {"star": [closed(*star)], "round": [closed(*[(9 * math.cos(k), 9 * math.sin(k)) for k in range(6)])]}
    parts = spark.createDataFrame([*shapes.items()], f"name string, rings {RINGS}")
    assert [tuple(r) for r in overlay.ring_faults(parts, ["name"]).collect()] == [("star", "crossing")]


def test_perimeters_of_a_year_need_no_grid(spark, monkeypatch):
    squares = [closed((k, 0), (k + 4, 0), (k + 4, 4), (k, 4)) for k in range(3)]
    parts = spark.createDataFrame([(f, n, [s]) for f in (1, 2, 3) for n, s in enumerate(squares)], f"fire_id long, part int, rings {RINGS}")
    fact = spark.sql("SELECT id, year, cast(day AS timestamp_ntz) AS ts FROM VALUES (1L, 1999, '1999-05-01'), (2L, 1999, '1999-07-01'), (3L, 1998, '1998-07-01') v(id, year, day)")
    monkeypatch.delattr(overlay, "cut_edges")
    found = perimeters.perimeters_since(fact, parts, 1999, "1999-06-01").select("id", "perimeter_parts", "perimeter_area").collect()
    assert [tuple(r) for r in found] == [(2, 3, pytest.approx(24.0))]


def test_parts_are_snapped_and_shapes_counted_once(spark, monkeypatch, capsys):
    """Usable parts are read as they were written; edges are counted of shapes of many points only."""
    squares = [closed((k, 0), (k + 4, 0), (k + 4, 4), (k, 4.000001)) for k in range(20)]
    parts = spark.createDataFrame([(f, n, [s]) for f, many in ((1, 20), (2, 3)) for n, s in enumerate(squares[:many])], f"fire_id long, part int, rings {RINGS}")
    usable = perimeters.usable_parts(parts)
    usable.explain()
    assert "rint" not in capsys.readouterr().out.lower()
    assert {v["y"] for r in usable.collect() for v in r["rings"][0]} == {0.0, 4.0}
    monkeypatch.delattr(overlay, "cut_edges")  # twenty squares have eighty edges, but forty that are not level
    assert {r["fire_id"]: r["area"] for r in overlay.union_areas(usable).collect()} == {1: pytest.approx(92.0), 2: pytest.approx(24.0)}
    monkeypatch.delattr(overlay.g, "polygon_edges")
    assert [r["area"] for r in overlay.union_areas(usable.filter("fire_id = 2")).collect()] == [pytest.approx(24.0)]
