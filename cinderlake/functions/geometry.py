"""Planar geometry on rings held as `array<array<struct<x,y>>>` and on edge structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cinderlake.functions.parsing import as_column, snap


def ring_edges(ring: Column) -> Column:
    """Edges `struct<x1,y1,x2,y2>` between consecutive vertices of one ring."""
    heads = F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0)))
    tails = F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0)))
    return F.zip_with(heads, tails, lambda a, b: F.struct(
        a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))


def polygon_edges(rings: Column | str) -> Column:
    """Edges of all rings of one polygon."""
    return F.flatten(F.transform(as_column(rings), ring_edges))


def on_edge(x: Column, y: Column, e: Column) -> Column:
    """True when the point lies on the edge, its ends included."""
    cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    return (
        (cross == 0)
        & (x >= F.least(e["x1"], e["x2"])) & (x <= F.greatest(e["x1"], e["x2"]))
        & (y >= F.least(e["y1"], e["y2"])) & (y <= F.greatest(e["y1"], e["y2"]))
    )


def crosses(x: Column, y: Column, e: Column) -> Column:
    """True when a ray from the point towards +x crosses the edge (half-open in y)."""
    straddles = (e["y1"] > y) != (e["y2"] > y)
    at_x = e["x1"] + F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"])
    return straddles & (x < at_x)


def covers(x: Column, y: Column, edges: Column) -> Column:
    """Even-odd test over the edges; the border belongs to the polygon, holes do not.

    One walk over the edges: an edge below or above the point costs a comparison only.
    """
    state = F.struct(F.lit(False).alias("inside"), F.lit(False).alias("border"))
    walked = F.aggregate(edges, state, lambda acc, e: F.struct(
        (acc["inside"] != F.coalesce(crosses(x, y, e), F.lit(False))).alias("inside"),
        (acc["border"] | on_edge(x, y, e)).alias("border")))
    return walked["inside"] | walked["border"]


def signed_area(ring: Column) -> Column:
    """Shoelace area of one ring, positive when counter-clockwise."""
    start = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("twice"), F.lit(False).alias("on"))
    walked = F.aggregate(ring, start, lambda at, v: F.struct(
        v["x"].alias("x"), v["y"].alias("y"),
        F.when(at["on"], at["twice"] + (at["x"] * v["y"] - v["x"] * at["y"])).otherwise(at["twice"]).alias("twice"),
        F.lit(True).alias("on")))
    return walked["twice"] / 2


def polygon_area(rings: Column | str) -> Column:
    """Area of the outer ring less the areas of the holes."""
    rings = as_column(rings)
    outer = F.abs(signed_area(F.get(rings, F.lit(0))))
    holes = F.when(F.size(rings) > 1, F.aggregate(
        F.slice(rings, 2, F.size(rings) - 1), F.lit(0.0), lambda acc, r: acc + F.abs(signed_area(r))))
    return outer - F.coalesce(holes, F.lit(0.0))


def snap_rings(rings: Column | str, grid: float = 1e-5) -> Column:
    """Every vertex moved to the grid."""
    return F.transform(as_column(rings), lambda ring: F.transform(ring, lambda v: F.struct(
        snap(v["x"], grid).alias("x"), snap(v["y"], grid).alias("y"))))


def closed_rings(rings: Column | str) -> Column:
    """True when there is a ring, and every ring has at least four vertices and ends where it starts."""
    rings = as_column(rings)
    closed = F.forall(rings, lambda r: (F.size(r) >= 4) & r[0].eqNullSafe(F.element_at(r, -1)))
    return F.coalesce((F.size(rings) > 0) & closed, F.lit(False))


def enclosed_area(rings: Column | str) -> Column:
    """Area of well-formed rings that enclose something; NULL for anything else, which stands for
    an empty or invalid shape. Self-intersection is not checked."""
    area = F.when(closed_rings(rings), polygon_area(rings))
    return F.nullif(area, F.lit(0.0))


def box(edges: Column) -> Column:
    """Bounding box `struct<x_min,y_min,x_max,y_max>` of an edge array."""
    def low(a, b):
        return F.array_min(F.transform(edges, lambda e: F.least(e[a], e[b])))

    def high(a, b):
        return F.array_max(F.transform(edges, lambda e: F.greatest(e[a], e[b])))

    return F.struct(low("x1", "x2").alias("x_min"), low("y1", "y2").alias("y_min"),
                    high("x1", "x2").alias("x_max"), high("y1", "y2").alias("y_max"))
