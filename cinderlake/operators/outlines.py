"""Outlines of dissolved units as closed rings.

Border edges have the inside to their left. Each edge is followed by the edge that bounds the same
corner of the inside, and rings are found by pointer doubling: every round an edge looks twice as far
ahead, so a ring of any length takes a logarithmic number of joins on edge numbers, and no unit is
gathered in one place. A ring becomes one row only when it is written as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlake.operators import overlay
from cinderlake.session import staged

ENDS = ["x1", "y1", "x2", "y2"]


def border_edges(polygons: DataFrame, code: str, rings: str = "rings") -> DataFrame:
    """`code, x1, y1, x2, y2`: edges of the border of each unit, the inside to the left.

    Members have to meet in common vertices and not to overlap; the edges they share cancel.
    """
    net = overlay.directed_edges(polygons, code, rings)
    up = F.col("n") > 0
    turned = [F.when(up, F.col(a)).otherwise(F.col(b)).alias(a) for a, b in zip(ENDS, ENDS[2:] + ENDS[:2], strict=True)]
    return net.select(F.col(code).alias("code"), *turned)


def followed(edges: DataFrame) -> DataFrame:
    """`edge, code, x1, y1, x2, y2, next`: numbered edges, and the edge that follows each.

    Where several edges leave a point, the first one clockwise from the way back is taken: the corner
    between the two belongs to the inside, so parts that meet in a point only have rings of their own.
    """
    numbered = staged(edges.select(F.monotonically_increasing_id().alias("edge"), "code", *ENDS), "border-edges")
    leaving = numbered.select(F.col("edge").alias("next"), F.col("code").alias("_code"), F.col("x1").alias("_x"), F.col("y1").alias("_y"),
                              (F.col("x2") - F.col("x1")).alias("_dx"), (F.col("y2") - F.col("y1")).alias("_dy"))
    met = numbered.join(leaving, F.col("code").eqNullSafe(F.col("_code")) & (F.col("x2") == F.col("_x")) & (F.col("y2") == F.col("_y")))
    back_x, back_y = F.col("x1") - F.col("x2"), F.col("y1") - F.col("y2")
    # Clockwise angle from the way back, above 0 and at most a full turn.
    turn = F.atan2(F.col("_dx") * back_y - F.col("_dy") * back_x, F.col("_dx") * back_x + F.col("_dy") * back_y)
    turn = F.when(turn <= 0, turn + F.lit(8.0)).otherwise(turn)
    first = met.groupBy("edge").agg(F.min_by("next", F.struct(turn.alias("turn"), F.col("next").alias("tie"))).alias("next"))
    return staged(numbered.join(first, "edge"), "followed-edges")


def outline_points(polygons: DataFrame, code: str, rings: str = "rings") -> DataFrame:
    """`code, ring, place, x, y, x_next, y_next`: the border of each unit, one row per edge.

    `ring` is the smallest edge of the ring as `x1, y1, x2, y2`, at which `place` 0 is. Shells run
    counter-clockwise, holes clockwise. Units without an area have no rows.
    """
    edges = followed(border_edges(polygons, code, rings))
    label = F.struct(*ENDS)
    at = staged(edges.select("edge", F.col("next").alias("ahead"), label.alias("ring")), "rings")
    while True:
        then = at.select(F.col("edge").alias("_at"), F.col("ahead").alias("_ahead"), F.col("ring").alias("_ring"))
        looked = at.join(then, F.col("ahead") == F.col("_at")).select(
            "edge", F.col("_ahead").alias("ahead"), F.least("ring", "_ring").alias("ring"), (F.col("_ring") < F.col("ring")).alias("moved"))
        looked = staged(looked, "rings")
        at = looked.drop("moved")
        # When no window twice as long has a smaller edge, all windows of a ring have its smallest.
        if looked.filter("moved").isEmpty():
            break
    # Steps that are left to the first edge, which itself goes nowhere.
    ringed = staged(edges.join(at.select("edge", "ring"), "edge"), "ringed-edges")
    first = F.col("ring") == label
    left = staged(ringed.select("edge", F.when(~first, F.col("next")).alias("ahead"), F.when(first, 0).otherwise(1).cast("long").alias("steps")), "ring-steps")
    while not left.filter("ahead IS NOT NULL").isEmpty():
        then = left.select(F.col("edge").alias("_at"), F.col("ahead").alias("_ahead"), F.col("steps").alias("_steps"))
        left = staged(left.join(then, F.col("ahead") == F.col("_at"), "left").select(
            "edge", F.col("_ahead").alias("ahead"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps")), "ring-steps")
    placed = staged(ringed.join(left.select("edge", "steps"), "edge"), "placed-edges")
    sizes = placed.groupBy("code", "ring").agg((F.max("steps") + 1).alias("of"))
    whole = placed.alias("p").join(sizes.alias("s"), F.col("p.code").eqNullSafe(F.col("s.code")) & (F.col("p.ring") == F.col("s.ring")))
    return whole.select("p.code", "p.ring", ((F.col("of") - F.col("steps")) % F.col("of")).alias("place"),
                        F.col("x1").alias("x"), F.col("y1").alias("y"), F.col("x2").alias("x_next"), F.col("y2").alias("y_next"))


def outline_rings(polygons: DataFrame, code: str, rings: str = "rings") -> DataFrame:
    """`code, ring, hole, area`: one row per ring of the units' outlines, closed; the area of a hole is negative."""
    points = outline_points(polygons, code, rings)
    twice = F.col("x") * F.col("y_next") - F.col("x_next") * F.col("y")
    made = points.groupBy("code", F.col("ring").alias("first")).agg(
        F.array_sort(F.collect_list(F.struct("place", "x", "y"))).alias("points"), (F.sum(twice) / 2).alias("area"))
    xy = F.transform("points", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return made.select("code", F.concat(xy, F.slice(xy, 1, 1)).alias("ring"), (F.col("area") < 0).alias("hole"), "area")


def unit_outlines(polygons: DataFrame, code: str, rings: str = "rings") -> DataFrame:
    """`code, rings, area`: the outline of each unit as one value, shells first, each ring closed."""
    made = outline_rings(polygons, code, rings)
    return made.groupBy("code").agg(
        F.array_sort(F.collect_list(F.struct("hole", "ring"))).alias("found"), F.sum("area").alias("area")).select(
        "code", F.transform("found", lambda f: f["ring"]).alias("rings"), "area")
