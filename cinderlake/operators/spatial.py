"""Distributed spatial operators on a regular grid.

A spatial join is turned into an equi-join on grid cells. Each polygon is cut into the cells of
its bounding box and a cell keeps only the edges a rightward ray from inside it can meet, so the
work per point does not grow with the size of the whole polygon. When the cut polygons are
measured to be small they are broadcast and the points are never shuffled; otherwise the join
shuffles on the cell and AQE splits crowded cells.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderlake.functions import geometry as g
from cinderlake.functions.parsing import snap
from cinderlake.session import cut_lineage

EDGE_BYTES = 64
BROADCAST_BYTES = 256 * 1024 * 1024
# Stations that a point meets in one row.
TOGETHER = 64


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(float(size)))


def polygon_cells(polygons: DataFrame, cell: float, code: str = "code", rings: str = "rings") -> DataFrame:
    """`cx, cy, code, parts`: the grid cells each unit may cover, with the edges to test there.

    `parts` has one edge array per polygon of the unit, so a point on a border that two parts of
    one unit share still counts once.
    """
    edges = polygons.select(F.col(code).alias("code"), g.polygon_edges(rings).alias("edges")) \
                    .filter(F.size("edges") > 0)
    boxed = edges.select("code", "edges", g.box(F.col("edges")).alias("b"))
    rows = boxed.select(
        "code", "edges", "b",
        F.explode(F.sequence(_cell(F.col("b.y_min"), cell), _cell(F.col("b.y_max"), cell))).alias("cy"))
    # Cells are compared as whole numbers: floor and division never decrease, so an edge is in every
    # cell that one of its points falls in, whatever the rounding.
    banded = rows.select(
        "code", "b", "cy",
        F.filter("edges", lambda e: (_cell(F.least(e["y1"], e["y2"]), cell) <= F.col("cy"))
                 & (_cell(F.greatest(e["y1"], e["y2"]), cell) >= F.col("cy"))).alias("edges"))
    cells = banded.select(
        "code", "cy", "edges",
        F.explode(F.sequence(_cell(F.col("b.x_min"), cell), _cell(F.col("b.x_max"), cell))).alias("cx"))
    kept = cells.select(
        "cx", "cy", "code", F.filter("edges", lambda e: _cell(F.greatest(e["x1"], e["x2"]), cell) >= F.col("cx")).alias("edges")
    ).filter(F.size("edges") > 0)
    return kept.groupBy("cx", "cy", "code").agg(F.collect_list("edges").alias("parts"))


def points_in_polygons(
    points: DataFrame, polygons: DataFrame, *, x: str, y: str, cell: float, code: str = "code",
    rings: str = "rings", out: str = "id_rel_lau", tie: str = "all", key: str | list[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Points with the code of each polygon that covers them, borders included.

    Points outside all polygons are left out. A point on a shared border gives one row per polygon
    with `tie="all"`; `tie="first"` keeps the smallest code per `key`, the column or columns that
    identify a point. Edges are planar in the units of the coordinates.
    """
    covers = polygon_cells(polygons, cell, code, rings).withColumnRenamed("code", out)
    measured = covers.agg(F.sum(F.aggregate("parts", F.lit(0), lambda a, p: a + F.size(p)))).first()[0] or 0
    if measured * EDGE_BYTES <= broadcast_bytes:
        covers = F.broadcast(covers)
    px, py = F.col(x), F.col(y)
    located = points.filter(px.isNotNull() & py.isNotNull() & ~F.isnan(px) & ~F.isnan(py)) \
        .withColumn("cx", _cell(px, cell)).withColumn("cy", _cell(py, cell))
    hit = located.join(covers, ["cx", "cy"]).filter(
        F.exists("parts", lambda p: g.covers(px, py, p))).select(*points.columns, out)
    if tie == "all":
        return hit
    if key is None:
        raise ValueError("tie='first' needs the key that identifies a point")
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in points.columns if c not in keys]
    first = hit.groupBy(*keys).agg(F.min(F.struct(F.col(out).alias("_out"), *rest)).alias("_p"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_p.{c}").alias(c) for c in points.columns], F.col("_p._out").alias(out))


def unit_edges(polygons: DataFrame, code: str, rings: str = "rings") -> DataFrame:
    """Edges of polygons in a direction-free form: the lower end first."""
    e = polygons.select(F.col(code).alias("code"), F.explode(g.polygon_edges(rings)).alias("e"))
    swap = (F.col("e.x1") > F.col("e.x2")) | ((F.col("e.x1") == F.col("e.x2")) & (F.col("e.y1") > F.col("e.y2")))
    ends = {"x1": "x2", "y1": "y2", "x2": "x1", "y2": "y1"}
    return e.select("code", *[F.when(swap, F.col(f"e.{b}")).otherwise(F.col(f"e.{a}")).alias(a)
                              for a, b in ends.items()]) \
            .filter((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


def dissolved_edges(polygons: DataFrame, code: str, rings: str = "rings") -> DataFrame:
    """Border of the union per code, as `code, x1, y1, x2, y2`.

    Members that tile their unit share each inner edge in pairs, and those cancel; what is left is
    the outline. Edges are grouped on their coordinates, never gathered per unit. Members have to
    meet in common vertices, as parish boundaries do; overlaps are not resolved.
    """
    keys = ["code", "x1", "y1", "x2", "y2"]
    return unit_edges(polygons, code, rings).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") % 2 == 1).select(*keys)


def perimeter_parts(parts: DataFrame, grid: float = 1e-5) -> DataFrame:
    """Usable perimeter parts `fire_id, part, rings, area`: snapped to the grid, invalid ones left out.

    The union of a fire's parts stays in long form, one row per part, so that a fire with very many
    parts never becomes one row. A part that is the same as another of its fire counts once.
    """
    # one-element explodes: each expression is computed once and not again in every later use
    snapped = parts.select("fire_id", "part", F.explode(F.array(g.snap_rings("rings", grid))).alias("rings"))
    measured = snapped.select("*", F.explode(F.array(g.enclosed_area("rings"))).alias("area"))
    usable = measured.filter(F.col("area").isNotNull())
    # Rings meet by their area and two hashes, so they are compared as short keys.
    keyed = usable.groupBy("fire_id", F.xxhash64("rings").alias("_h1"), F.hash("rings").alias("_h2"), "area")
    return keyed.agg(F.min(F.struct("part", "rings")).alias("_p")).select("fire_id", "_p.part", "_p.rings", "area")


def attach_perimeters(fact: DataFrame, parts: DataFrame, key: str = "id") -> DataFrame:
    """The fact with `perimeter_parts` and `perimeter_area` of its usable parts; NULL without any."""
    per_fire = parts.groupBy(F.col("fire_id").alias("_fire")).agg(
        F.count(F.lit(1)).alias("perimeter_parts"), F.sum("area").alias("perimeter_area"))
    return fact.join(per_fire, F.col(key) == F.col("_fire"), "left").drop("_fire")


def snap_to_weather_cell(df: DataFrame, step: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Adds `cell_lat, cell_lon`, the centre of the regular weather cell of each point."""
    return df.withColumn("cell_lat", F.round(snap(lat, step), 6)).withColumn("cell_lon", F.round(snap(lon, step), 6))


def nearest_station(
    points: DataFrame, stations: DataFrame, *, key: str, bucket: float | None = None, x: str = "lon",
    y: str = "lat", station: str = "station",
) -> DataFrame:
    """`key, station, distance`: the nearest station of each point, planar, ties by station.

    Points look at the stations of their own and the eight neighbouring buckets. A find within one
    bucket width is final. The points left over are tried again with buckets four times as wide, until
    a bucket is as wide as everything, so the answer is exact for any layout of stations. Unless
    `bucket` is given, the first width comes from the stations' median spacing, found by one sketch of
    their sorted coordinates. Points and stations without two finite coordinates take no part.

    A point meets the stations near its bucket as arrays of at most `TOGETHER`, so it is a row or a
    few, and no row for each pair is held; points are dealt out by key before they meet any.
    """
    def finite(frame: DataFrame, *names: str) -> DataFrame:
        for c in names:
            frame = frame.filter(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        return frame

    rows = stations.groupBy(F.col(x).alias("sx"), F.col(y).alias("sy")).agg(F.min(station).alias("station"))
    rows = cut_lineage(finite(rows, "sx", "sy"))
    waiting = finite(points.select(F.col(key), F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py")), "px", "py").repartition(F.col(key))
    quantiles = [q / 8 for q in range(9)]
    extent = rows.agg(F.count("sx").alias("n"), F.percentile_approx("sx", quantiles).alias("x"), F.percentile_approx("sy", quantiles).alias("y"),
                      F.min("sx").alias("x0"), F.max("sx").alias("x1"), F.min("sy").alias("y0"), F.max("sy").alias("y1")).first()
    if not extent["n"]:
        return points.select(key).filter(F.lit(False)).selectExpr(
            key, "cast(null as string) station", "cast(null as double) distance")
    span = waiting.agg(F.min("px").alias("x0"), F.max("px").alias("x1"), F.min("py").alias("y0"), F.max("py").alias("y1")).first()
    ends = {c: [r[c + e] for r in (extent, span) for e in "01" if r[c + e] is not None] for c in "xy"}
    reach = max([max(v) - min(v) for v in ends.values()] + [1e-9])
    if bucket is None:
        # The densest eighth of either axis sets the width, so that a cluster is not one bucket.
        narrow = [min((b - a for a, b in zip(extent[c], extent[c][1:], strict=False) if b > a), default=reach) for c in "xy"]
        bucket = math.sqrt(narrow[0] * narrow[1] * 64 / extent["n"])
    # A coordinate over the width stays a whole number that a long holds.
    largest = max(abs(v) for values in ends.values() for v in values)
    size = max(float(bucket), reach / 2**20, largest / 2**50)
    done = None
    offsets = F.sequence(F.lit(-1), F.lit(1))
    while True:  # at most 11 rounds: from reach / 2**20 to reach by steps of four
        spread = rows.filter(F.col("station").isNotNull()).withColumn("dx", F.explode(offsets)).withColumn("dy", F.explode(offsets)).select(
            "station", "sx", "sy", (_cell(F.col("sx"), size) + F.col("dx")).alias("bx"),
            (_cell(F.col("sy"), size) + F.col("dy")).alias("by"))
        place = F.row_number().over(Window.partitionBy("bx", "by").orderBy("sx", "sy")) - 1
        near = spread.withColumn("some", F.floor(place / TOGETHER)).groupBy("bx", "by", "some").agg(F.collect_list(F.struct("station", "sx", "sy")).alias("near"))
        met = F.array_min(F.transform("near", lambda s: F.struct(
            F.sqrt(F.pow(F.col("px") - s["sx"], 2) + F.pow(F.col("py") - s["sy"], 2)).alias("distance"), s["station"].alias("station"))))
        tried = waiting.withColumn("bx", _cell(F.col("px"), size)).withColumn("by", _cell(F.col("py"), size)) \
            .join(near, ["bx", "by"], "left").withColumn("met", met) \
            .groupBy(key).agg(F.min("px").alias("px"), F.min("py").alias("py"), F.min("met").alias("hit"))
        tried = cut_lineage(tried)
        last = size > reach  # all stations are in neighbouring buckets now
        final = F.lit(True) if last else F.coalesce(F.col("hit.distance") <= size, F.lit(False))
        found = tried.filter(final).select(key, "hit.station", "hit.distance")
        done = found if done is None else done.unionByName(found)
        waiting = tried.filter(~final).select(key, "px", "py")
        if last or waiting.isEmpty():
            return done
        size *= 4
