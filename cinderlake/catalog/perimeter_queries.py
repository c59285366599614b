"""Perimeter unions, polygon faults and outlines, with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinderlake.catalog import star
from cinderlake.operators import geography, outlines, overlay
from cinderlake.plans import layers, perimeters


def _v(x, y):
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _rectangles(spark, d):
    """Each line item is a rectangle of its order's perimeter, at a place of its own; those of an order overlap."""
    x, y = F.col("l_partkey") % 20, F.col("l_suppkey") % 10
    w, h = F.col("l_quantity"), F.round(F.col("l_discount") * 100)
    corners = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    return star.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("fire_id"), F.col("l_linenumber").alias("part"), F.array(F.array(*[_v(*c) for c in corners])).alias("rings"))


def perimeter_union(spark, d):
    """Area that the parts of each fire's perimeter cover together."""
    fact = star.fires(spark, d).select("id", "year")
    return perimeters.attach_united(fact, _rectangles(spark, d)).withColumn("perimeter_area", F.round("perimeter_area", 4))


def perimeters_of_year(spark, d):
    """The same for the fires of one year from a day on."""
    fact = star.fires(spark, d).select("id", "year", "ts")
    found = perimeters.perimeters_since(fact, _rectangles(spark, d), 1999, "1999-06-01")
    return found.select("id", "perimeter_parts", F.round("perimeter_area", 4).alias("perimeter_area"))


# Every order's rectangles cut each other's sides into small boxes; a box counts if any rectangle holds it.
_UNION_SQL = """
p AS (SELECT l_orderkey AS fire, l_partkey % 20 AS x1, l_partkey % 20 + l_quantity AS x2, l_suppkey % 10 AS y1,
             l_suppkey % 10 + round(l_discount * 100) AS y2 FROM lineitem WHERE round(l_discount * 100) > 0),
xs AS (SELECT fire, v AS a, lead(v) OVER (PARTITION BY fire ORDER BY v) AS b FROM (SELECT fire, x1 AS v FROM p UNION SELECT fire, x2 FROM p)),
ys AS (SELECT fire, v AS a, lead(v) OVER (PARTITION BY fire ORDER BY v) AS b FROM (SELECT fire, y1 AS v FROM p UNION SELECT fire, y2 FROM p)),
boxes AS (
  SELECT DISTINCT p.fire, xs.a AS xa, xs.b AS xb, ys.a AS ya, ys.b AS yb
  FROM p JOIN xs ON xs.fire = p.fire AND xs.a >= p.x1 AND xs.b <= p.x2 JOIN ys ON ys.fire = p.fire AND ys.a >= p.y1 AND ys.b <= p.y2),
area AS (SELECT fire, sum((xb - xa) * (yb - ya)) AS area FROM boxes GROUP BY fire),
n AS (SELECT fire, count(*) AS n FROM p GROUP BY fire)"""


def polygon_faults(spark, d):
    """Line items as polygons: rectangles, bow-ties, squares that touch in a point, crossing holes and spikes."""
    w, h = F.col("l_quantity"), F.round(F.col("l_discount") * 100)
    zero = F.lit(0)

    def ring(*corners):
        return F.array(*[_v(F.lit(x) if isinstance(x, int) else x, F.lit(y) if isinstance(y, int) else y) for x, y in [*corners, corners[0]]])

    shapes = [
        F.array(ring((zero, zero), (w, zero), (w, h), (zero, h))),
        F.array(ring((zero, zero), (w, h), (w, zero), (zero, h + 1))),
        F.array(ring((zero, zero), (w, h), (w * 2, zero), (w * 2, h * 2), (w, h), (zero, h * 2))),
        F.array(ring((zero, zero), (w + 9, zero), (w + 9, h + 9), (zero, h + 9)), ring((1, 1), (w + 10, F.lit(1)), (1, 2))),
        F.array(ring((zero, zero), (w, zero), (w * 2, zero), (w, zero), (w, h + 1))),
        F.array(ring((zero, zero), (w + 9, zero), (w + 9, h + 9), (zero, h + 9)), ring((1, 1), (w + 2, F.lit(1)), (1, 2))),
    ]
    kind = F.col("l_linenumber") % 6
    rings = F.coalesce(*[F.when(kind == k, s) for k, s in enumerate(shapes)])
    parts = star.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("fire_id"), F.col("l_linenumber").alias("part"),
                                                     F.xxhash64(rings).alias("shape"), rings.alias("rings"))
    return overlay.ring_faults(parts, ["fire_id", "part", "shape"]).groupBy("fire_id", "part", "fault").agg(F.count(F.lit(1)).alias("shapes"))


_FAULT_SQL = """
SELECT l_orderkey AS fire_id, l_linenumber AS part,
  CASE l_linenumber % 6 WHEN 0 THEN 'flat' WHEN 1 THEN 'crossing'
    WHEN 2 THEN CASE WHEN h = 0 THEN 'flat' ELSE 'crossing' END ELSE 'crossing' END AS fault
  , count(*) AS shapes
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, round(l_discount * 100) AS h FROM lineitem)
WHERE (l_linenumber % 6 = 1 AND h > 0) OR l_linenumber % 6 IN (2, 3, 4) OR (l_linenumber % 6 = 0 AND h = 0) GROUP BY ALL"""


def _board(spark, d):
    """Customers as unit squares on a board of 40 columns, in two units by nation."""
    k = F.col("c_custkey")
    x, y = k % 40, F.floor(k / 40)
    corners = [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)]
    return star.table(spark, d, "customer").select(
        F.when(F.col("c_nationkey") < 15, "west").otherwise("east").alias("unit"), F.array(F.array(*[_v(*c) for c in corners])).alias("rings"))


def outline_rings(spark, d):
    """Rings of the two units' outlines: points, holes, areas, and the smallest point of each."""
    made = outlines.outline_rings(_board(spark, d), "unit")
    least = F.array_min(F.transform("ring", lambda p: F.struct(p["x"], p["y"])))
    return made.select("code", "hole", F.round("area", 4).alias("area"), F.size("ring").cast("bigint").alias("points"),
                       least["x"].alias("x"), least["y"].alias("y"))


# Every border edge is walked along until it comes back; the smallest point on the way names its ring.
_RINGS_SQL = """
WITH RECURSIVE c AS (
  SELECT CASE WHEN c_nationkey < 15 THEN 'west' ELSE 'east' END AS code, CAST(c_custkey % 40 AS INT) AS x, CAST(c_custkey // 40 AS INT) AS y FROM customer),
d AS (
  SELECT code, x AS x1, y AS y1, x + 1 AS x2, y AS y2 FROM c UNION ALL SELECT code, x + 1, y, x + 1, y + 1 FROM c
  UNION ALL SELECT code, x + 1, y + 1, x, y + 1 FROM c UNION ALL SELECT code, x, y + 1, x, y FROM c),
e AS MATERIALIZED (
  SELECT d.*, row_number() OVER (ORDER BY d.code, d.x1, d.y1, d.x2, d.y2) AS id FROM d
  ANTI JOIN d r ON d.code = r.code AND d.x1 = r.x2 AND d.y1 = r.y2 AND d.x2 = r.x1 AND d.y2 = r.y1),
t AS MATERIALIZED (
  SELECT a.id, b.id AS next FROM e a JOIN e b ON a.code = b.code AND a.x2 = b.x1 AND a.y2 = b.y1
  QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY
    (a.x2 - a.x1) * (b.y2 - b.y1) - (a.y2 - a.y1) * (b.x2 - b.x1) DESC) = 1),
w AS (
  SELECT id AS start, id AS here FROM t
  UNION ALL SELECT w.start, t.next FROM w JOIN t ON w.here = t.id WHERE t.next <> w.start),
ring AS (SELECT start AS id, min(here) AS ring FROM w GROUP BY start)
SELECT e.code, sum(e.x1 * e.y2 - e.x2 * e.y1) < 0 AS hole, round(sum(e.x1 * e.y2 - e.x2 * e.y1) / 2.0::DOUBLE, 4) AS area, count(*) + 1 AS points,
       CAST(min({'x': e.x1, 'y': e.y1}).x AS DOUBLE) AS x, CAST(min({'x': e.x1, 'y': e.y1}).y AS DOUBLE) AS y
FROM e JOIN ring ON e.id = ring.id GROUP BY e.code, ring.ring"""


def summary_outline(spark, d):
    """Monthly counts of the municipalities with their outlines."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    corners = [(n, k), (n + 1, k), (n + 1, k + 1), (n, k + 1), (n, k)]
    squares = star.table(spark, d, "customer").select(n.cast("bigint").alias("unit"), F.array(F.array(*[_v(*c) for c in corners])).alias("rings"))
    units = outlines.unit_outlines(squares, "unit")
    summary = layers.area_summary(star.fires(spark, d), geography.flatten_geography(star.lau(spark, d)), 2, units)
    return summary.select("count", "year", "month", "lau2", "code", F.size("rings").cast("bigint").alias("rings"), F.round("area", 4).alias("area"))


_OUTLINE_SQL = f"""WITH {star.GEO_SQL}, {star.FIRES_SQL},
k AS (SELECT c_nationkey AS n, c_custkey - row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS run FROM customer),
u AS (SELECT n, count(DISTINCT run) AS rings, CAST(count(*) AS DOUBLE) AS area FROM k GROUP BY n)
SELECT count(*) AS count, year, CAST(month(ts) AS INTEGER) AS month, g.lau2, g.lau2_code AS code, u.rings, u.area
FROM fires f JOIN geo g ON f.id_rel_lau = g.lau3_code JOIN u ON u.n = g.lau2_code GROUP BY ALL"""

QUERIES = {
    "perimeter_union": (perimeter_union, f"""WITH {_UNION_SQL}
SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS year, n.n AS perimeter_parts, round(CAST(area.area AS DOUBLE), 4) AS perimeter_area
FROM orders LEFT JOIN n ON n.fire = o_orderkey LEFT JOIN area ON area.fire = o_orderkey"""),
    "perimeters_of_year": (perimeters_of_year, f"""WITH {_UNION_SQL}
SELECT o_orderkey AS id, n.n AS perimeter_parts, round(CAST(area.area AS DOUBLE), 4) AS perimeter_area
FROM orders LEFT JOIN n ON n.fire = o_orderkey LEFT JOIN area ON area.fire = o_orderkey
WHERE year(o_orderdate) = 1999 AND o_orderdate >= TIMESTAMP '1999-06-01'"""),
    "polygon_faults": (polygon_faults, _FAULT_SQL),
    "outline_rings": (outline_rings, _RINGS_SQL),
    "summary_outline": (summary_outline, _OUTLINE_SQL),
}
