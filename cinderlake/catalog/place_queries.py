"""Map layers, geography, spatial and weather queries with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinderlake.catalog import star
from cinderlake.functions import parsing as p
from cinderlake.operators import geography, spatial, weather
from cinderlake.plans import layers
from cinderlake.sources import lookups


def _flat(spark, d):
    return geography.flatten_geography(star.lau(spark, d))


def _type_codes(spark, d):
    o = star.table(spark, d, "orders").select(F.col("o_orderpriority").alias("id")).distinct()
    return o.select("id", F.element_at(F.split("id", "-"), 2).alias("code"))


def _layer(spark, d):
    dims = {"fire_type": _type_codes(spark, d), "cause_type": star.cause_types(spark, d)}
    return layers.fire_layer(star.fires(spark, d), _flat(spark, d), dims)


# --- layers ----------------------------------------------------------------------------------

def layer_points(spark, d):
    return layers.point_layer(_layer(spark, d)).drop("alarm_ts")


_LAYER_SELECT = """SELECT id, year, ts, g.lau3, g.lau2, g.lau1, string_split(id_ref_fire_type, '-')[2] AS fire_type,
       CASE WHEN id_ref_cause_type <> 'P' THEN 'STATUS_' || id_ref_cause_type END AS cause_type, total_area
FROM fires f LEFT JOIN geo g ON f.id_rel_lau = g.lau3_code"""


def _perimeter_parts(spark, d):
    """Each line item is a rectangle of its order's perimeter; those without height have no area."""
    w, h = F.col("l_quantity"), F.col("l_discount") * 100

    def v(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    zero = F.lit(0.0)
    ring = F.array(v(zero, zero), v(w, zero), v(w, h), v(zero, h), v(zero, zero))
    parts = star.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("fire_id"), F.col("l_linenumber").alias("part"), F.array(ring).alias("rings"))
    return spatial.perimeter_parts(parts)


_PARTS_SQL = """
parts AS (SELECT l_orderkey AS fire_id, min(l_linenumber) AS part, l_quantity * round(l_discount * 100, 5) AS area
          FROM lineitem WHERE l_discount > 0 GROUP BY l_orderkey, l_quantity, round(l_discount * 100, 5))"""


def layer_perimeters(spark, d):
    out = layers.perimeter_layer(_layer(spark, d), _perimeter_parts(spark, d))
    return out.select("id", "year", "lau1", "part", F.size("rings").alias("rings"), F.round("part_area", 4).alias("part_area"))


_PERIMETER_SQL = f"""WITH {star.GEO_SQL}, {star.FIRES_SQL}, {_PARTS_SQL}
SELECT id, year, g.lau1, part, CAST(1 AS INTEGER) AS rings, round(p.area, 4) AS part_area
FROM fires f LEFT JOIN geo g ON f.id_rel_lau = g.lau3_code JOIN parts p ON f.id = p.fire_id"""


def attach_perimeters(spark, d):
    fact = star.fires(spark, d).select("id", "year")
    out = spatial.attach_perimeters(fact, _perimeter_parts(spark, d))
    return out.withColumn("perimeter_area", F.round("perimeter_area", 4))


_ATTACH_SQL = f"""WITH {_PARTS_SQL}
SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS year, p.n AS perimeter_parts, round(p.a, 4) AS perimeter_area
FROM orders LEFT JOIN (SELECT fire_id, count(*) AS n, sum(area) AS a FROM parts GROUP BY fire_id) p ON o_orderkey = p.fire_id"""


def geo_level2(spark, d):
    return geography.level2_units(star.lau(spark, d)).select("code", "name", "parent_name")


def geo_level3(spark, d):
    return geography.level3_units(star.lau(spark, d)).withColumn("area", F.round("area", 2))


def summary_level2(spark, d):
    units = star.lau(spark, d).filter("level = 2").select("code", F.col("code_parent").alias("up"))
    return layers.area_summary(star.fires(spark, d), _flat(spark, d), 2, units)


def summary_level1(spark, d):
    return layers.area_summary(star.fires(spark, d), _flat(spark, d), 1)


def _summary_sql(level, extra=""):
    return f"""WITH {star.GEO_SQL}, {star.FIRES_SQL}
SELECT count(*) AS count, year, CAST(month(ts) AS INTEGER) AS month, g.lau{level}, g.lau{level}_code AS code {extra}
FROM fires f JOIN geo g ON f.id_rel_lau = g.lau3_code GROUP BY ALL"""


def summary_rollup(spark, d):
    summary = layers.area_summary(star.fires(spark, d), _flat(spark, d), 1)
    return layers.summary_of_year(summary, 1, 1998, carry="code")


_ROLLUP_SQL = f"""WITH {star.GEO_SQL}, {star.FIRES_SQL}
SELECT year, g.lau1, count(*) AS count, g.lau1_code AS code
FROM fires f JOIN geo g ON f.id_rel_lau = g.lau3_code WHERE year = 1998 GROUP BY ALL"""


def first_last_value(spark, d):
    e = star.table(spark, d, "events").withColumn("v", F.when(F.col("event_type") != "click", F.col("value")))
    return e.groupBy("user_id").agg(
        layers.first_known("v", "ts", "event_id").alias("first_value"),
        layers.last_known("v", "ts", "event_id").alias("last_value"))


_FIRST_LAST_SQL = """
SELECT user_id, min_by(v, (ts, event_id)) FILTER (v IS NOT NULL) AS first_value,
       max_by(v, (ts, event_id)) FILTER (v IS NOT NULL) AS last_value
FROM (SELECT *, CASE WHEN event_type <> 'click' THEN value END AS v FROM events) GROUP BY user_id"""


def newest_first_top(spark, d):
    return layers.newest_first(star.fires(spark, d), 1999, "1999-02-10").select("id", "ts")


_NEWEST_SQL = """
SELECT o_orderkey AS id, o_orderdate AS ts FROM orders
WHERE year(o_orderdate) = 1999 AND o_orderdate >= TIMESTAMP '1999-02-10' ORDER BY ts DESC, id"""


# --- geography -------------------------------------------------------------------------------

def _parishes(spark, d):
    """Customers as parishes: unit squares in the column of their nation, at the row of their key."""
    c, n, r = (star.table(spark, d, t) for t in ("customer", "nation", "region"))
    rows = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    x, y = F.col("n_nationkey").cast("double"), F.col("c_custkey").cast("double")

    def v(dx, dy):
        return F.struct((x + dx).alias("x"), (y + dy).alias("y"))

    ring = F.array(v(0, 0), v(1, 0), v(1, 1), v(0, 1), v(0, 0))
    code = F.concat(F.lpad(F.col("n_regionkey").cast("string"), 2, "0"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"),
                    F.lpad(F.col("c_custkey").cast("string"), 12, "0"))
    return rows.select(code.alias("dicofre"), F.col("c_name").alias("freguesia"), F.col("n_name").alias("concelho"),
                       F.col("r_name").alias("distrito"), (F.col("c_acctbal") + 1000).alias("area"), F.array(ring).alias("rings"))


_PARISH_SQL = """
parish AS (
  SELECT lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 2, '0')
         || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS dicofre,
         c_name AS freguesia, n_name AS concelho, r_name AS distrito, c_acctbal + 1000 AS area,
         n_nationkey AS x, c_custkey AS y
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


def code_prefix_rollup(spark, d):
    return geography.rollup_by_prefix(_parishes(spark, d)).withColumn("area", F.round("area", 2))


_PREFIX_SQL = f"""WITH {_PARISH_SQL}
SELECT dicofre AS code, substring(dicofre, 1, 4) AS code_parent, freguesia AS name, CAST(3 AS INTEGER) AS level,
       round(sum(area), 2) AS area FROM parish GROUP BY ALL
UNION ALL SELECT substring(dicofre, 1, 4), substring(dicofre, 1, 2), concelho, CAST(2 AS INTEGER), round(sum(area), 2) FROM parish GROUP BY ALL
UNION ALL SELECT substring(dicofre, 1, 2), NULL, distrito, CAST(1 AS INTEGER), round(sum(area), 2) FROM parish GROUP BY ALL"""


def boundary_dissolve(spark, d):
    """Outline of each municipality: number of border edges, their length, and its extent."""
    units = _parishes(spark, d).withColumn("unit", F.substring("dicofre", 1, 4))
    edges = spatial.dissolved_edges(units, "unit")
    length = F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2))
    return edges.groupBy("code").agg(
        F.count(F.lit(1)).alias("edges"), F.round(F.sum(length), 2).alias("length"), F.max("y2").alias("top"))


_DISSOLVE_SQL = f"""WITH {_PARISH_SQL},
edges AS (
  SELECT substring(dicofre, 1, 4) AS code, x, y, 'v' AS side FROM parish UNION ALL
  SELECT substring(dicofre, 1, 4), x + 1, y, 'v' FROM parish UNION ALL
  SELECT substring(dicofre, 1, 4), x, y, 'h' FROM parish UNION ALL
  SELECT substring(dicofre, 1, 4), x, y + 1, 'h' FROM parish
),
outline AS (SELECT code, x, y, side FROM edges GROUP BY ALL HAVING count(*) % 2 = 1)
SELECT code, count(*) AS edges, round(CAST(count(*) AS DOUBLE), 2) AS length,
       CAST(max(CASE side WHEN 'v' THEN y + 1 ELSE y END) AS DOUBLE) AS top
FROM outline GROUP BY code"""


def ine_join(spark, d):
    # every seventh code is longer than the units' codes and names none
    long_code = F.when(F.col("o_orderkey") % 7 == 0, F.col("o_custkey") * 10 + 1_000_000_000_000)
    o = star.table(spark, d, "orders").select("o_orderkey", F.coalesce(long_code, F.col("o_custkey") + 20).cast("double").alias("INE"))
    units = star.lau(spark, d).filter("level = 3").select(
        F.lpad(F.col("code").cast("string"), 12, "0").alias("code"), "name", "level")
    return geography.join_by_statistical_code(o, units, width=12).select("o_orderkey", "ine_code", "ine_name")


_INE_SQL = """
SELECT o_orderkey, lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS ine_code, c_name AS ine_name
FROM orders LEFT JOIN customer ON o_custkey + 20 = c_custkey AND o_orderkey % 7 <> 0"""


def place_lookup(spark, d):
    places = star.table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    gazetteer = star.table(spark, d, "supplier").join(places, F.col("s_nationkey") == F.col("k")).select(
        "name", F.col("s_acctbal").alias("lat"), F.col("s_suppkey").cast("double").alias("lon"),
        F.col("s_suppkey").alias("rank"))
    asked = star.table(spark, d, "customer").select(
        "c_custkey", F.concat(F.lit("NATION_"), (F.col("c_nationkey") + 3).cast("string")).alias("place"))
    return lookups.place_coordinates(asked, gazetteer, "place")


_PLACE_SQL = """
WITH best AS (SELECT n_name, min(s_suppkey) AS k FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
SELECT c_custkey, 'NATION_' || CAST(c_nationkey + 3 AS VARCHAR) AS place, s_acctbal AS lat, CAST(s_suppkey AS DOUBLE) AS lon
FROM customer LEFT JOIN best ON n_name = 'NATION_' || CAST(c_nationkey + 3 AS VARCHAR) LEFT JOIN supplier ON s_suppkey = k"""


# --- spatial ---------------------------------------------------------------------------------

def _fire_points(spark, d):
    return star.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 1000).alias("lon"),
        F.dayofyear("o_orderdate").cast("double").alias("lat"))


def _nation_polygons(spark, d):
    """Nations tile the plane in rectangles that share borders; each has a diamond-shaped hole."""
    x = F.col("n_regionkey") * 100.0
    y = F.floor(F.col("n_nationkey") / 5) * 73.0

    def v(dx, dy):
        return F.struct((x + dx).alias("x"), (y + dy).alias("y"))

    outer = F.array(v(0.0, 0.0), v(100.0, 0.0), v(100.0, 73.0), v(0.0, 73.0), v(0.0, 0.0))
    hole = F.array(v(50.0, 21.5), v(70.0, 36.5), v(50.0, 51.5), v(30.0, 36.5), v(50.0, 21.5))
    return star.table(spark, d, "nation").select(F.col("n_nationkey").alias("code"), F.array(outer, hole).alias("rings"))


def point_in_polygon(spark, d):
    return spatial.points_in_polygons(
        _fire_points(spark, d), _nation_polygons(spark, d), x="lon", y="lat", cell=20.0).select("id", "id_rel_lau")


_PIP_BASE = """
points AS (SELECT o_orderkey AS id, o_totalprice / 1000 AS lon, CAST(dayofyear(o_orderdate) AS DOUBLE) AS lat FROM orders),
shapes AS (SELECT n_nationkey AS code, n_regionkey * 100.0::DOUBLE AS x, (n_nationkey // 5) * 73.0::DOUBLE AS y FROM nation),
hits AS (SELECT id, code FROM points JOIN shapes
         ON lon BETWEEN x AND x + 100 AND lat BETWEEN y AND y + 73
         AND abs(lon - x - 50) / 20 + abs(lat - y - 36.5) / 15 >= 1)"""


def point_first_polygon(spark, d):
    return spatial.points_in_polygons(
        _fire_points(spark, d), _nation_polygons(spark, d), x="lon", y="lat", cell=35.0, tie="first", key="id",
    ).select("id", "id_rel_lau")


def point_on_border(spark, d):
    """Points and borders on multiples of 0.1, at the default cell: a point on a border is in both rectangles."""
    points = star.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 400 / 10).alias("lon"), (F.col("o_orderkey") % 70 / 10).alias("lat"))

    def v(x, y):
        return F.struct((x / 10).alias("x"), (y / 10).alias("y"))

    x, y = F.col("n_regionkey") * 73 + 17, F.floor(F.col("n_nationkey") / 5) * 13 + 4
    ring = F.array(v(x, y), v(x + 73, y), v(x + 73, y + 13), v(x, y + 13), v(x, y))
    shapes = star.table(spark, d, "nation").select(F.col("n_nationkey").alias("code"), F.array(ring).alias("rings"))
    return spatial.points_in_polygons(points, shapes, x="lon", y="lat", cell=0.1).select("id", "id_rel_lau")


_BORDER_SQL = """
WITH shapes AS (SELECT n_nationkey AS code, n_regionkey * 73 + 17 AS x, n_nationkey // 5 * 13 + 4 AS y FROM nation)
SELECT o_orderkey AS id, code AS id_rel_lau FROM orders JOIN shapes
ON o_custkey % 400 BETWEEN x AND x + 73 AND o_orderkey % 70 BETWEEN y AND y + 13"""


def snap_points(spark, d):
    grid = 0.01
    return _fire_points(spark, d).select("id", F.round(p.snap("lon", grid), 5).alias("lon"))


def polygon_measures(spark, d):
    """Areas of perimeter rectangles per order, invalid ones left out."""
    return _perimeter_parts(spark, d).groupBy("fire_id").agg(
        F.count(F.lit(1)).alias("parts"), F.round(F.max("area"), 4).alias("largest"))


_MEASURE_SQL = f"""WITH {_PARTS_SQL}
SELECT fire_id, count(*) AS parts, round(max(area), 4) AS largest FROM parts GROUP BY fire_id"""


def nearest_station(spark, d):
    points = star.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("lon"), (F.col("c_nationkey") * 400.0).alias("lat"))
    stations = star.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("station"), F.col("s_acctbal").alias("lon"), (F.col("s_nationkey") * 400.0).alias("lat"))
    out = spatial.nearest_station(points, stations, key="id")
    return out.select("id", "station", F.round("distance", 4).alias("distance"))


_NEAREST_SQL = """
SELECT id, station, round(distance, 4) AS distance FROM (
  SELECT c_custkey AS id, s_suppkey AS station,
         sqrt(pow(c_acctbal - s_acctbal, 2) + pow(c_nationkey * 400.0::DOUBLE - s_nationkey * 400.0::DOUBLE, 2)) AS distance
  FROM customer, supplier)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, station) = 1"""


# --- weather ---------------------------------------------------------------------------------

def daily_region_weather(spark, d):
    """Daily extremes per region: the quantities shipped by the region's suppliers on a day."""
    s = star.table(spark, d, "supplier").join(
        star.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_regionkey")
    rows = star.table(spark, d, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.groupBy("n_regionkey", F.col("l_shipdate").cast("date").alias("date")).agg(
        F.max("l_quantity").alias("temp_max"), F.min("l_quantity").alias("temp_min"))


def _incidents(spark, d):
    """Orders as incidents of one to five days, located in their customer's region."""
    c = star.table(spark, d, "customer").join(
        star.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_regionkey")
    o = star.table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    start = F.col("o_orderdate").cast("date")
    text = o.select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("source_file"),
        F.concat((F.col("n_regionkey") * 5).cast("string"), F.lit(",1")).alias("LAT"), F.lit("-8.02").alias("LON"),
        F.date_format("o_orderdate", "dd-MM-yyyy HH:mm:ss").alias("DHINICIO"), F.lit(None).cast("string").alias("DHFIM"),
        F.date_format(F.date_add(start, F.substring("o_orderpriority", 1, 1).cast("int") - 1), "dd/MM/yyyy").alias("DATAEXTINCAO"),
        F.lit("10:00").alias("HORAEXTINCAO"))
    return weather.incident_spans(text)


def weather_detail(spark, d):
    step = 0.25
    cells = spatial.snap_to_weather_cell(_incidents(spark, d), step)
    daily = daily_region_weather(spark, d).select(
        (F.col("n_regionkey") * 5.0).alias("cell_lat"), F.lit(-8.0).alias("cell_lon"), "date", "temp_max", "temp_min")
    return weather.weather_detail(cells, daily, {"cell_lat": "cell_lat", "cell_lon": "cell_lon"})


_WEATHER_BASE = """
daily AS (SELECT n_regionkey, CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS temp_max, min(l_quantity) AS temp_min
          FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL),
incidents AS (SELECT CAST(o_orderkey AS VARCHAR) AS incident_id, o_orderstatus AS source_file, n_regionkey,
                     CAST(o_orderdate AS DATE) AS start_date, CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS days
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
detail AS (SELECT incident_id, source_file, d.date, n_regionkey * 5 + 0.1::DOUBLE AS lat, -8.02::DOUBLE AS lon, temp_max, temp_min
           FROM incidents i JOIN daily d USING (n_regionkey)
           WHERE d.date >= start_date AND d.date < start_date + days)"""


def weather_summary(spark, d):
    out = weather.weather_summary(weather_detail(spark, d))
    return out.withColumn("mean_temp_max", F.round("mean_temp_max", 6)).withColumn("mean_temp_min", F.round("mean_temp_min", 6))


_SUMMARY_SQL = f"""WITH {_WEATHER_BASE}
SELECT source_file, incident_id, min(date) AS start_date, max(date) AS end_date, round(avg(temp_max), 6) AS mean_temp_max,
       round(avg(temp_min), 6) AS mean_temp_min, count(DISTINCT date) AS n_days, min(lat) AS lat, min(lon) AS lon
FROM detail GROUP BY ALL"""


def json_daily_extremes(spark, d):
    """Measures read from JSON text, as daily extremes."""
    e = star.table(spark, d, "events").select("ts", F.from_json("props", "k double").alias("j"))
    return e.groupBy(F.col("ts").cast("date").alias("date")).agg(
        F.max("j.k").alias("temp_max"), F.min("j.k").alias("temp_min"))


_JSON_SQL = """
SELECT CAST(ts AS DATE) AS date, max(CAST(props->>'$.k' AS DOUBLE)) AS temp_max, min(CAST(props->>'$.k' AS DOUBLE)) AS temp_min
FROM events GROUP BY 1"""

QUERIES = {
    "layer_points": (layer_points, f"WITH {star.GEO_SQL}, {star.FIRES_SQL} {_LAYER_SELECT}"),
    "layer_perimeters": (layer_perimeters, _PERIMETER_SQL),
    "attach_perimeters": (attach_perimeters, _ATTACH_SQL),
    "geo_level2": (geo_level2, """SELECT CAST(n_nationkey AS BIGINT) AS code, n_name AS name, r_name AS parent_name
FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "geo_level3": (geo_level3, """SELECT c_custkey AS code, c_name AS name, round(c_acctbal + 1000, 2) AS area,
r_name AS grand_parent_name, n_name AS parent_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "summary_level1": (summary_level1, _summary_sql(1)),
    "summary_level2": (summary_level2, _summary_sql(2, ", g.lau1_code AS up")),
    "summary_rollup": (summary_rollup, _ROLLUP_SQL),
    "first_last_value": (first_last_value, _FIRST_LAST_SQL),
    "newest_first_top": (newest_first_top, _NEWEST_SQL),
    "code_prefix_rollup": (code_prefix_rollup, _PREFIX_SQL),
    "boundary_dissolve": (boundary_dissolve, _DISSOLVE_SQL),
    "ine_join": (ine_join, _INE_SQL),
    "place_lookup": (place_lookup, _PLACE_SQL),
    "point_in_polygon": (point_in_polygon, f"WITH {_PIP_BASE} SELECT id, code AS id_rel_lau FROM hits"),
    "point_first_polygon": (point_first_polygon, f"WITH {_PIP_BASE} SELECT id, min(code) AS id_rel_lau FROM hits GROUP BY id"),
    "point_on_border": (point_on_border, _BORDER_SQL),
    "snap_points": (snap_points, """SELECT o_orderkey AS id,
round(round_even(o_totalprice / 1000 / 0.01::DOUBLE, 0) * 0.01::DOUBLE, 5) AS lon FROM orders"""),
    "polygon_measures": (polygon_measures, _MEASURE_SQL),
    "nearest_station": (nearest_station, _NEAREST_SQL),
    "weather_detail": (weather_detail, f"WITH {_WEATHER_BASE} SELECT * FROM detail"),
    "weather_summary": (weather_summary, _SUMMARY_SQL),
    "json_daily_extremes": (json_daily_extremes, _JSON_SQL),
}
