"""Sources, sinks and jobs: the supplied tables written in a landed form and read back through the library."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cinderlake import schema
from cinderlake.catalog import star
from cinderlake.catalog.place_queries import _PIP_BASE, _WEATHER_BASE, _fire_points, _nation_polygons, _parishes, weather_detail
from cinderlake.functions import parsing as p
from cinderlake.operators import filters, incremental, spatial, weather
from cinderlake.operators.geography import units_from_boundaries
from cinderlake.plans import jobs
from cinderlake.session import scratch_path
from cinderlake.sources import lookups, occurrences, sinks


def _feed(spark, d):
    """Orders as landed text: unspecified priorities are the text NA, the status P is a lone bar in XML."""
    o = star.table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"), F.year("o_orderdate").cast("string").alias("ANO"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "NA").otherwise(F.col("o_orderpriority")).alias("TIPO"),
        F.concat(F.lit("área "), F.col("o_custkey").cast("string")).alias("LOCAL"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string").alias("AREATOTAL"))


_FEED_SQL = """
feed AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(year(o_orderdate) AS INTEGER) AS ano,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS tipo, 'área ' || CAST(o_custkey AS VARCHAR) AS local,
         CAST(round(o_totalprice * 100) AS BIGINT) AS area FROM orders
)"""


def csv_roundtrip(spark, d):
    """One folder per file name, in two encodings, read back with the missing-value tokens."""
    path = scratch_path(spark, "csv")
    feed = _feed(spark, d).withColumn("source_file", F.concat("ANO", F.lit(".csv")))
    for encoding, rows in (("UTF-8", feed.filter("ANO < '1996'")), ("ISO-8859-1", feed.filter("ANO >= '1996'").select("LOCAL", "id", "TIPO", "ANO", "AREATOTAL", "source_file"))):
        if encoding == "UTF-8":
            sinks.write_pipe_csv(rows, f"{path}/a")
        else:
            rows.write.partitionBy("source_file").option("sep", "|").option("header", "true").option("encoding", encoding).csv(f"{path}/b")
    back = occurrences.read_pipe_csv(spark, path, pattern="*.csv", recursive=True)
    return back.select("id", F.col("ANO").cast("int").alias("ano"), F.col("TIPO").alias("tipo"), F.col("LOCAL").alias("local"))


def yearly_csv_roundtrip(spark, d):
    path = scratch_path(spark, "yearly")
    sinks.write_yearly_csv(_feed(spark, d), path)
    back = occurrences.read_pipe_csv(spark, path, pattern="*.csv", recursive=True)
    return back.select("id", F.col("LOCAL").alias("local"), F.col("AREATOTAL").cast("bigint").alias("area"))


def yearly_csv_order(spark, d):
    """Files of a year hold disjoint id ranges in text order: rows that stand before the row above them."""
    path = scratch_path(spark, "yearly-order")
    sinks.write_yearly_csv(_feed(spark, d), path)
    lines = spark.read.text(path).select(
        F.regexp_extract(F.col("_metadata.file_path"), "ANO=([0-9]+)", 1).cast("int").alias("ano"), F.col("_metadata.file_path").alias("file"),
        F.element_at(F.split("value", "\\|"), 1).alias("id")).filter("id <> 'id'")
    spans = lines.groupBy("ano", "file").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n"))
    other = spans.select(F.col("ano").alias("a"), F.col("file").alias("f"), F.col("low").alias("l"), F.col("high").alias("h"))
    clash = spans.join(other, (F.col("ano") == F.col("a")) & (F.col("file") != F.col("f")) & (F.col("low") <= F.col("h")) & (F.col("l") <= F.col("high")), "left_semi")
    clashes = clash.groupBy("ano").agg(F.count(F.lit(1)).alias("clashes"))
    return spans.groupBy("ano").agg(F.sum("n").alias("rows")).join(clashes, "ano", "left").select("ano", "rows", F.coalesce("clashes", F.lit(0)).alias("clashes"))


def xml_roundtrip(spark, d):
    path = scratch_path(spark, "xml")
    feed = _feed(spark, d).withColumn("TIPO", F.when(F.col("TIPO") == "NA", "|").otherwise(F.col("TIPO")))
    feed.withColumnRenamed("id", "_id").write.format("xml").option("rootTag", "list").option("rowTag", "item").save(path)
    back = occurrences.read_occurrence_xml(spark, path, "item")
    return back.select("id", F.col("ANO").cast("int").alias("ano"), F.col("TIPO").alias("tipo"), F.col("LOCAL").alias("local"), F.col("DISTRITO").alias("distrito"))


def weather_json_roundtrip(spark, d):
    """Daily extremes of each user as one landed reply per user, a line each; the last maximum is cut off."""
    path = scratch_path(spark, "weather-json")
    e = star.table(spark, d, "events")
    days = e.groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.max("value").alias("hi"), F.min("value").alias("lo"))
    reply = days.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("day", "hi", "lo"))).alias("r"))
    body = F.struct(
        F.col("user_id").cast("double").alias("latitude"), F.lit(-8.5).alias("longitude"),
        F.struct(F.col("r.day").alias("time"), F.slice("r.hi", 1, F.size("r") - 1).alias("temperature_2m_max"), F.col("r.lo").alias("temperature_2m_min")).alias("daily"))
    reply.select(F.to_json(body).alias("value")).write.text(path)
    back = lookups.daily_weather(lookups.read_weather_json(spark, path, lines=True))
    return back.select(F.col("lat").cast("bigint").alias("user_id"), "date", "temp_max", "temp_min")


_WEATHER_JSON_SQL = """
WITH days AS (SELECT user_id, CAST(ts AS DATE) AS date, max(value) AS hi, min(value) AS lo FROM events GROUP BY ALL)
SELECT user_id, date, CASE WHEN date < max(date) OVER (PARTITION BY user_id) THEN hi END AS temp_max, lo AS temp_min FROM days"""


def boundary_roundtrip(spark, d):
    path = scratch_path(spark, "boundaries")
    _parishes(spark, d).drop("area").write.json(path)
    units = units_from_boundaries(lookups.read_boundaries(spark, path, "json"))
    return units.select("code", "code_parent", "name", F.round("area", 4).alias("area"))


_BOUNDARY_SQL = """
WITH parish AS (
  SELECT lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS code,
         c_name, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT code, substring(code, 1, 4) AS code_parent, c_name AS name, count(*)::DOUBLE AS area FROM parish GROUP BY ALL
UNION ALL SELECT substring(code, 1, 4), substring(code, 1, 2), n_name, count(*)::DOUBLE FROM parish GROUP BY ALL
UNION ALL SELECT substring(code, 1, 2), NULL, r_name, count(*)::DOUBLE FROM parish GROUP BY ALL"""


def perimeter_roundtrip(spark, d):
    path = scratch_path(spark, "perimeters")
    w, h = F.col("l_quantity"), F.col("l_discount") * 100

    def v(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    zero = F.lit(0.0)
    ring = F.array(v(zero, zero), v(w, zero), v(w, h), v(zero, h), v(zero, zero))
    star.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("fire_id"), F.col("l_linenumber").alias("part"), F.array(ring).alias("rings")).write.parquet(path)
    parts = spatial.perimeter_parts(lookups.read_perimeters(spark, path))
    return parts.groupBy("fire_id").agg(F.count(F.lit(1)).alias("parts"), F.round(F.sum("area"), 4).alias("area"))


_PERIMETER_SQL = """
WITH parts AS (SELECT DISTINCT l_orderkey AS fire_id, l_quantity AS w, round(l_discount * 100, 5) AS h FROM lineitem WHERE l_discount > 0)
SELECT fire_id, count(*) AS parts, round(sum(w * h), 4) AS area FROM parts GROUP BY fire_id"""


def files_found(spark, d):
    """Folders of yearly files, found by pattern and in the order of their names."""
    path = scratch_path(spark, "files")
    sinks.write_yearly_csv(_feed(spark, d), path)
    found = occurrences.find_files(spark, path, "*.csv", recursive=True)
    return found.select(F.regexp_extract("path", "ANO=([0-9]+)", 1).cast("int").alias("ano")).distinct()


def typed_ingest(spark, d):
    """Typed cells; every seventh area is no number, and its row is told apart."""
    text = _feed(spark, d).withColumn("AREATOTAL", F.when(F.col("id").cast("bigint") % 7 == 0, "n/d").otherwise(F.col("AREATOTAL")))
    typed = occurrences.typed_occurrences(text)
    good = occurrences.accepted(typed).select("original_id", "ANO", F.col("AREATOTAL").alias("area"), F.lit(None).cast("string").alias("bad"))
    bad = occurrences.quarantined(typed).select("original_id", "ANO", F.col("AREATOTAL").alias("area"), F.array_join("bad_columns", ",").alias("bad"))
    return good.unionByName(bad).withColumnRenamed("ANO", "ano")


def weather_sinks(spark, d):
    """Detail and summary files written together and read back."""
    path = scratch_path(spark, "weather")
    detail = weather_detail(spark, d)
    sinks.write_weather(detail, weather.weather_summary(detail), path)
    back = spark.read.option("header", "true").csv(f"{path}/meteorology")
    days = back.groupBy("incident_id").agg(F.count(F.lit(1)).alias("days"), F.max(F.col("temp_max").cast("double")).alias("temp_max"))
    summary = spark.read.option("header", "true").csv(f"{path}/summary").select("incident_id", F.col("n_days").cast("bigint").alias("n_days"))
    return days.join(summary, "incident_id")


def fact_sink(spark, d):
    """A year-partitioned fact of which one year is written again."""
    path = scratch_path(spark, "fact")
    fires = star.fires(spark, d).select("id", "year", "ts", "total_area")
    sinks.write_fact(fires, path)
    sinks.write_fact(fires.filter("year = 1995").withColumn("total_area", F.lit(1.0)), path)
    return spark.read.parquet(path).select("id", F.col("year").cast("int").alias("year"), "ts", "total_area")


def custom_filter(spark, d):
    """A filter of the user's own in a chain with the area filter."""
    chain = filters.FilterChain().add(filters.drop_small_areas(5_000_000)).add(
        filters.custom("even", "keeps even ids", lambda df: df.filter(F.col("id").cast("bigint") % 2 == 0)))
    return chain.apply(_feed(spark, d)).select("id", F.col("AREATOTAL").cast("bigint").alias("area"))


def landed_months(spark, d):
    """Orders of the landed pulls that a refresh of seventy days reads."""
    pulls = incremental.landed_periods(dt.date(1998, 3, 15), 70)
    months = spark.createDataFrame([(y, m) for y, m, _ in pulls], "y int, m int")
    o = star.table(spark, d, "orders")
    return o.join(months, (F.year("o_orderdate") == F.col("y")) & (F.month("o_orderdate") == F.col("m")), "left_semi").select("o_orderkey", "o_orderdate")


def build_then_refresh(spark, d):
    """A fact built from landed files up to a day, then refreshed from all of them from that day on."""
    start, root = dt.date(1998, 1, 1), scratch_path(spark, "warehouse")
    points = _fire_points(spark, d).select(F.col("id").cast("string").alias("id"), F.col("lon").cast("string").alias("LON"), F.col("lat").cast("string").alias("LAT"))
    stamp = F.col("o_orderdate")
    dated = star.table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.month(stamp).cast("string").alias("MES"), F.dayofmonth(stamp).cast("string").alias("DIA"), F.hour(stamp).cast("string").alias("HORA"))
    text = _feed(spark, d).withColumn("TIPO", F.regexp_replace("TIPO", "^NA$", "4")).join(points, "id").join(dated, "id")
    text = text.select(*[F.col(c) if c in text.columns else F.lit(None).cast("string").alias(c) for c in schema.OCCURRENCE_COLUMNS])
    text = text.withColumn("source_file", F.concat("ANO", F.lit(".csv")))
    sinks.write_pipe_csv(text.filter(f"ANO < '{start.year}'"), f"{root}/old")
    sinks.write_pipe_csv(text, f"{root}/all")
    parishes = _nation_polygons(spark, d).withColumn("code", F.col("code").cast("string"))
    jobs.build_fact(spark, f"{root}/old", parishes, f"{root}/store", cell=20.0, recursive=True)
    jobs.build_fact(spark, f"{root}/all", parishes, f"{root}/store", start=start, cell=20.0, recursive=True)
    kinds = spark.read.parquet(f"{root}/store/ref/fire_type").select(F.col("id").alias("k"), "raw_name")
    fact = spark.read.parquet(f"{root}/store/fire")
    return fact.join(kinds, F.col("id_ref_fire_type") == F.col("k")).select(
        F.col("original_id").cast("bigint").alias("id"), F.col("year").cast("int").alias("year"), F.col("id_rel_lau").cast("int").alias("code"),
        "raw_name", "total_area")


_BUILD_SQL = f"""WITH {_PIP_BASE}
SELECT id, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(code AS INTEGER) AS code,
       lower(CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '4' ELSE o_orderpriority END) AS raw_name,
       CAST(round(o_totalprice * 100) AS BIGINT) * 10000.0::DOUBLE AS total_area
FROM hits JOIN orders ON o_orderkey = id"""


QUERIES = {
    "csv_roundtrip": (csv_roundtrip, f"WITH {_FEED_SQL} SELECT id, ano, tipo, local FROM feed"),
    "yearly_csv_roundtrip": (yearly_csv_roundtrip, f"WITH {_FEED_SQL} SELECT id, local, area FROM feed"),
    "yearly_csv_order": (yearly_csv_order, f"WITH {_FEED_SQL} SELECT ano, count(*) AS rows, CAST(0 AS BIGINT) AS clashes FROM feed GROUP BY ano"),
    "xml_roundtrip": (xml_roundtrip, f"WITH {_FEED_SQL} SELECT id, ano, coalesce(tipo, '/') AS tipo, local, CAST(NULL AS VARCHAR) AS distrito FROM feed"),
    "weather_json_roundtrip": (weather_json_roundtrip, _WEATHER_JSON_SQL),
    "boundary_roundtrip": (boundary_roundtrip, _BOUNDARY_SQL),
    "perimeter_roundtrip": (perimeter_roundtrip, _PERIMETER_SQL),
    "files_found": (files_found, f"WITH {_FEED_SQL} SELECT DISTINCT ano FROM feed"),
    "typed_ingest": (typed_ingest, f"""WITH {_FEED_SQL}
SELECT id AS original_id, ano, CASE WHEN CAST(id AS BIGINT) % 7 <> 0 THEN area::DOUBLE END AS area,
       CASE WHEN CAST(id AS BIGINT) % 7 = 0 THEN 'AREATOTAL' END AS bad FROM feed"""),
    "weather_sinks": (weather_sinks, f"""WITH {_WEATHER_BASE}
SELECT incident_id, count(*) AS days, max(temp_max) AS temp_max, count(DISTINCT date) AS n_days FROM detail GROUP BY incident_id"""),
    "fact_sink": (fact_sink, f"""WITH {star.FIRES_SQL}
SELECT id, year, ts, CASE WHEN year = 1995 THEN 1.0 ELSE total_area END AS total_area FROM fires"""),
    "custom_filter": (custom_filter, f"WITH {_FEED_SQL} SELECT id, area FROM feed WHERE area >= 5000000 AND CAST(id AS BIGINT) % 2 = 0"),
    "landed_months": (landed_months, """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-04-01'"""),
    "build_then_refresh": (build_then_refresh, _BUILD_SQL),
}
