"""Cleaning, parsing, conforming and incremental queries with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinderlake import schema
from cinderlake.catalog import star
from cinderlake.functions import parsing as p
from cinderlake.operators import dimensions, filters, incremental
from cinderlake.plans import conform
from cinderlake.sources.lookups import explode_daily


def _lineitem(spark, d):
    return star.table(spark, d, "lineitem")


# --- row filters: line items written out as untidy occurrence text ---------------------------

def occurrence_text(spark, d):
    """Line items with text flags, decimal commas, unreadable areas and missing types."""
    def comma(c):
        return F.replace(c.cast("string"), F.lit("."), F.lit(","))

    flag = F.col("l_returnflag")
    line = F.col("l_linenumber")
    return _lineitem(spark, d).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.when(flag == "A", "SIM").when(flag == "N", "0").alias("FALSOALARME"),
        comma(F.col("l_tax")).alias("LAT"), F.col("l_discount").cast("string").alias("LON"),
        F.when(line == 7, "n/d").otherwise(comma(F.col("l_quantity") / 50)).alias("AREATOTAL"),
        F.when(line == 1, "QUEIMADA").when(line == 2, "Agrícola").when(line == 3, "queimada")
         .when(line != 4, "Florestal").alias("TIPO"))


_TEXT_SQL = """
text AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CASE l_returnflag WHEN 'A' THEN 'SIM' WHEN 'N' THEN '0' END AS falsoalarme,
         l_tax AS lat, l_discount AS lon,
         CASE WHEN l_linenumber <> 7 THEN l_quantity / 50 END AS area,
         CASE WHEN l_linenumber = 1 THEN 'QUEIMADA' WHEN l_linenumber = 2 THEN 'Agrícola'
              WHEN l_linenumber = 3 THEN 'queimada' WHEN l_linenumber <> 4 THEN 'Florestal' END AS tipo
  FROM lineitem
),
tagged AS (
  SELECT *, CASE WHEN falsoalarme IN ('1','SIM','TRUE','YES','S','Y','T') THEN 1
                 WHEN lat IS NULL OR lon IS NULL OR (lat = 0 AND lon = 0) THEN 2
                 WHEN area < 0.5 THEN 3
                 WHEN tipo = 'QUEIMADA' THEN 4
                 WHEN tipo = 'Agrícola' THEN 5 END AS step
  FROM text
)"""


def clean_filters(spark, d):
    kept = filters.default_chain().apply(occurrence_text(spark, d))
    return kept.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                       F.round(p.num("AREATOTAL"), 4).alias("area"), F.col("TIPO").alias("tipo"))


def clean_metrics(spark, d):
    return filters.default_chain().report(occurrence_text(spark, d)).withColumn(
        "removed_share", F.round("removed_share", 6))


_METRICS_SQL = f"""WITH {_TEXT_SQL},
names(step, filter) AS (VALUES (1, 'false_alarm'), (2, 'missing_coordinates'), (3, 'small_area'),
                               (4, 'tipo_queimada'), (5, 'tipo_agrícola')),
removed AS (SELECT step, count(*) AS removed FROM tagged WHERE step IS NOT NULL GROUP BY step),
rows AS (SELECT count(*) AS n FROM tagged),
per AS (SELECT n.step, n.filter, coalesce(r.removed, 0) AS removed FROM names n LEFT JOIN removed r ON n.step = r.step
        UNION ALL SELECT 6, 'total', (SELECT CAST(sum(removed) AS BIGINT) FROM removed))
SELECT CAST(step AS INTEGER) AS step, filter, removed, (SELECT n FROM rows) AS original,
       round(removed / (SELECT n FROM rows), 6) AS removed_share
FROM per"""


# --- parsing ---------------------------------------------------------------------------------

def parse_numbers(spark, d):
    e = star.table(spark, d, "events")
    text = F.replace(F.col("value").cast("string"), F.lit("."), F.lit(","))
    text = F.when(F.col("event_type") == "error", F.concat(text, F.lit(" ha"))).otherwise(text)
    return e.select("event_type", p.num(text).alias("v")).groupBy("event_type").agg(
        F.count("v").alias("numbers"), F.round(F.sum("v"), 2).alias("total"))


_NUMBERS_SQL = """
SELECT event_type, count(CASE WHEN event_type <> 'error' THEN value END) AS numbers,
       round(sum(CASE WHEN event_type <> 'error' THEN value END), 2) AS total
FROM events GROUP BY event_type"""


def parse_moments(spark, d):
    """Day-first dates and clock times back to timestamps, and the hour stamp from its parts."""
    e = star.table(spark, d, "events")
    time = F.when(F.col("event_type") != "error", F.date_format("ts", "HH:mm"))
    return e.select(
        "event_id", p.day_and_time(F.date_format("ts", "dd-MM-yyyy"), time).alias("alarm_ts"),
        p.hour_stamp(F.year("ts"), F.month("ts"), F.day("ts"), F.hour("ts")).alias("hour_ts"))


_MOMENTS_SQL = """
SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('minute', ts) END AS alarm_ts,
       date_trunc('hour', ts) AS hour_ts
FROM events"""


def flag_values(spark, d):
    e = star.table(spark, d, "events")
    t = F.col("event_type")
    text = F.when(t == "view", "sim").when(t == "click", "NAO").when(t == "error", "1").when(t == "signup", "0") \
            .otherwise("talvez")
    return e.select("event_type", p.flag(text).alias("flag")).groupBy("event_type", "flag").agg(
        F.count(F.lit(1)).alias("count"))


_FLAGS_SQL = """
SELECT event_type, CASE WHEN event_type IN ('view', 'error') THEN true
                        WHEN event_type IN ('click', 'signup') THEN false END AS flag, count(*) AS count
FROM events GROUP BY ALL"""


def unit_inference(spark, d):
    parts = star.table(spark, d, "part").select("p_partkey", "p_brand", "p_retailprice")
    scaled = conform.infer_unit(parts, "p_retailprice", "p_brand", 999.0, 0.5, "price")
    return scaled.select("p_partkey", "p_brand", F.round("price", 4).alias("price"))


_UNIT_SQL = """
WITH typical AS (SELECT p_brand, quantile_cont(p_retailprice, 0.5) AS m FROM part GROUP BY p_brand)
SELECT p_partkey, p.p_brand, round(CASE WHEN m > 999.0 THEN p_retailprice * 0.5 ELSE p_retailprice END, 4) AS price
FROM part p JOIN typical t ON p.p_brand = t.p_brand"""


def file_url_list(spark, d):
    parts = star.table(spark, d, "part")
    cells = [F.when(F.col("p_size") > 25, F.col("p_brand")), F.when(F.col("p_type") == "PROMO", F.col("p_name")),
             F.when(F.col("p_size") < 10, F.lit(""))]
    return parts.select("p_partkey", p.joined_list(cells).alias("file_urls"))


_URLS_SQL = """
SELECT p_partkey, nullif(trim(concat_ws(',', CASE WHEN p_size > 25 THEN p_brand END,
       CASE WHEN p_type = 'PROMO' THEN p_name END, CASE WHEN p_size < 10 THEN '' END)), '') AS file_urls
FROM part"""


def url_file_names(spark, d):
    return star.table(spark, d, "pages").select("page_id", p.file_name("url").alias("file_name"))


def array_explode(spark, d):
    rows = star.table(spark, d, "embeddings").select(
        "vec_id", "embedding", F.slice("embedding", 1, F.size("embedding") - 2).alias("shorter"))
    out = explode_daily(rows, ["vec_id"], "embedding", {"temp_max": "embedding", "temp_min": "shorter"}, "pos")
    return out.select("vec_id", "pos", F.round(F.col("temp_max").cast("double"), 6).alias("temp_max"),
                      F.round(F.col("temp_min").cast("double"), 6).alias("temp_min"))


_EXPLODE_SQL = """
SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, round(CAST(embedding[i] AS DOUBLE), 6) AS temp_max,
       CASE WHEN i <= len(embedding) - 2 THEN round(CAST(embedding[i] AS DOUBLE), 6) END AS temp_min
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)"""


# --- conforming ------------------------------------------------------------------------------

def conform_projection(spark, d):
    """Orders written as typed occurrences and projected to fact columns."""
    f = star.timed_fires(spark, d)
    first, last = F.col("first_response_ts"), F.col("extinguishing_ts")
    text = {
        "DATAALERTA": F.date_format("ts", "dd-MM-yyyy"), "HORAALERTA": F.lit("06:30"),
        "DATA1INTERVENCAO": F.date_format(first, "dd-MM-yyyy"), "HORA1INTERVENCAO": F.lit("7:05"),
        "DATAEXTINCAO": F.date_format(last, "dd-MM-yyyy"),
        "HORAEXTINCAO": F.when(F.col("id_ref_cause_type") != "P", F.lit("23:59")),
        "AREASFICHEIROS_GNR": F.when(F.col("id_ref_cause_type") == "O", F.lit("a.zip")),
        "AREASFICHEIROZIP_SAA": F.when(F.col("id_ref_fire_type") == "1-URGENT", F.lit("b.zip")),
    }
    numbers = {
        "ANO": F.col("year"), "MES": F.month("ts"), "DIA": F.day("ts"), "HORA": F.lit(6), "NCCO": F.col("id_rel_lau"),
        "AREATOTAL": F.col("total_area"), "LON": F.col("total_area") / 1000, "LAT": F.col("id_rel_lau") / 1000,
        "REACENDIMENTOS": F.when(F.col("id_ref_fire_type") == "5-LOW", F.lit(1)).when(
            F.col("id_ref_fire_type") == "2-HIGH", F.lit(0)),
        "PRECEPITACAO": F.when(F.col("id_ref_cause_type") == "F", F.lit(schema.PRECIPITATION_SENTINEL)).otherwise(
            F.lit(0.5)),
    }
    types = schema.typed_columns()
    typed = f.select(F.col("id").cast("string").alias("original_id"), *[
        (text.get(c, numbers.get(c, F.lit(None)))).cast(types[c]).alias(c) for c in types if c != "id"])
    fact = conform.fact_projection(typed)
    return fact.select(
        "original_id", "year", "ts", "rekindle", F.round("total_area", 2).alias("total_area"), "cco_id", "alarm_ts",
        "first_response_ts", "extinguishing_ts", "precipitation", "file_urls",
        F.round("lon", 5).alias("lon"), F.round("lat", 5).alias("lat"))


_CONFORM_SQL = f"""WITH {star.FIRES_SQL}, {star.TIMES_SQL}
SELECT CAST(id AS VARCHAR) AS original_id, year, date_trunc('day', ts) + INTERVAL 6 HOUR AS ts,
       CASE id_ref_fire_type WHEN '5-LOW' THEN true WHEN '2-HIGH' THEN false END AS rekindle,
       round(total_area * 10000, 2) AS total_area, CAST(id_rel_lau AS VARCHAR) AS cco_id,
       date_trunc('day', ts) + INTERVAL 390 MINUTE AS alarm_ts,
       date_trunc('day', first_response_ts) + INTERVAL 425 MINUTE AS first_response_ts,
       CASE WHEN id_ref_cause_type <> 'P' THEN date_trunc('day', extinguishing_ts) + INTERVAL 1439 MINUTE END AS extinguishing_ts,
       CASE WHEN id_ref_cause_type <> 'F' THEN 0.5::DOUBLE END AS precipitation,
       nullif(trim(concat_ws(',', CASE WHEN id_ref_cause_type = 'O' THEN 'a.zip' END,
                             CASE WHEN id_ref_fire_type = '1-URGENT' THEN 'b.zip' END)), '') AS file_urls,
       round(round_even(total_area / 1000 / 1e-5, 0) * 1e-5, 5) AS lon,
       round(round_even(id_rel_lau / 1000 / 1e-5, 0) * 1e-5, 5) AS lat
FROM timed"""

_EVENT_CODES = [("view", "SEEN"), ("click", "USED"), ("purchase", "BOUGHT")]


def decode_codes(spark, d):
    """Labels become a dimension with ids, ids get codes, and rows are decoded through both."""
    e = star.table(spark, d, "events").select(F.initcap("event_type").alias("label"))
    empty = spark.createDataFrame([], "id int, raw_name string, code string")
    codes = spark.createDataFrame(_EVENT_CODES, "raw_name string, code string")
    dim = dimensions.map_codes(dimensions.extend_dimension(e, "label", empty), codes)
    rows = dimensions.decode(dimensions.lookup_id(e, "label", dim, "type_id"), "type_id", dim, "code")
    return rows.groupBy(F.lower("label").alias("raw_name"), "code").agg(
        F.count(F.lit(1)).alias("count"), F.count("type_id").alias("with_id"))


_DECODE_SQL = """
SELECT lower(event_type) AS raw_name,
       CASE event_type WHEN 'view' THEN 'SEEN' WHEN 'click' THEN 'USED' WHEN 'purchase' THEN 'BOUGHT' END AS code,
       count(*) AS count, count(*) AS with_id
FROM events GROUP BY ALL"""


def new_members(spark, d):
    parts = star.table(spark, d, "part").select(F.concat_ws(" ", "p_type", "p_brand").alias("label"), "p_size")
    known = parts.filter(F.col("p_size") > 44).select(F.lower("label").alias("raw_name")).distinct()
    return dimensions.new_members(parts, "label", known)


_NEW_SQL = """
WITH labels AS (SELECT lower(p_type || ' ' || p_brand) AS raw_name, p_size FROM part)
SELECT DISTINCT raw_name FROM labels WHERE raw_name NOT IN (SELECT raw_name FROM labels WHERE p_size > 44)"""


def number_members(spark, d):
    """Ids of new dimension members: consecutive from one, the same on every run."""
    members = dimensions.distinct_members(
        star.table(spark, d, "part").select(F.concat_ws(" ", "p_type", "p_brand").alias("label")), "label")
    ids = dimensions.number_rows(members, "raw_name", 1)
    return ids.agg(F.count(F.lit(1)).alias("members"), F.count_distinct("id").alias("ids"),
                   F.min("id").alias("first_id"), F.max("id").alias("last_id"))


_NUMBER_SQL = """
WITH m AS (SELECT count(DISTINCT p_type || ' ' || p_brand) AS n FROM part)
SELECT n AS members, n AS ids, CAST(1 AS INTEGER) AS first_id, CAST(n AS INTEGER) AS last_id FROM m"""


# --- incremental -----------------------------------------------------------------------------

_TIE = ["ingest_seq", "l_linenumber", "l_partkey", "l_suppkey", "value"]
_START = "1999-03-15"


def _pulls(spark, d):
    """Line items as (stored, fresh) pulls of occurrences keyed by year and order."""
    rows = _lineitem(spark, d).select(
        F.year("l_shipdate").alias("year"), F.col("l_orderkey").alias("original_id"), F.col("l_shipdate").alias("ts"),
        "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("value"), "l_linestatus")
    stored = rows.withColumn("ingest_seq", F.lit(0)).drop("l_linestatus")
    fresh = rows.filter("l_linestatus = 'O'").withColumn("value", F.col("value") + 1).withColumn(
        "ingest_seq", F.lit(1)).drop("l_linestatus")
    return stored, fresh


def refresh_upsert(spark, d):
    stored, fresh = _pulls(spark, d)
    once = incremental.pick_per_key(incremental.keep_before(stored, "ts", _START), ["year", "original_id"], list(_TIE))
    out = incremental.refresh(once, fresh, _START, order=tuple(_TIE))
    return out.select("year", "original_id", "ts", "l_linenumber", "ingest_seq", F.round("value", 2).alias("value"))


_PULLS_SQL = """
stored AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_orderkey AS original_id, l_shipdate AS ts, l_linenumber,
                  l_partkey, l_suppkey, l_extendedprice AS value, CAST(0 AS INTEGER) AS ingest_seq FROM lineitem),
fresh AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_orderkey AS original_id, l_shipdate AS ts, l_linenumber,
                 l_partkey, l_suppkey, l_extendedprice + 1 AS value, CAST(1 AS INTEGER) AS ingest_seq
          FROM lineitem WHERE l_linestatus = 'O')"""


def _latest_sql(source):
    return f"""WITH {_PULLS_SQL},
merged AS ({source}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY year, original_id
           ORDER BY ingest_seq DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, value DESC, ts DESC) AS rn FROM merged)
SELECT year, original_id, {{ts}} l_linenumber, ingest_seq, round(value, 2) AS value FROM ranked WHERE rn = 1"""


_REFRESH_SQL = _latest_sql(
    f"SELECT * FROM stored WHERE ts < TIMESTAMP '{_START}' UNION ALL SELECT * FROM fresh WHERE ts >= TIMESTAMP '{_START}'"
).format(ts="ts,")


def dedup_last_wins(spark, d):
    stored, fresh = _pulls(spark, d)
    out = incremental.last_write_wins(
        stored.unionByName(fresh), ("year", "original_id"), (*_TIE, "ts"))
    return out.select("year", "original_id", "l_linenumber", "ingest_seq", F.round("value", 2).alias("value"))


_LAST_SQL = _latest_sql("SELECT * FROM stored UNION ALL SELECT * FROM fresh").format(ts="")


def concat_dedup(spark, d):
    fresh = star.table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("amount"))
    stored = star.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("seq"), F.col("c_acctbal").alias("amount"))
    return incremental.concat_dedup(fresh, stored, ("id",), ("seq",))


_CONCAT_SQL = """
WITH u AS (SELECT o_custkey AS id, o_orderkey AS seq, o_totalprice AS amount, 0 AS side FROM orders
           UNION ALL SELECT c_custkey, c_custkey, c_acctbal, 1 FROM customer),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY side, seq, amount) AS rn FROM u)
SELECT id, seq, amount FROM r WHERE rn = 1"""


def upsert_audit(spark, d):
    at = F.lit("2020-01-01").cast("timestamp_ntz")
    stored = star.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value"), at.alias("created_ts"), at.alias("updated_ts"))
    fresh = star.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.max("o_totalprice").alias("value")).withColumn("created_ts", at).withColumn("updated_ts", at)
    fresh = fresh.withColumn("id", F.col("id") + 700)  # some keys are new, some are known
    return incremental.upsert(stored, fresh, ["id"], F.lit("2024-02-03").cast("timestamp_ntz"))


_UPSERT_SQL = """
WITH fresh AS (SELECT o_custkey + 700 AS id, max(o_totalprice) AS value FROM orders GROUP BY 1)
SELECT coalesce(f.id, c.c_custkey) AS id, coalesce(f.value, c.c_acctbal) AS value,
       CASE WHEN c.c_custkey IS NULL THEN TIMESTAMP '2024-02-03' ELSE TIMESTAMP '2020-01-01' END AS created_ts,
       CASE WHEN f.id IS NULL THEN TIMESTAMP '2020-01-01' ELSE TIMESTAMP '2024-02-03' END AS updated_ts
FROM customer c FULL JOIN fresh f ON c.c_custkey = f.id"""


def rows_from_date(spark, d):
    o = star.table(spark, d, "orders").select(
        F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes"), F.day("o_orderdate").alias("dia"))
    late = o.filter(p.on_or_after(F.col("ano"), F.col("mes"), F.col("dia"), "1998-11-20"))
    return late.groupBy("ano", "mes").agg(F.count(F.lit(1)).alias("count"))


_FROM_SQL = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes, count(*) AS count
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-11-20' GROUP BY ALL"""


def backfill_columns(spark, d):
    o = star.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return incremental.backfill(o, star.table(spark, d, "customer"), ("o_custkey", "c_custkey"), ["c_mktsegment"])


_BACKFILL_SQL = "SELECT o_orderkey, o_custkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey"

QUERIES = {
    "clean_filters": (clean_filters, f"""WITH {_TEXT_SQL}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(area, 4) AS area, tipo FROM tagged WHERE step IS NULL"""),
    "clean_metrics": (clean_metrics, _METRICS_SQL),
    "parse_numbers": (parse_numbers, _NUMBERS_SQL),
    "parse_moments": (parse_moments, _MOMENTS_SQL),
    "flag_values": (flag_values, _FLAGS_SQL),
    "unit_inference": (unit_inference, _UNIT_SQL),
    "file_url_list": (file_url_list, _URLS_SQL),
    "url_file_names": (url_file_names, "SELECT page_id, url_encode(string_split(url, '/')[-1]) AS file_name FROM pages"),
    "array_explode": (array_explode, _EXPLODE_SQL),
    "conform_projection": (conform_projection, _CONFORM_SQL),
    "decode_codes": (decode_codes, _DECODE_SQL),
    "new_members": (new_members, _NEW_SQL),
    "number_members": (number_members, _NUMBER_SQL),
    "refresh_upsert": (refresh_upsert, _REFRESH_SQL),
    "dedup_last_wins": (dedup_last_wins, _LAST_SQL),
    "concat_dedup": (concat_dedup, _CONCAT_SQL),
    "upsert_audit": (upsert_audit, _UPSERT_SQL),
    "rows_from_date": (rows_from_date, _FROM_SQL),
    "backfill_columns": (backfill_columns, _BACKFILL_SQL),
}
