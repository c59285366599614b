"""The supplied tables seen as a fire warehouse.

orders are fires, customers parishes, nations municipalities, regions districts; the first and
last ship date of an order are first response and extinction. An order of unspecified priority
is a fire of unknown area.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_AREA = 10000.0

# Declared schemas: no job is spent on reading file footers while a plan is built.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("year"), F.col("o_orderdate").alias("ts"),
        F.col("o_custkey").alias("id_rel_lau"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_totalprice")).alias("total_area"),
        F.col("o_orderstatus").alias("id_ref_cause_type"), F.col("o_orderpriority").alias("id_ref_fire_type"),
        F.col("o_orderdate").alias("alarm_ts"))


def timed_fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fires with first response and extinction taken from their line items."""
    times = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("fire_id")).agg(
        F.min("l_shipdate").alias("first_response_ts"), F.max("l_shipdate").alias("extinguishing_ts"))
    return fires(spark, sf_dir).join(times, F.col("id") == F.col("fire_id"), "left").drop("fire_id")


def event_fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as fires with a time of day; the user is the parish, the type the cause."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"), F.year("ts").alias("year"), "ts", F.col("user_id").alias("id_rel_lau"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("total_area"),
        F.col("event_type").alias("id_ref_cause_type"))


def lau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`code, code_parent, name, level, area`; areas of parishes are account balances plus 1000."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    l3 = c.select(F.col("c_custkey").alias("code"), F.col("c_nationkey").cast("bigint").alias("code_parent"),
                  F.col("c_name").alias("name"), F.lit(3).alias("level"), (F.col("c_acctbal") + 1000).alias("area"))
    l2 = n.select(F.col("n_nationkey").cast("bigint").alias("code"), F.col("n_regionkey").cast("bigint").alias("code_parent"),
                  F.col("n_name").alias("name"), F.lit(2).alias("level"), F.lit(None).cast("double").alias("area"))
    l1 = r.select(F.col("r_regionkey").cast("bigint").alias("code"), F.lit(None).cast("bigint").alias("code_parent"),
                  F.col("r_name").alias("name"), F.lit(1).alias("level"), F.lit(None).cast("double").alias("area"))
    return l3.unionByName(l2).unionByName(l1)


def cause_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cause types by id; the unspecific status has no code."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("id")).distinct()
    return o.select("id", F.when(F.col("id") != "P", F.concat(F.lit("STATUS_"), "id")).alias("code"))


def event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("id")).distinct()
    return e.select("id", F.upper("id").alias("code"))


# The same views for the check SQL.
GEO_SQL = """
geo AS (
  SELECT c_custkey AS lau3_code, c_name AS lau3, CAST(n_nationkey AS BIGINT) AS lau2_code, n_name AS lau2,
         CAST(r_regionkey AS BIGINT) AS lau1_code, r_name AS lau1, c_acctbal + 1000 AS lau3_area
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
)"""
FIRES_SQL = """
fires AS (
  SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderdate AS ts, o_custkey AS id_rel_lau,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_totalprice END AS total_area,
         o_orderstatus AS id_ref_cause_type, o_orderpriority AS id_ref_fire_type, o_orderdate AS alarm_ts
  FROM orders
)"""
TIMES_SQL = """
timed AS (
  SELECT f.*, t.first_response_ts, t.extinguishing_ts
  FROM fires f LEFT JOIN (
    SELECT l_orderkey, min(l_shipdate) AS first_response_ts, max(l_shipdate) AS extinguishing_ts
    FROM lineitem GROUP BY l_orderkey) t ON f.id = t.l_orderkey
)"""
EVENT_FIRES_SQL = """
fires AS (
  SELECT event_id AS id, CAST(year(ts) AS INTEGER) AS year, ts, user_id AS id_rel_lau,
         CASE WHEN event_type <> 'view' THEN value END AS total_area, event_type AS id_ref_cause_type
  FROM events
)"""
