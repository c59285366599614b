"""Analytical questions over the fire star, and the streaming forms, with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinderlake.catalog import star
from cinderlake.catalog.cleaning_queries import _lineitem
from cinderlake.catalog.place_queries import daily_region_weather
from cinderlake.functions.parsing import millis_between
from cinderlake.operators.geography import flatten_geography, with_geography
from cinderlake.plans import analysis
from cinderlake.session import scratch_path
from cinderlake.streaming import live


def _flat(spark, d):
    return flatten_geography(star.lau(spark, d))


def _round(df, **digits):
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


def _exact(df):
    """Areas as decimals of two digits: their sums, and so the rounded means, don't depend on the order of rows."""
    return df.withColumn("total_area", F.col("total_area").cast("decimal(18,2)"))


def _doubles(df, *names):
    return df.select(*[F.col(c).cast("double").alias(c) if c in names else F.col(c) for c in df.columns])


def _district_areas(spark, d):
    c, n = star.table(spark, d, "customer"), star.table(spark, d, "nation")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(
        F.col("n_regionkey").cast("bigint").alias("lau1_code")).agg((F.sum(F.col("c_acctbal") + 1000) * 1000).alias("area"))


_BASE = f"{star.GEO_SQL}, {star.FIRES_SQL}"
_FROM = "FROM fires f LEFT JOIN geo g ON f.id_rel_lau = g.lau3_code"
_AREAS = "areas AS (SELECT lau1_code, sum(lau3_area) * 1000 AS area FROM geo GROUP BY 1)"


# --- areas -----------------------------------------------------------------------------------

def unit_rollup(spark, d):
    return _round(analysis.unit_rollup(star.fires(spark, d), _flat(spark, d)), burned_area=2)


_ROLLUP_SQL = f"""WITH {_BASE}
SELECT lau1_code, lau2_code, lau3_code,
       CAST(CASE grouping(lau1_code, lau2_code, lau3_code) WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS INTEGER) AS level,
       count(*) AS fires, round(sum(total_area), 2) AS burned_area
{_FROM} GROUP BY ROLLUP (lau1_code, lau2_code, lau3_code)"""


def share_of_area(spark, d):
    out = analysis.share_of_area(star.fires(spark, d), _flat(spark, d), _district_areas(spark, d))
    return _round(out, burned_area=2, burned_percent=4)


_SHARE_SQL = f"""WITH {_BASE}, {_AREAS}
SELECT b.lau1_code, round(burned, 2) AS burned_area, round(burned * 100 / area, 4) AS burned_percent
FROM (SELECT lau1_code, sum(total_area) AS burned {_FROM} GROUP BY 1) b JOIN areas a ON b.lau1_code = a.lau1_code"""


def density(spark, d):
    out = analysis.density(star.fires(spark, d), _flat(spark, d), _district_areas(spark, d))
    return _round(out, fires_per_km2=6)


_DENSITY_SQL = f"""WITH {_BASE}, {_AREAS}
SELECT b.lau1_code, fires, round(fires * 1e6 / area, 6) AS fires_per_km2
FROM (SELECT lau1_code, count(*) AS fires {_FROM} GROUP BY 1) b JOIN areas a ON b.lau1_code = a.lau1_code"""


def _area_of_units(spark, d, level):
    c, n = star.table(spark, d, "customer"), star.table(spark, d, "nation")
    code = {"lau1_code": "n_regionkey", "lau2_code": "n_nationkey", "lau3_code": "c_custkey"}[level]
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(
        F.col(code).cast("bigint").alias(level)).agg((F.sum(F.col("c_acctbal") + 1000) * 1000).alias("area"))


def _of_all_levels(spark, d, measure):
    parts = [measure(level).select(F.lit(k).alias("level"), F.col(level).alias("code"), *measure.columns)
             for k, level in enumerate(("lau1_code", "lau2_code", "lau3_code"), 1)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def share_of_area_units(spark, d):
    """Burned share of districts, municipalities and parishes."""
    def measure(level):
        return analysis.share_of_area(star.fires(spark, d), _flat(spark, d), _area_of_units(spark, d, level), level)

    measure.columns = ("burned_percent",)
    return _round(_of_all_levels(spark, d, measure), burned_percent=4)


def density_units(spark, d):
    """Fires per area of districts, municipalities and parishes."""
    def measure(level):
        return analysis.density(star.fires(spark, d), _flat(spark, d), _area_of_units(spark, d, level), level=level)

    measure.columns = ("fires", "fires_per_km2")
    return _round(_of_all_levels(spark, d, measure), fires_per_km2=6)


def _levels_sql(select):
    return f"WITH {_BASE}\n" + "\nUNION ALL\n".join(
        f"""SELECT CAST({k} AS INTEGER) AS level, u.code, {select} FROM (SELECT g.lau{k}_code AS code, count(*) AS fires, sum(total_area) AS burned {_FROM} GROUP BY 1) u
LEFT JOIN (SELECT lau{k}_code AS code, sum(lau3_area) * 1000 AS area FROM geo GROUP BY 1) a ON u.code = a.code""" for k in (1, 2, 3))


_SHARE_UNITS_SQL = _levels_sql("round(CASE WHEN area <> 0 THEN burned * 100 / area END, 4) AS burned_percent")
_DENSITY_UNITS_SQL = _levels_sql("fires, round(CASE WHEN area <> 0 THEN fires * 1e6 / area END, 6) AS fires_per_km2")


# --- time ------------------------------------------------------------------------------------

def season_week_counts(spark, d):
    return analysis.season_week_counts(star.fires(spark, d))


_SEASON_SQL = f"""WITH {star.FIRES_SQL}
SELECT CAST(month(ts) AS INTEGER) AS month,
       CASE WHEN month(ts) IN (12, 1, 2) THEN 'winter' WHEN month(ts) IN (3, 4, 5) THEN 'spring'
            WHEN month(ts) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
       CAST(weekofyear(ts) AS INTEGER) AS week, count(*) AS fires
FROM fires GROUP BY ALL"""


def mean_area_monthly(spark, d):
    return _doubles(_round(analysis.mean_area_monthly(_exact(star.fires(spark, d))), mean_area=6), "mean_area")


def month_region_heatmap(spark, d):
    return analysis.month_region_heatmap(star.fires(spark, d), _flat(spark, d))


_HEATMAP_SQL = f"""WITH {_BASE}
SELECT lau1_code, {', '.join(f"count(*) FILTER (month(ts) = {m}) AS m{m}" for m in range(1, 13))}
{_FROM} GROUP BY lau1_code"""


def yearly_trend(spark, d):
    out = _round(analysis.yearly_trend(_exact(star.fires(spark, d))), total_area=2, mean_area=6, slope=4)
    return _doubles(out, "total_area", "mean_area")


_TREND_SQL = f"""WITH {star.FIRES_SQL},
y AS (SELECT year, count(*) AS fires, sum(CAST(total_area AS DECIMAL(18,2)))::DOUBLE AS total_area, avg(CAST(total_area AS DECIMAL(18,2))) AS mean_area FROM fires GROUP BY year)
SELECT year, fires, round(total_area, 2) AS total_area, round(mean_area, 6) AS mean_area,
       fires - lag(fires) OVER (ORDER BY year) AS change,
       round((SELECT regr_slope(fires, year) FROM y), 4) AS slope
FROM y"""

_EDGES, _LABELS = [100000.0, 300000.0], ["small", "medium", "large"]


def size_classes(spark, d):
    return _round(analysis.size_classes(star.fires(spark, d), _EDGES, _LABELS), total_area=2)


_SIZE_SQL = f"""WITH {star.FIRES_SQL}
SELECT CASE WHEN total_area IS NULL THEN NULL WHEN total_area < 100000 THEN 'small' WHEN total_area < 300000 THEN 'medium'
            ELSE 'large' END AS size_class, year, count(*) AS fires, round(sum(total_area), 2) AS total_area
FROM fires GROUP BY ALL"""


def mean_duration_yearly(spark, d):
    return _round(analysis.mean_duration_yearly(star.timed_fires(spark, d)), mean_hours=6)


_DURATION_SQL = f"""WITH {star.FIRES_SQL}, {star.TIMES_SQL}
SELECT year, round(avg(date_diff('microsecond', alarm_ts, extinguishing_ts) / 3.6e9), 6) AS mean_hours
FROM timed WHERE extinguishing_ts > alarm_ts GROUP BY year"""


# --- temperature -----------------------------------------------------------------------------

def _warm_fires(spark, d):
    """Timed fires with their district and the day's extreme temperatures there."""
    located = with_geography(star.timed_fires(spark, d), _flat(spark, d).select("lau3_code", "lau1_code"))
    w = daily_region_weather(spark, d).withColumnRenamed("date", "w_date")
    return located.join(w, (F.col("lau1_code") == F.col("n_regionkey")) & (F.col("ts").cast("date") == F.col("w_date")))


_WARM_SQL = f"""{_BASE}, {star.TIMES_SQL},
daily AS (SELECT n_regionkey, CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS temp_max, min(l_quantity) AS temp_min
          FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL),
warm AS (SELECT f.*, g.lau1_code, d.temp_max, d.temp_min FROM timed f JOIN geo g ON f.id_rel_lau = g.lau3_code
         JOIN daily d ON g.lau1_code = d.n_regionkey AND CAST(f.ts AS DATE) = d.date)"""


def temp_band_count(spark, d):
    fires = _warm_fires(spark, d).withColumn("t", (F.col("temp_max") + F.col("temp_min")) / 2)
    return analysis.temperature_bands(fires, "t", 5.0).select("band", "fires")


def temp_band_area(spark, d):
    severity = F.col("total_area") + F.col("temp_max").cast("decimal(18,2)")
    hours = F.when(F.col("extinguishing_ts") > F.col("alarm_ts"), millis_between("alarm_ts", "extinguishing_ts") / 3_600_000)
    out = analysis.temperature_bands(_exact(_warm_fires(spark, d)), "temp_max", 5.0, severity=severity, duration=hours)
    return _doubles(_round(out, total_area=2, mean_area=6, mean_duration=6, mean_severity=6), "total_area", "mean_area", "mean_severity")


def temp_band_region(spark, d):
    return analysis.temperature_bands(_warm_fires(spark, d), "temp_max", 5.0, by=["lau1_code"]).select(
        "band", "lau1_code", "fires")


_BAND_AREA_SQL = f"""WITH {_WARM_SQL}
SELECT floor(temp_max / 5) * 5 AS band, count(*) AS fires, sum(CAST(total_area AS DECIMAL(18,2)))::DOUBLE AS total_area,
       round(avg(CAST(total_area AS DECIMAL(18,2))), 6) AS mean_area,
       round(avg(CASE WHEN extinguishing_ts > alarm_ts THEN date_diff('microsecond', alarm_ts, extinguishing_ts) / 3.6e9 END), 6) AS mean_duration,
       round(avg(CAST(total_area AS DECIMAL(18,2)) + CAST(temp_max AS DECIMAL(18,2))), 6) AS mean_severity
FROM warm GROUP BY 1"""


def area_by_response_band(spark, d):
    out = analysis.area_by_response_band(_exact(star.timed_fires(spark, d)), 43200.0)
    return _doubles(_round(out, total_area=2, mean_area=6), "total_area", "mean_area")


_RESPONSE_BAND_SQL = f"""WITH {star.FIRES_SQL}, {star.TIMES_SQL}
SELECT floor(date_diff('microsecond', alarm_ts, first_response_ts) / 6e7 / 43200) * 43200 AS band, count(*) AS fires,
       sum(CAST(total_area AS DECIMAL(18,2)))::DOUBLE AS total_area, round(avg(CAST(total_area AS DECIMAL(18,2))), 6) AS mean_area
FROM timed WHERE first_response_ts > alarm_ts GROUP BY 1"""


# --- general operators -----------------------------------------------------------------------

def corr_by_region(spark, d):
    rows = star.fires(spark, d).join(
        star.table(spark, d, "customer"), F.col("id_rel_lau") == F.col("c_custkey")).join(
        star.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return _round(analysis.correlation(rows, ["n_regionkey"], "total_area", "c_acctbal"), correlation=6)


_CORR_SQL = f"""WITH {star.FIRES_SQL}
SELECT n_regionkey, round(corr(total_area, c_acctbal), 6) AS correlation
FROM fires JOIN customer ON id_rel_lau = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""


def before_after(spark, d):
    moments = with_geography(star.fires(spark, d), _flat(spark, d)).select(
        "id", F.col("lau1_code").alias("region"), F.col("ts").cast("date").alias("day"))
    s = star.table(spark, d, "supplier").join(
        star.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_regionkey").cast("bigint").alias("region"))
    series = _lineitem(spark, d).join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "region", F.col("l_shipdate").cast("date").alias("day"), "l_quantity")
    out = analysis.before_after(moments, series, id_column="id", key="region", day="day", value="l_quantity", width=3)
    return _round(out, before=6, after=6)


_BEFORE_SQL = f"""WITH {_BASE},
series AS (SELECT n_regionkey AS region, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS s, count(*) AS n
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL),
asked AS (SELECT f.id, g.lau1_code AS region, CAST(f.ts AS DATE) AS day, unnest([-3, -2, -1, 1, 2, 3]) AS off {_FROM})
SELECT id, round(sum(s) FILTER (off < 0) / sum(n) FILTER (off < 0), 6) AS before,
       round(sum(s) FILTER (off > 0) / sum(n) FILTER (off > 0), 6) AS after
FROM asked a LEFT JOIN series s ON a.region = s.region AND a.day + CAST(off AS INTEGER) = s.day GROUP BY id"""


def topk_types_severe(spark, d):
    severe = star.fires(spark, d).filter("total_area > 400000")
    counts = with_geography(severe.groupBy("id_rel_lau", "id_ref_fire_type").agg(F.count(F.lit(1)).alias("n")), _flat(spark, d)) \
        .groupBy("lau1_code", "id_ref_fire_type").agg(F.sum("n").alias("fires"))
    return analysis.top_by_group(counts, ["lau1_code"], [F.desc("fires"), F.asc("id_ref_fire_type")], 2)


_TOPK_SQL = f"""WITH {_BASE},
c AS (SELECT lau1_code, id_ref_fire_type, count(*) AS fires {_FROM} WHERE total_area > 400000 GROUP BY ALL)
SELECT lau1_code, id_ref_fire_type, fires,
       CAST(row_number() OVER (PARTITION BY lau1_code ORDER BY fires DESC, id_ref_fire_type) AS INTEGER) AS rank
FROM c QUALIFY rank <= 2"""


def conditional_share(spark, d):
    return _round(analysis.conditional_share(
        star.fires(spark, d), ["year"], F.col("id_ref_fire_type") == "1-URGENT", "share"), share=6)


_SHARE_IF_SQL = f"""WITH {star.FIRES_SQL}
SELECT year, round(avg(CASE WHEN id_ref_fire_type = '1-URGENT' THEN 1.0 ELSE 0.0 END), 6) AS share FROM fires GROUP BY year"""


def presence_mean(spark, d):
    """Mean of a measure over areas with and without fires."""
    burned = star.fires(spark, d).select(F.col("id_rel_lau").alias("hit")).distinct()
    c = star.table(spark, d, "customer")
    marked = c.join(burned, F.col("c_custkey") == F.col("hit"), "left").withColumn("with_fire", F.col("hit").isNotNull())
    return _round(analysis.band_aggregate(
        marked, {}, {"areas": F.count(F.lit(1)), "mean": F.avg("c_acctbal")}, by=["with_fire"]), mean=6)


_PRESENCE_SQL = f"""WITH {star.FIRES_SQL}
SELECT EXISTS (SELECT 1 FROM fires WHERE id_rel_lau = c_custkey) AS with_fire, count(*) AS areas, round(avg(c_acctbal), 6) AS mean
FROM customer GROUP BY 1"""


def weighted_share(spark, d):
    """Share of the burned area that lies where another measure is high."""
    rows = star.fires(spark, d).join(star.table(spark, d, "customer"), F.col("id_rel_lau") == F.col("c_custkey"))
    return _round(analysis.conditional_share(
        rows, ["year"], F.col("c_acctbal") > 5000, "share", weight=F.col("total_area")), share=6)


_WEIGHTED_SQL = f"""WITH {star.FIRES_SQL}
SELECT year, round(sum(CASE WHEN c_acctbal > 5000 THEN total_area ELSE 0 END) / sum(total_area), 6) AS share
FROM fires JOIN customer ON id_rel_lau = c_custkey GROUP BY year"""


def _units(spark, d):
    """Fires with the number of line items as deployed units and their quantity as staff, by one aggregate of the line items."""
    per = star.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.min("l_shipdate").alias("first_response_ts"), F.max("l_shipdate").alias("extinguishing_ts"),
        F.count(F.lit(1)).alias("units"), F.sum("l_quantity").alias("staff"))
    return star.fires(spark, d).join(per, F.col("id") == F.col("k")).drop("k")


_UNITS_SQL = f"""{star.FIRES_SQL}, {star.TIMES_SQL},
units AS (SELECT timed.*, u.units, u.staff FROM timed JOIN (
          SELECT l_orderkey, count(*) AS units, sum(l_quantity) AS staff FROM lineitem GROUP BY 1) u ON id = l_orderkey)"""


def duration_by_units(spark, d):
    """Mean hours to extinction by fire type and band of deployed units."""
    rows = _units(spark, d).filter("extinguishing_ts > alarm_ts")
    hours = millis_between("alarm_ts", "extinguishing_ts") / 3_600_000
    return _round(analysis.band_aggregate(
        rows, {"units_band": analysis.band("units", 3.0)}, {"fires": F.count(F.lit(1)), "mean_hours": F.avg(hours)},
        by=["id_ref_fire_type"]), mean_hours=6)


_BY_UNITS_SQL = f"""WITH {_UNITS_SQL}
SELECT id_ref_fire_type, floor(units / 3) * 3 AS units_band, count(*) AS fires,
       round(avg(date_diff('microsecond', alarm_ts, extinguishing_ts) / 3.6e9), 6) AS mean_hours
FROM units WHERE extinguishing_ts > alarm_ts GROUP BY ALL"""


def staff_per_area(spark, d):
    """Staff per burned thousand of area, a ratio of sums per year."""
    rows = _units(spark, d).filter("total_area IS NOT NULL").groupBy("year").agg(
        F.sum("staff").alias("staff"), F.sum("total_area").alias("total_area"))
    return _round(rows.select("year", "staff", F.try_divide(F.col("staff") * 1000, "total_area").alias("per_area")), per_area=8)


_STAFF_SQL = f"""WITH {_UNITS_SQL}
SELECT year, sum(staff) AS staff, round(sum(staff) * 1000 / sum(total_area), 8) AS per_area
FROM units WHERE total_area IS NOT NULL GROUP BY year"""


def _combined(spark, d):
    """Line items as deployed units: the return flag is the means, the line status the fuel, discounts of over 5 percent rekindles."""
    items = star.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("means"), F.col("l_linestatus").alias("fuel"), (F.col("l_discount") > 0.05).alias("rekindle"))
    return _exact(star.fires(spark, d)).join(items, F.col("id") == F.col("k")).drop("k")


def fires_by_fuel(spark, d):
    """Fires and mean area by kind of fuel."""
    fires = _combined(spark, d).select("id", "fuel", "total_area").distinct()
    out = analysis.band_aggregate(fires, {}, {"fires": F.count(F.lit(1)), "mean_area": F.round(F.avg("total_area"), 6)}, by=["fuel"])
    return _doubles(out, "mean_area")


_COMBINED_SQL = f"""{star.FIRES_SQL},
combined AS (SELECT id, CAST(total_area AS DECIMAL(18,2)) AS area, l_returnflag AS means, l_linestatus AS fuel, l_discount > 0.05 AS rekindle
             FROM fires JOIN lineitem ON id = l_orderkey)"""


def area_by_units(spark, d):
    """Mean final area by band of deployed units."""
    out = analysis.band_aggregate(_exact(_units(spark, d)), {"units_band": analysis.band("units", 2.0)},
                                  {"fires": F.count(F.lit(1)), "mean_area": F.round(F.avg("total_area"), 6)})
    return _doubles(out, "mean_area")


def rekindles_by_means(spark, d):
    """Share of deployments that rekindled, by means used."""
    return _round(analysis.conditional_share(_combined(spark, d), ["means"], F.col("rekindle"), "share"), share=6)


def containment_by_combination(spark, d):
    """Share of small fires by combination of means and fuel."""
    return _round(analysis.conditional_share(
        _combined(spark, d).filter("total_area IS NOT NULL"), ["means", "fuel"], F.col("total_area") < 200000, "contained"), contained=6)


def spread_before_after(spark, d):
    """Mean quantity of a fire's line items shipped before, and from, the arrival of its second unit."""
    items = star.table(spark, d, "lineitem")
    arrival = items.filter("l_linenumber = 2").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("arrival"))
    return _round(analysis.rate_before_after(
        arrival, items, id_column="l_orderkey", at="arrival", key="l_orderkey", ts="l_shipdate", value="l_quantity"), before=4, after=4)


_SPREAD_SQL = """
WITH a AS (SELECT l_orderkey, min(l_shipdate) AS arrival FROM lineitem WHERE l_linenumber = 2 GROUP BY 1)
SELECT l.l_orderkey, round(avg(l_quantity) FILTER (WHERE l_shipdate < arrival), 4) AS before,
       round(avg(l_quantity) FILTER (WHERE l_shipdate >= arrival), 4) AS after
FROM lineitem l JOIN a ON l.l_orderkey = a.l_orderkey GROUP BY 1"""


# --- streaming -------------------------------------------------------------------------------

def _event_stream(spark, d):
    return spark.readStream.schema(star.SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(d)


def stream_hourly_counts(spark, d):
    """Hourly counts from an available-now stream of the events, as the batch query gives them."""
    path, mark = scratch_path(spark, "stream-counts"), scratch_path(spark, "stream-mark")
    keys = ["year", "hour", "event_type"]
    query = live.write_partial_counts(
        _event_stream(spark, d), keys, path, mark,
        lambda b: b.withColumn("year", F.year("ts")).withColumn("hour", F.hour("ts")))
    query.awaitTermination()
    return live.total_counts(spark, keys, path, "year int, hour int, event_type string, count bigint")


_STREAM_SQL = """
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(hour(ts) AS INTEGER) AS hour, event_type, count(*) AS count
FROM events GROUP BY ALL"""


def stream_last_writes(spark, d):
    """Last event per user and type, from arrivals written by a stream."""
    path, mark = scratch_path(spark, "stream-rows"), scratch_path(spark, "stream-mark")
    rows = _event_stream(spark, d).select("event_id", "ts", "user_id", "event_type", "value")
    live.write_arrivals(rows, path, mark).awaitTermination()
    arrivals = spark.read.schema(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, ingest_seq bigint").parquet(path)
    return live.current_rows(arrivals, ["user_id", "event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "event_id", "value")


def stream_upsert(spark, d):
    """Last event per year, user and type, in a table that a stream keeps up to date."""
    path, mark = scratch_path(spark, "stream-table"), scratch_path(spark, "stream-mark")
    rows = _event_stream(spark, d).select(F.year("ts").alias("year"), "event_id", "ts", "user_id", "event_type", "value")
    live.write_upserts(rows, path, mark, ["year", "user_id", "event_type"], ["ts", "event_id"]).awaitTermination()
    return spark.read.parquet(path).select(F.col("year").cast("int").alias("year"), "user_id", "event_type", "event_id", "value")


_STREAM_UPSERT_SQL = """
SELECT CAST(year(ts) AS INTEGER) AS year, user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY year(ts), user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""


_STREAM_LAST_SQL = """
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""

QUERIES = {
    "unit_rollup": (unit_rollup, _ROLLUP_SQL),
    "share_of_area": (share_of_area, _SHARE_SQL),
    "density": (density, _DENSITY_SQL),
    "share_of_area_units": (share_of_area_units, _SHARE_UNITS_SQL),
    "density_units": (density_units, _DENSITY_UNITS_SQL),
    "fires_by_fuel": (fires_by_fuel, f"""WITH {_COMBINED_SQL}
SELECT fuel, count(*) AS fires, round(avg(area), 6) AS mean_area FROM (SELECT DISTINCT id, fuel, area FROM combined) GROUP BY fuel"""),
    "area_by_units": (area_by_units, f"""WITH {_UNITS_SQL}
SELECT floor(units / 2) * 2 AS units_band, count(*) AS fires, round(avg(CAST(total_area AS DECIMAL(18,2))), 6) AS mean_area FROM units GROUP BY 1"""),
    "rekindles_by_means": (rekindles_by_means, f"""WITH {_COMBINED_SQL}
SELECT means, round(avg(CASE WHEN rekindle THEN 1.0::DOUBLE ELSE 0 END), 6) AS share FROM combined GROUP BY means"""),
    "containment_by_combination": (containment_by_combination, f"""WITH {_COMBINED_SQL}
SELECT means, fuel, round(avg(CASE WHEN area < 200000 THEN 1.0::DOUBLE ELSE 0 END), 6) AS contained FROM combined WHERE area IS NOT NULL GROUP BY ALL"""),
    "spread_before_after": (spread_before_after, _SPREAD_SQL),
    "season_week_counts": (season_week_counts, _SEASON_SQL),
    "mean_area_monthly": (mean_area_monthly, f"""WITH {star.FIRES_SQL}
SELECT CAST(month(ts) AS INTEGER) AS month, round(avg(CAST(total_area AS DECIMAL(18,2))), 6) AS mean_area FROM fires GROUP BY 1"""),
    "month_region_heatmap": (month_region_heatmap, _HEATMAP_SQL),
    "yearly_trend": (yearly_trend, _TREND_SQL),
    "size_classes": (size_classes, _SIZE_SQL),
    "mean_duration_yearly": (mean_duration_yearly, _DURATION_SQL),
    "temp_band_count": (temp_band_count, f"""WITH {_WARM_SQL}
SELECT floor((temp_max + temp_min) / 2 / 5) * 5 AS band, count(*) AS fires FROM warm GROUP BY 1"""),
    "temp_band_area": (temp_band_area, _BAND_AREA_SQL),
    "temp_band_region": (temp_band_region, f"""WITH {_WARM_SQL}
SELECT floor(temp_max / 5) * 5 AS band, lau1_code, count(*) AS fires FROM warm GROUP BY ALL"""),
    "area_by_response_band": (area_by_response_band, _RESPONSE_BAND_SQL),
    "corr_by_region": (corr_by_region, _CORR_SQL),
    "before_after": (before_after, _BEFORE_SQL),
    "topk_types_severe": (topk_types_severe, _TOPK_SQL),
    "conditional_share": (conditional_share, _SHARE_IF_SQL),
    "presence_mean": (presence_mean, _PRESENCE_SQL),
    "weighted_share": (weighted_share, _WEIGHTED_SQL),
    "duration_by_units": (duration_by_units, _BY_UNITS_SQL),
    "staff_per_area": (staff_per_area, _STAFF_SQL),
    "stream_hourly_counts": (stream_hourly_counts, _STREAM_SQL),
    "stream_upsert": (stream_upsert, _STREAM_UPSERT_SQL),
    "stream_last_writes": (stream_last_writes, _STREAM_LAST_SQL),
}
