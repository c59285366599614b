"""Dashboard queries and their check SQL."""

from __future__ import annotations

from cinderlake.catalog import star
from cinderlake.operators.geography import flatten_geography
from cinderlake.plans import dashboard
from pyspark.sql import functions as F

EVENT_MIN = 10.0


def _flat(spark, d):
    return flatten_geography(star.lau(spark, d))


def _rounded(df, *names, digits=2):
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


def fire_count_yearly(spark, d):
    return dashboard.event_counts(star.fires(spark, d), _flat(spark, d), "yearly", star.MIN_AREA)


def fire_count_monthly(spark, d):
    return dashboard.event_counts(star.fires(spark, d), _flat(spark, d), "monthly", star.MIN_AREA)


def event_count_hourly(spark, d):
    return dashboard.event_counts(star.event_fires(spark, d), _flat(spark, d), "hourly", EVENT_MIN)


def area_yearly(spark, d):
    out = dashboard.area_distribution(star.fires(spark, d), _flat(spark, d), star.MIN_AREA)
    return _rounded(out, "total_area", "min_area", "p25_area", "median_area", "p75_area", "max_area", digits=4)


def area_monthly(spark, d):
    return _rounded(dashboard.area_totals(star.fires(spark, d), _flat(spark, d), "monthly", star.MIN_AREA), "total_area")


def cause_yearly(spark, d):
    return _rounded(dashboard.cause_counts(
        star.fires(spark, d), _flat(spark, d), star.cause_types(spark, d), "yearly", star.MIN_AREA), "area")


def cause_monthly(spark, d):
    return _rounded(dashboard.cause_counts(
        star.fires(spark, d), _flat(spark, d), star.cause_types(spark, d), "monthly", star.MIN_AREA), "area")


def cause_hourly(spark, d):
    return _rounded(dashboard.cause_counts(
        star.event_fires(spark, d), _flat(spark, d), star.event_types(spark, d), "hourly", EVENT_MIN), "area")


def _stats(df):
    return _rounded(df, "min", "p25", "median", "p75", "max")


def response_time(spark, d):
    return _stats(dashboard.response_time(star.timed_fires(spark, d), _flat(spark, d), min_area=star.MIN_AREA))


def response_duration(spark, d):
    return _stats(dashboard.firefighting_duration(star.timed_fires(spark, d), _flat(spark, d), min_area=star.MIN_AREA))


def total_duration(spark, d):
    return _stats(dashboard.total_duration(star.timed_fires(spark, d), _flat(spark, d), min_area=star.MIN_AREA))


def total_duration_untrimmed(spark, d):
    return _stats(dashboard.untrimmed_duration(
        star.timed_fires(spark, d), _flat(spark, d), "alarm_ts", "extinguishing_ts", min_area=star.MIN_AREA))


_COUNT = """WITH {geo}, {fires}
SELECT count(*) AS count, f.year, {grain} g.lau1_code
FROM fires f LEFT JOIN geo g ON f.id_rel_lau = g.lau3_code
WHERE f.total_area IS NULL OR f.total_area > {low}
GROUP BY ALL"""

_MONTH = "CAST(month(f.ts) AS INTEGER) AS month,"
_HOUR = "CAST(hour(f.ts) AS INTEGER) AS hour,"


def _count_sql(fires, grain, low):
    return _COUNT.format(geo=star.GEO_SQL, fires=fires, grain=grain, low=low)


_AREA_YEARLY = f"""WITH {star.GEO_SQL}, {star.FIRES_SQL}
SELECT round(sum(total_area), 4) AS total_area, round(min(total_area), 4) AS min_area,
       round(quantile_cont(total_area, 0.25), 4) AS p25_area, round(quantile_cont(total_area, 0.5), 4) AS median_area,
       round(quantile_cont(total_area, 0.75), 4) AS p75_area, round(max(total_area), 4) AS max_area,
       f.year, g.lau1_code
FROM fires f LEFT JOIN geo g ON f.id_rel_lau = g.lau3_code
WHERE total_area > {star.MIN_AREA} GROUP BY ALL"""

_AREA_MONTHLY = f"""WITH {star.GEO_SQL}, {star.FIRES_SQL}
SELECT round(sum(total_area), 2) AS total_area, f.year, {_MONTH} g.lau1_code
FROM fires f LEFT JOIN geo g ON f.id_rel_lau = g.lau3_code
WHERE total_area > {star.MIN_AREA} GROUP BY ALL"""


def _cause_sql(fires, grain, low, codes):
    return f"""WITH {star.GEO_SQL}, {fires}
SELECT count(*) AS count, round(sum(total_area), 2) AS area, f.year, {grain} g.lau1_code, {codes} AS cause_type_code
FROM fires f LEFT JOIN geo g ON f.id_rel_lau = g.lau3_code
WHERE total_area > {low} GROUP BY ALL"""


_STATUS = "CASE WHEN f.id_ref_cause_type <> 'P' THEN 'STATUS_' || f.id_ref_cause_type END"


def _duration_sql(start, end, upper):
    return f"""WITH {star.GEO_SQL}, {star.FIRES_SQL}, {star.TIMES_SQL},
base AS (
  SELECT f.year, g.lau1_code, date_diff('microsecond', f.{start}, f.{end}) / 1000.0 AS time
  FROM timed f LEFT JOIN geo g ON f.id_rel_lau = g.lau3_code
  WHERE (f.total_area IS NULL OR f.total_area > {star.MIN_AREA}) AND f.{end} > f.{start}
),
stats AS (
  SELECT year, lau1_code, quantile_cont(time, 0.25) AS q1, quantile_cont(time, 0.75) AS q3 FROM base GROUP BY ALL
)
SELECT round(min(time), 2) AS min, round(quantile_cont(time, 0.25), 2) AS p25, round(quantile_cont(time, 0.5), 2) AS median,
       round(quantile_cont(time, 0.75), 2) AS p75, round(max(time), 2) AS max, b.lau1_code, b.year
FROM base b JOIN stats s ON b.year = s.year AND b.lau1_code = s.lau1_code
WHERE time BETWEEN q1 - 1.5 * (q3 - q1) AND {upper}
GROUP BY b.year, b.lau1_code"""


_UNTRIMMED = f"""WITH {star.GEO_SQL}, {star.FIRES_SQL}, {star.TIMES_SQL},
base AS (
  SELECT f.year, g.lau1_code, date_diff('microsecond', f.alarm_ts, f.extinguishing_ts) / 1000.0 AS time
  FROM timed f LEFT JOIN geo g ON f.id_rel_lau = g.lau3_code
  WHERE (f.total_area IS NULL OR f.total_area > {star.MIN_AREA}) AND f.extinguishing_ts > f.alarm_ts
)
SELECT round(min(time), 2) AS min, round(quantile_cont(time, 0.25), 2) AS p25, round(quantile_cont(time, 0.5), 2) AS median,
       round(quantile_cont(time, 0.75), 2) AS p75, round(max(time), 2) AS max, lau1_code, year
FROM base GROUP BY year, lau1_code"""

QUERIES = {
    "fire_count_yearly": (fire_count_yearly, _count_sql(star.FIRES_SQL, "", star.MIN_AREA)),
    "fire_count_monthly": (fire_count_monthly, _count_sql(star.FIRES_SQL, _MONTH, star.MIN_AREA)),
    "event_count_hourly": (event_count_hourly, _count_sql(star.EVENT_FIRES_SQL, _HOUR, EVENT_MIN)),
    "area_yearly": (area_yearly, _AREA_YEARLY),
    "area_monthly": (area_monthly, _AREA_MONTHLY),
    "cause_yearly": (cause_yearly, _cause_sql(star.FIRES_SQL, "", star.MIN_AREA, _STATUS)),
    "cause_monthly": (cause_monthly, _cause_sql(star.FIRES_SQL, _MONTH, star.MIN_AREA, _STATUS)),
    "cause_hourly": (cause_hourly, _cause_sql(star.EVENT_FIRES_SQL, _HOUR, EVENT_MIN, "upper(f.id_ref_cause_type)")),
    "response_time": (response_time, _duration_sql("alarm_ts", "first_response_ts", "q3 + 1.5 * (q3 - q1)")),
    "response_duration": (response_duration, _duration_sql("first_response_ts", "extinguishing_ts", "5184000000.0")),
    "total_duration": (total_duration, _duration_sql("alarm_ts", "extinguishing_ts", "5184000000.0")),
    "total_duration_untrimmed": (total_duration_untrimmed, _UNTRIMMED),
}
