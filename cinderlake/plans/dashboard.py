"""Dashboard aggregates of the fire fact.

Counts and sums are grouped by parish first and rolled up to districts afterwards: a fact of any
size shrinks to parishes x periods on the map side before it meets the geography. Duration and
area percentiles need single values, so they join the flat geography first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlake import schema
from cinderlake.functions.parsing import millis_between
from cinderlake.operators.filters import shown_area, strictly_ordered
from cinderlake.operators.geography import with_geography
from cinderlake.operators.percentiles import exact_percentiles, trimmed_percentiles

QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def _grain(grain: str, ts: str = "ts") -> dict[str, Column]:
    return {
        "yearly": {},
        "monthly": {"month": F.month(ts)},
        "hourly": {"hour": F.hour(ts)},
    }[grain]


def _by_district(fact: DataFrame, flat: DataFrame, keys: dict[str, Column], measures: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Aggregate by parish and keys, then roll up; `measures` holds (partial, final) pairs."""
    names = list(keys)
    per_parish = fact.select("*", *[c.alias(n) for n, c in keys.items() if n not in fact.columns]).groupBy(
        "id_rel_lau", *names).agg(*[p.alias(n) for n, (p, _) in measures.items()])
    located = with_geography(per_parish, flat)
    return located.groupBy(*names, "lau1_code").agg(*[f.alias(n) for n, (_, f) in measures.items()])


def event_counts(
    fact: DataFrame, flat: DataFrame, grain: str = "yearly", min_area: float = schema.MIN_DISPLAY_AREA
) -> DataFrame:
    """`count, year[, month|hour], lau1_code`; fires of unknown area count."""
    keys = {"year": F.col("year"), **_grain(grain)}
    shown = fact.filter(shown_area("total_area", min_area, keep_null=True))
    return _by_district(shown, flat, keys, {"count": (F.count(F.lit(1)), F.sum("count"))})


def area_totals(
    fact: DataFrame, flat: DataFrame, grain: str = "monthly", min_area: float = schema.MIN_DISPLAY_AREA
) -> DataFrame:
    """`total_area, year[, month|hour], lau1_code`; fires of unknown area are left out."""
    keys = {"year": F.col("year"), **_grain(grain)}
    shown = fact.filter(shown_area("total_area", min_area, keep_null=False))
    return _by_district(shown, flat, keys, {"total_area": (F.sum("total_area"), F.sum("total_area"))})


def area_distribution(fact: DataFrame, flat: DataFrame, min_area: float = schema.MIN_DISPLAY_AREA) -> DataFrame:
    """Sum, minimum, quartiles and maximum of the burned area per year and district."""
    shown = fact.filter(shown_area("total_area", min_area, keep_null=False))
    located = with_geography(shown.select("id_rel_lau", "year", "total_area"), flat)
    return exact_percentiles(
        located, ["year", "lau1_code"], "total_area",
        {"p25_area": 0.25, "median_area": 0.5, "p75_area": 0.75},
        low="min_area", high="max_area", total="total_area",
    ).select("total_area", "min_area", "p25_area", "median_area", "p75_area", "max_area", "year", "lau1_code")


def cause_counts(
    fact: DataFrame, flat: DataFrame, cause_types: DataFrame, grain: str = "yearly",
    min_area: float = schema.MIN_DISPLAY_AREA,
) -> DataFrame:
    """`count, area, year[, month|hour], lau1_code, cause_type_code`."""
    keys = {"year": F.col("year"), **_grain(grain)}
    shown = fact.filter(shown_area("total_area", min_area, keep_null=False))
    names = [*keys, "id_ref_cause_type"]
    per_parish = shown.select("*", *[c.alias(n) for n, c in keys.items() if n not in fact.columns]).groupBy(
        "id_rel_lau", *names).agg(F.count(F.lit(1)).alias("count"), F.sum("total_area").alias("area"))
    codes = cause_types.select(F.col("id").alias("ct_id"), F.col("code").alias("cause_type_code"))
    decoded = with_geography(per_parish, flat).join(codes, F.col("id_ref_cause_type") == F.col("ct_id"), "left")
    return decoded.groupBy(*keys, "lau1_code", "cause_type_code").agg(
        F.sum("count").alias("count"), F.sum("area").alias("area"))


def duration_stats(
    fact: DataFrame, flat: DataFrame, start: str, end: str, *, spread: float | None = 1.5,
    upper: float | None = None, min_area: float = schema.MIN_DISPLAY_AREA,
) -> DataFrame:
    """`min, p25, median, p75, max` milliseconds from `start` to `end` per year and district."""
    shown = fact.filter(shown_area("total_area", min_area, keep_null=True) & strictly_ordered(start, end))
    located = with_geography(
        shown.select("id_rel_lau", "year", millis_between(start, end).alias("time")), flat)
    return trimmed_percentiles(
        located, ["year", "lau1_code"], "time", QUARTILES, spread=spread, upper=upper,
    ).select("min", "p25", "median", "p75", "max", "lau1_code", "year")


def response_time(fact: DataFrame, flat: DataFrame, **options) -> DataFrame:
    """Alarm to first response; outliers cut on both sides by the interquartile rule."""
    return duration_stats(fact, flat, "alarm_ts", "first_response_ts", **options)


def firefighting_duration(fact: DataFrame, flat: DataFrame, **options) -> DataFrame:
    """First response to extinction; cut below by the interquartile rule, above at sixty days."""
    return duration_stats(fact, flat, "first_response_ts", "extinguishing_ts",
                          upper=schema.SIXTY_DAYS_MS, **options)


def total_duration(fact: DataFrame, flat: DataFrame, **options) -> DataFrame:
    """Alarm to extinction, with the limits of `firefighting_duration`."""
    return duration_stats(fact, flat, "alarm_ts", "extinguishing_ts", upper=schema.SIXTY_DAYS_MS, **options)


def untrimmed_duration(fact: DataFrame, flat: DataFrame, start: str, end: str, **options) -> DataFrame:
    """The same statistics with no outlier cut; rows without a district form a group."""
    return duration_stats(fact, flat, start, end, spread=None, **options)
