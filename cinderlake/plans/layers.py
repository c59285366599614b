"""Map layers: denormalised fires, points, perimeters, and monthly summaries per area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlake.operators import dimensions
from cinderlake.operators.geography import with_geography

LAYER_COLUMNS = (
    "id original_id year ts lau3 lau2 lau1 locality fire_type alarm_source cause cause_type rekindle slash_and_burn "
    "agricultural total_area brushwood_area agricultural_area inhabited_area alarm_ts first_response_ts "
    "extinguishing_ts temperature relative_humidity wind_speed wind_direction precipitation mean_height mean_slope"
).split()


def fire_layer(fact: DataFrame, flat: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fires with area names and decoded dimensions; nothing is dropped by a missing lookup."""
    rows = with_geography(fact, flat)
    for name, ref in dims.items():
        rows = dimensions.decode(rows, f"id_ref_{name}", ref, name)
    geometry = [c for c in ("lon", "lat") if c in fact.columns]
    return rows.select(*[c for c in LAYER_COLUMNS if c in rows.columns], *geometry)


def point_layer(layer: DataFrame) -> DataFrame:
    """One row per fire with its point."""
    return layer


def perimeter_layer(layer: DataFrame, parts: DataFrame) -> DataFrame:
    """One row per fire and perimeter part; fires without a usable perimeter are absent."""
    attributes = layer.drop("lon", "lat")
    # the size of nested rings is underestimated by the planner, so they are never broadcast
    shapes = parts.select(F.col("fire_id"), "part", "rings", F.col("area").alias("part_area")).hint("merge")
    return attributes.join(shapes, F.col("id") == F.col("fire_id")).drop("fire_id")


def area_summary(fact: DataFrame, flat: DataFrame, level: int, units: DataFrame | None = None, keep_empty: bool = False) -> DataFrame:
    """`count, year, month, lau<level>, code` of all fires per month and unit, without an area limit.

    With `units` (the geometry side, `code` first) its columns are joined on; units without fires
    are absent unless `keep_empty`.
    """
    name, code = f"lau{level}", f"lau{level}_code"
    monthly = fact.select("id_rel_lau", "year", F.month("ts").alias("month")).groupBy(
        "id_rel_lau", "year", "month").agg(F.count(F.lit(1)).alias("count"))
    counts = with_geography(monthly, flat).groupBy("year", "month", code, name).agg(F.sum("count").alias("count"))
    if units is None:
        return counts.filter(F.col(code).isNotNull()).select("count", "year", "month", name, F.col(code).alias("code"))
    side = units.withColumnRenamed("code", "_unit")
    joined = side.join(counts, F.col("_unit") == F.col(code), "left" if keep_empty else "inner")
    return joined.select(
        F.coalesce("count", F.lit(0)).alias("count"), "year", "month", name, F.col("_unit").alias("code"),
        *[c for c in units.columns if c != "code"])


def summary_of_year(summary: DataFrame, level: int, year: int, carry: str | None = None) -> DataFrame:
    """Counts of one year per unit from `area_summary`, with the first known value of `carry`."""
    name = f"lau{level}"
    extra = [F.first(carry, ignorenulls=True).alias(carry)] if carry else []
    return summary.filter(F.col("year") == year).groupBy("year", name).agg(F.sum("count").alias("count"), *extra)


def first_known(value: str, *order: str):
    """First non-null value by `order`, the same on every run."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.struct(*order)))


def last_known(value: str, *order: str):
    """Last non-null value by `order`, the same on every run."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order)))


def newest_first(fact: DataFrame, year: int, start, limit: int | None = None, ts: str = "ts", tie: str = "id") -> DataFrame:
    """Fires of one year from `start` on, newest first; `limit` makes it a top-k report."""
    rows = fact.filter((F.col("year") == year) & (F.col(ts) >= F.lit(start).cast("timestamp_ntz")))
    rows = rows.orderBy(F.col(ts).desc(), F.col(tie))
    return rows.limit(limit) if limit else rows
