"""Analyses of the fire fact, built from six general operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderlake.functions.parsing import millis_between
from cinderlake.operators.geography import with_geography

SEASONS = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8), "autumn": (9, 10, 11)}


# --- general operators ---------------------------------------------------------------------

def band(value: Column | str, width: float) -> Column:
    """Lower edge of the value's band."""
    c = F.col(value) if isinstance(value, str) else value
    return F.floor(c / F.lit(float(width))) * F.lit(float(width))


def labelled_band(value: str, edges: list[float], labels: list[str]) -> Column:
    """Label of the band between `edges`; the lower edge belongs to the band above it."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    out = F.when(F.col(value).isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(F.col(value) < edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def band_aggregate(df: DataFrame, bands: dict[str, Column], measures: dict[str, Column], by: list[str] = ()) -> DataFrame:
    """Aggregates per band (and `by` columns)."""
    named = df.select("*", *[c.alias(n) for n, c in bands.items()])
    return named.groupBy(*bands, *by).agg(*[c.alias(n) for n, c in measures.items()])


def ratio_to_reference(
    df: DataFrame, reference: DataFrame, key: str, numerator: str, denominator: str, out: str, scale: float = 1.0
) -> DataFrame:
    """`numerator / denominator * scale`, the denominator looked up by `key`; NULL when it is zero."""
    right = reference.select(F.col(key).alias("_key"), F.col(denominator).alias("_den"))
    return df.join(right, F.col(key) == F.col("_key"), "left").withColumn(
        out, F.try_divide(F.col(numerator) * F.lit(float(scale)), F.col("_den"))).drop("_key", "_den")


def conditional_share(df: DataFrame, by: list[str], condition: Column, out: str, weight: Column | None = None) -> DataFrame:
    """Share of rows (or of `weight`) that meet `condition`, per group."""
    w = F.lit(1.0) if weight is None else weight
    return df.groupBy(*by).agg(
        F.try_divide(F.sum(F.when(condition, w).otherwise(0.0)), F.sum(w)).alias(out))


def correlation(df: DataFrame, by: list[str], x: str, y: str, out: str = "correlation") -> DataFrame:
    """Pearson correlation per group; pairs with a missing side take no part."""
    return df.groupBy(*by).agg(F.corr(x, y).alias(out))


def before_after(
    moments: DataFrame, series: DataFrame, *, id_column: str, key: str, day: str, value: str, width: int
) -> DataFrame:
    """`id, before, after`: mean of `value` in the `width` days before and after each moment.

    `series` is first summed per key and day. Each moment then asks for its own few days by an
    equi-join, so no range join is needed and the work is moments x days.
    """
    daily = series.filter(F.col(value).isNotNull()).groupBy(F.col(key).alias("_key"), F.col(day).alias("_day")).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    asked = moments.select(id_column, key, day, F.explode(F.sequence(F.lit(-width), F.lit(width))).alias("_off")) \
        .filter("_off <> 0").withColumn("_ask", F.date_add(day, F.col("_off")))
    seen = asked.join(daily, (F.col(key) == F.col("_key")) & (F.col("_ask") == F.col("_day")), "left")

    def mean(side: Column) -> Column:
        return F.try_divide(F.sum(F.when(side, F.col("_sum"))), F.sum(F.when(side, F.col("_n"))))

    return seen.groupBy(id_column).agg(mean(F.col("_off") < 0).alias("before"), mean(F.col("_off") > 0).alias("after"))


def top_by_group(df: DataFrame, by: list[str], order: list[Column], k: int, out: str = "rank") -> DataFrame:
    """The `k` first rows per group; Spark limits each task's groups to `k` before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(out, rank).filter(F.col(out) <= k)


# --- fires per area ------------------------------------------------------------------------

def _per_parish(fact: DataFrame, keys: dict[str, Column], measures: dict[str, Column]) -> DataFrame:
    named = fact.select("*", *[c.alias(n) for n, c in keys.items() if n not in fact.columns])
    return named.groupBy("id_rel_lau", *keys).agg(*[c.alias(n) for n, c in measures.items()])


def unit_rollup(fact: DataFrame, flat: DataFrame) -> DataFrame:
    """Number of fires and burned area per district, municipality and parish, with subtotals.

    The fact shrinks to one row per parish before the subtotals multiply the rows. `level` tells
    subtotals from units without a code: 1 district, 2 municipality, 3 parish, 0 all.
    """
    parish = _per_parish(fact, {}, {"fires": F.count(F.lit(1)), "area": F.sum("total_area")})
    level = F.when(F.grouping_id() == 0, 3).when(F.grouping_id() == 1, 2).when(F.grouping_id() == 3, 1).otherwise(0)
    return with_geography(parish, flat).rollup("lau1_code", "lau2_code", "lau3_code").agg(
        level.alias("level"), F.sum("fires").alias("fires"), F.sum("area").alias("burned_area"))


def share_of_area(fact: DataFrame, flat: DataFrame, unit_areas: DataFrame, level: str = "lau1_code") -> DataFrame:
    """Burned area as a percentage of the unit's area, at the level of a code column; `unit_areas` holds that code and `area`."""
    parish = _per_parish(fact, {}, {"burned_area": F.sum("total_area")})
    units = with_geography(parish, flat).groupBy(level).agg(F.sum("burned_area").alias("burned_area"))
    return ratio_to_reference(units, unit_areas, level, "burned_area", "area", "burned_percent", 100.0)


def density(fact: DataFrame, flat: DataFrame, unit_areas: DataFrame, m2_per_unit: float = 1e6, level: str = "lau1_code") -> DataFrame:
    """Fires per square kilometre of the unit, at the level of a code column."""
    parish = _per_parish(fact, {}, {"fires": F.count(F.lit(1))})
    units = with_geography(parish, flat).groupBy(level).agg(F.sum("fires").alias("fires"))
    return ratio_to_reference(units, unit_areas, level, "fires", "area", "fires_per_km2", m2_per_unit)


def rate_before_after(
    moments: DataFrame, series: DataFrame, *, id_column: str, at: str, key: str, ts: str, value: str
) -> DataFrame:
    """`id, before, after`: mean of `value` of an incident's readings before, and from, one moment of it.

    Readings belong to a moment by `key`, so the interval join is an equi-join with both sides of the
    moment told apart in one aggregate.
    """
    readings = series.select(F.col(key).alias("_key"), F.col(ts).alias("_ts"), F.col(value).alias("_value"))
    joined = moments.select(id_column, F.col(key), F.col(at).alias("_at")).join(readings, F.col(key) == F.col("_key"), "left")
    return joined.groupBy(id_column).agg(
        F.avg(F.when(F.col("_ts") < F.col("_at"), F.col("_value"))).alias("before"),
        F.avg(F.when(F.col("_ts") >= F.col("_at"), F.col("_value"))).alias("after"))


# --- fires over time -----------------------------------------------------------------------

def season(ts: Column | str) -> Column:
    month = F.month(ts)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, months in SEASONS.items():
        out = out.when(month.isin(*months), F.lit(name))
    return out


def season_week_counts(fact: DataFrame) -> DataFrame:
    """Fires per month, season and ISO week."""
    return fact.groupBy(
        F.month("ts").alias("month"), season("ts").alias("season"), F.weekofyear("ts").alias("week"),
    ).agg(F.count(F.lit(1)).alias("fires"))


def mean_area_monthly(fact: DataFrame) -> DataFrame:
    """Mean burned area per month of the year."""
    return fact.groupBy(F.month("ts").alias("month")).agg(F.avg("total_area").alias("mean_area"))


def month_region_heatmap(fact: DataFrame, flat: DataFrame) -> DataFrame:
    """One row per district, one column `m1`..`m12` of fire counts per month."""
    parish = _per_parish(fact, {"month": F.month("ts")}, {"fires": F.count(F.lit(1))})
    months = with_geography(parish, flat)
    return months.groupBy("lau1_code").agg(*[
        F.coalesce(F.sum(F.when(F.col("month") == m, F.col("fires"))), F.lit(0)).alias(f"m{m}") for m in range(1, 13)])


def yearly_trend(fact: DataFrame) -> DataFrame:
    """Fires, total and mean area per year, change on the year before, and the trend's slope."""
    years = fact.groupBy("year").agg(
        F.count(F.lit(1)).alias("fires"), F.sum("total_area").alias("total_area"), F.avg("total_area").alias("mean_area"))
    everything = Window.partitionBy(F.lit(0))  # one row per year
    # the frame holds one row per year from here on
    n, x, y = F.count(F.lit(1)).over(everything), F.col("year").cast("double"), F.col("fires").cast("double")
    sx, sy = F.sum(x).over(everything), F.sum(y).over(everything)
    sxy, sxx = F.sum((x - 2000) * y).over(everything), F.sum((x - 2000) * (x - 2000)).over(everything)
    mx = sx - n * 2000
    return years.select(
        "year", "fires", "total_area", "mean_area",
        (F.col("fires") - F.lag("fires").over(everything.orderBy("year"))).alias("change"),
        F.try_divide(n * sxy - mx * sy, n * sxx - mx * mx).alias("slope"))


def size_classes(fact: DataFrame, edges: list[float], labels: list[str]) -> DataFrame:
    """Fires and burned area per year and size class; the class edges are the caller's."""
    return band_aggregate(
        fact, {"size_class": labelled_band("total_area", edges, labels)},
        {"fires": F.count(F.lit(1)), "total_area": F.sum("total_area")}, by=["year"])


def mean_duration_yearly(fact: DataFrame, start: str = "alarm_ts", end: str = "extinguishing_ts") -> DataFrame:
    """Mean hours from alarm to extinction per year."""
    hours = millis_between(start, end) / 3_600_000
    return fact.filter(F.col(end) > F.col(start)).groupBy("year").agg(F.avg(hours).alias("mean_hours"))


# --- temperature and severity --------------------------------------------------------------

def temperature_bands(
    fact: DataFrame, temperature: str, width: float, by: list[str] = (), severity: Column | None = None,
    duration: Column | None = None,
) -> DataFrame:
    """Fires, total and mean area, mean duration and mean severity per temperature band."""
    measures = {"fires": F.count(F.lit(1)), "total_area": F.sum("total_area"), "mean_area": F.avg("total_area")}
    if duration is not None:
        measures["mean_duration"] = F.avg(duration)
    if severity is not None:
        measures["mean_severity"] = F.avg(severity)
    return band_aggregate(fact, {"band": band(temperature, width)}, measures, by=list(by))


def area_by_response_band(fact: DataFrame, minutes: float) -> DataFrame:
    """Burned area by the time from alarm to first response, in bands of `minutes`."""
    wait = millis_between("alarm_ts", "first_response_ts") / 60_000
    answered = fact.filter(F.col("first_response_ts") > F.col("alarm_ts"))
    return band_aggregate(
        answered, {"band": band(wait, minutes)},
        {"fires": F.count(F.lit(1)), "total_area": F.sum("total_area"), "mean_area": F.avg("total_area")})
