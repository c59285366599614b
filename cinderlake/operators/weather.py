"""Incident days, their daily weather, and the summary per incident."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlake.functions.parsing import blank_to_null, num, wall_clock


def _pick(df: DataFrame, name: str) -> Column:
    """A column by name in any of its usual spellings; NULL when the frame has none."""
    hits = [c for c in df.columns if c.lower() == name.lower()]
    if not hits:
        return F.lit(None).cast("string")
    return F.coalesce(*[blank_to_null(c) for c in hits])


def incident_spans(df: DataFrame, incident: str = "id", source: str = "source_file") -> DataFrame:
    """`incident_id, source_file, lat, lon, start_date, end_date` of usable incidents.

    The combined start and end stamps come first, the separate date and time second. Without a
    start the incident is left out; without an end it lasts the one day. Incidents with a blank id
    or unreadable coordinates are left out.
    """
    def moment(combined: str, day: str, time: str) -> Column:
        d, t = _pick(df, day), _pick(df, time)
        separate = wall_clock(F.concat_ws(" ", d, F.when(d.isNotNull(), t)))
        return F.when(_pick(df, combined).isNotNull(), wall_clock(_pick(df, combined))).otherwise(separate)

    fields = F.struct(
        _pick(df, incident).alias("incident_id"), F.col(source).alias("source_file"),
        num(_pick(df, "LAT")).alias("lat"), num(_pick(df, "LON")).alias("lon"),
        moment("DHINICIO", "DATAALERTA", "HORAALERTA").cast("date").alias("start_date"),
        moment("DHFIM", "DATAEXTINCAO", "HORAEXTINCAO").cast("date").alias("end_date"))
    # one-element explode: the filter reads the parsed fields instead of parsing them again
    spans = df.select(F.inline(F.array(fields)))
    usable = spans.filter("incident_id IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND start_date IS NOT NULL")
    return usable.withColumn("end_date", F.coalesce("end_date", "start_date"))


def incident_days(spans: DataFrame) -> DataFrame:
    """One row per incident and day; an end before the start gives no day."""
    forward = spans.filter(F.col("end_date") >= F.col("start_date"))
    return forward.withColumn("date", F.explode(F.sequence("start_date", "end_date"))).drop("start_date", "end_date")


def weather_detail(
    spans: DataFrame, daily: DataFrame, at: dict[str, str] | None = None
) -> DataFrame:
    """Daily maximum and minimum temperature of each incident day; days without weather are absent.

    `at` maps coordinate columns of the incidents to those of `daily`, exact coordinates by
    default. After `snap_to_weather_cell` on both sides pass the cell columns.
    """
    at = at or {"lat": "lat", "lon": "lon"}
    right = daily.select(*[F.col(c).alias(f"_w{i}") for i, c in enumerate(at.values())],
                         F.col("date").alias("_wdate"), "temp_max", "temp_min")
    match = F.col("date") == F.col("_wdate")
    for i, c in enumerate(at):
        match = match & (F.col(c) == F.col(f"_w{i}"))
    return incident_days(spans).join(right, match).select(
        "incident_id", "source_file", "date", "lat", "lon", "temp_max", "temp_min")


def weather_summary(detail: DataFrame) -> DataFrame:
    """Span, mean temperatures and number of days per source file and incident."""
    def first_known(c: str) -> Column:
        return F.min_by(c, F.when(F.col(c).isNotNull(), F.col("date")))

    tmax, tmin = (F.when(~F.isnan(c), F.col(c)) for c in ("temp_max", "temp_min"))
    return detail.groupBy("source_file", "incident_id").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
        F.avg(tmax).alias("mean_temp_max"), F.avg(tmin).alias("mean_temp_min"),
        F.count_distinct("date").alias("n_days"),
        first_known("lat").alias("lat"), first_known("lon").alias("lon"))
