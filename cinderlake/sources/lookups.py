"""Landed weather replies, boundaries, perimeters and place names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake import schema


def read_weather_json(spark: SparkSession, path: str | list[str], lines: bool = False) -> DataFrame:
    """Landed daily-weather replies, one row per reply.

    A file is one reply or an array of them; with `lines` it has a reply on each line, so that many
    replies land in few files and a large file is read by many tasks.
    """
    return spark.read.schema(schema.WEATHER_RESPONSE).option("multiLine", str(not lines).lower()).json(path)


def explode_daily(
    replies: DataFrame, keep: list[str], time: str, measures: dict[str, str], position: str | None = None
) -> DataFrame:
    """Parallel arrays to rows; the number of rows follows `time`, shorter arrays give NULL.

    `measures` maps output names to array columns.
    """
    rows = replies.select(*keep, *[F.col(c).alias(f"_{n}") for n, c in measures.items()],
                          F.posexplode(F.col(time)).alias("_pos", "_time"))
    out = [*keep, F.col("_time").alias("time"),
           *[F.get(F.col(f"_{n}"), F.col("_pos")).alias(n) for n in measures]]
    if position:
        out.append(F.col("_pos").alias(position))
    return rows.select(*out)


def daily_weather(replies: DataFrame) -> DataFrame:
    """`lat, lon, date, temp_max, temp_min` from weather replies."""
    flat = replies.select(
        F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
        F.col("daily.time").alias("days"),
        F.col("daily.temperature_2m_max").alias("tmax"), F.col("daily.temperature_2m_min").alias("tmin"))
    rows = explode_daily(flat, ["lat", "lon"], "days", {"temp_max": "tmax", "temp_min": "tmin"})
    return rows.select("lat", "lon", F.col("time").try_cast("date").alias("date"), "temp_max", "temp_min")


def read_boundaries(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """Prepared parish polygons: `dicofre, freguesia, concelho, distrito, rings`."""
    reader = spark.read
    if fmt == "json":
        reader = reader.schema(
            "dicofre string, freguesia string, concelho string, distrito string, "
            "rings array<array<struct<x:double,y:double>>>")
    return reader.format(fmt).load(path).select("dicofre", "freguesia", "concelho", "distrito", "rings")


def read_perimeters(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """Prepared perimeter parts: `fire_id, part, rings`."""
    return spark.read.format(fmt).load(path).select("fire_id", "part", "rings")


def place_coordinates(
    df: DataFrame, gazetteer: DataFrame, name: str, country: str | None = None, rank: str = "rank"
) -> DataFrame:
    """Latitude and longitude of the best-ranked gazetteer entry for each place name.

    `gazetteer` holds `name, country, lat, lon` and a rank, lowest first; without a match the
    coordinates are NULL. The best entry is a mergeable minimum, so a name that fills much of the
    gazetteer is reduced on the map side.
    """
    keys = ["name"] + (["country"] if country else [])
    best = (
        gazetteer.groupBy(*[F.col(k).alias(f"_{k}") for k in keys])
        .agg(F.min(F.struct(rank, "lat", "lon")).alias("_hit"))
    )
    match = F.col(name) == F.col("_name")
    if country:
        match = match & (F.col(country) == F.col("_country"))
    return df.join(best, match, "left").select(
        *[F.col(c) for c in df.columns], F.col("_hit.lat").alias("lat"), F.col("_hit.lon").alias("lon"))
