"""From typed occurrences to the fire fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlake import schema
from cinderlake.functions import parsing as p
from cinderlake.operators import dimensions, spatial
from cinderlake.operators.geography import join_by_statistical_code
from cinderlake.operators.incremental import keep_before, without_keys
from cinderlake.operators.percentiles import exact_percentiles
from cinderlake.session import staged

FACT_COLUMNS = (
    "id original_id year id_rel_lau locality id_ref_fire_type ts rekindle slash_and_burn agricultural total_area "
    "brushwood_area agricultural_area inhabited_area cco_code cco_id alarm_ts id_ref_alarm_source id_ref_cause "
    "id_ref_cause_type extinguishing_ts first_response_ts temperature relative_humidity wind_speed wind_direction "
    "precipitation mean_height mean_slope file_urls lon lat created_ts updated_ts"
).split()

# Fact column -> feed column, where only the name changes.
RENAMED = {
    "locality": "LOCAL", "cco_code": "NOMECCO", "temperature": "TEMPERATURA",
    "relative_humidity": "HUMIDADERELATIVA", "wind_speed": "VENTOINTENSIDADE",
    "wind_direction": "VENTODIRECAO_VETOR", "mean_height": "ALTITUDEMEDIA", "mean_slope": "DECLIVEMEDIO",
}
FLAGS = {"rekindle": "REACENDIMENTOS", "slash_and_burn": "QUEIMADA", "agricultural": "AGRICOLA"}
AREAS = {"total_area": "AREATOTAL", "brushwood_area": "AREAMATO", "agricultural_area": "AREAAGRIC",
         "inhabited_area": "AREAPOV"}
MOMENTS = {"alarm_ts": ("DATAALERTA", "HORAALERTA"), "extinguishing_ts": ("DATAEXTINCAO", "HORAEXTINCAO"),
           "first_response_ts": ("DATA1INTERVENCAO", "HORA1INTERVENCAO")}


@dataclass
class Conformed:
    """The new fact, the extended dimensions, and the rows that could not become facts."""

    fact: DataFrame
    dimensions: dict[str, DataFrame]
    rejected: DataFrame


def fact_columns(now: Column) -> dict[str, Column]:
    """Fact columns computed from typed feed columns alone; areas turn into square metres, and the
    point is moved to a 1e-5 degree grid after it has served to find the parish."""
    columns = {
        "original_id": F.col("original_id"),
        "year": F.col("ANO"),
        "ts": p.hour_stamp(F.col("ANO"), F.col("MES"), F.col("DIA"), F.col("HORA")),
        **{out: F.col(c) for out, c in RENAMED.items()},
        **{out: F.col(c) == 1 for out, c in FLAGS.items()},
        **{out: F.col(c) * schema.HECTARE_M2 for out, c in AREAS.items()},
        "cco_id": F.col("NCCO").cast("string"),
        **{out: p.day_and_time(day, time) for out, (day, time) in MOMENTS.items()},
        "precipitation": p.drop_sentinel("PRECEPITACAO"),
        "file_urls": p.joined_list(schema.FILE_COLUMNS),
        "lon": p.snap("LON"), "lat": p.snap("LAT"),
        "created_ts": now, "updated_ts": now,
    }
    return columns


def fact_projection(typed: DataFrame, keep: tuple[str, ...] = (), now: Column | None = None) -> DataFrame:
    """The computed fact columns of typed occurrences, plus `keep`."""
    stamp = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    return typed.select(*[c.alias(n) for n, c in fact_columns(stamp).items()], *keep)


def conform(
    typed: DataFrame, parishes: DataFrame, dims: dict[str, DataFrame], *, start=None, cell: float = 0.1,
    codes: dict[str, DataFrame] | None = None, now: Column | None = None, tie: str = "all", use_ine: bool = False,
) -> Conformed:
    """Typed occurrences (from `start` on) to facts.

    New labels extend the four dimensions and known labels get their codes. Each occurrence takes
    the parish its point lies in; one on a shared border gives a row per parish. Occurrences
    without a type, id, year or time cannot be facts and are returned as `rejected`; those outside
    all parishes are dropped, or with `use_ine` take the parish of their statistical code when there
    is one. `parishes` holds `code, rings`.
    """
    codes = codes or {n: schema.code_table(typed.sparkSession, n) for n in schema.CODE_TABLES}
    if start is not None:
        # a row without a whole date is kept here, to be rejected in every mode
        typed = typed.filter(F.coalesce(p.on_or_after(F.col("ANO"), F.col("MES"), F.col("DIA"), start), F.lit(True)))
    # one pass finds the labels of all dimensions; from here on they are small tables
    labels = staged(dimensions.distinct_labels(typed, schema.DIMENSION_LABELS), "labels")
    extended = {}
    for name in schema.DIMENSION_LABELS:
        own = labels.filter(F.col("dimension") == name)
        grown = dimensions.extend_dimension(own, "raw_name", dims[name])
        extended[name] = staged(dimensions.map_codes(grown, codes[name]), f"ref-{name}")
    required = ["original_id", "ANO", "TIPO", "MES", "DIA", "HORA"]
    moment = p.hour_stamp(F.col("ANO"), F.col("MES"), F.col("DIA"), F.col("HORA"))
    complete = moment.isNotNull()
    for c in required:
        complete = complete & F.col(c).isNotNull()
    located = spatial.points_in_polygons(
        typed.filter(complete), parishes, x="LON", y="LAT", cell=cell, out="id_rel_lau", tie=tie, key=["ANO", "original_id"])
    if use_ine:
        located = _with_ine_fallback(typed.filter(complete), located, parishes)
    for name, label in schema.DIMENSION_LABELS.items():
        located = dimensions.lookup_id(located, label, extended[name], f"id_ref_{name}")
    ids = tuple(f"id_ref_{n}" for n in schema.DIMENSION_LABELS)
    # the natural key is the surrogate key: stable over reloads and unique without coordination
    key = F.concat_ws("-", F.col("year").cast("string"), "original_id", "id_rel_lau")
    fact = fact_projection(located, ("id_rel_lau", *ids), now).withColumn("id", key).select(*FACT_COLUMNS)
    return Conformed(fact, extended, typed.filter(~complete))


def _with_ine_fallback(complete: DataFrame, located: DataFrame, parishes: DataFrame) -> DataFrame:
    """`located` plus the occurrences no polygon covers whose statistical code names a parish."""
    located = staged(located, "located")  # read twice; the spatial join runs once
    found = located.select(F.col("ANO").alias("_year"), F.col("original_id").alias("_id"))
    missed = complete.join(found, (F.col("ANO") == F.col("_year")) & (F.col("original_id") == F.col("_id")), "left_anti")
    units = parishes.select("code", F.lit(None).cast("string").alias("name"), F.lit(3).alias("level")).distinct()
    by_code = join_by_statistical_code(missed, units).filter("ine_code IS NOT NULL")
    return located.unionByName(by_code.withColumn("id_rel_lau", F.col("ine_code")).drop("ine_code", "ine_name"))


def reload(fact: DataFrame, fresh: DataFrame, start) -> DataFrame:
    """The fact with everything from `start` on replaced by `fresh`; a full load replaces it all.

    A stored fire that the pull moves into the window is replaced too, not kept twice.
    """
    if start is None:
        return fresh
    return without_keys(keep_before(fact, "ts", start), fresh.select("year", "original_id").distinct(), ("year", "original_id")).unionByName(fresh)


def with_flags(df: DataFrame, columns: tuple[str, ...] = ("QUEIMADA", "QUEIMA", "FOGACHO", "INCENDIO", "AGRICOLA")) -> DataFrame:
    """Text flags replaced by booleans."""
    return df.select(*[p.flag(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def infer_unit(
    df: DataFrame, value: str, by: str, threshold: float, factor: float, out: str, point: float = 0.5
) -> DataFrame:
    """Scale a measure to its base unit where a file's typical value shows it is in the small unit.

    A file whose percentile of `value` lies above `threshold` is taken to hold the small unit and
    is multiplied by `factor`; the other files stay. This guesses, so nothing applies it by default.
    """
    typical = exact_percentiles(df, [by], value, {"_typical": point}).withColumnRenamed(by, "_file")
    return df.join(typical, F.col(by).eqNullSafe(F.col("_file")), "left").withColumn(
        out, F.when(F.col("_typical") > threshold, F.col(value) * factor).otherwise(F.col(value))
    ).drop("_typical", "_file")
