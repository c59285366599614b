"""Three-level geography: flattening, hierarchy views and code-prefix roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlake.functions.geometry import polygon_area

UNIT_COLUMNS = ("lau3_code", "lau3", "lau2_code", "lau2", "lau1_code", "lau1")


def _level(lau: DataFrame, level: int, extra: tuple[str, ...] = ()) -> DataFrame:
    return lau.filter(F.col("level") == level).select(
        F.col("code").alias(f"lau{level}_code"), F.col("name").alias(f"lau{level}"),
        F.col("code_parent").alias(f"up{level}"), *[F.col(c) for c in extra])


def flatten_geography(lau: DataFrame) -> DataFrame:
    """One row per parish with its municipality and district; parents may be missing.

    Joining a fact needs this table once instead of three chained joins.
    """
    l3, l2, l1 = (_level(lau, n) for n in (3, 2, 1))
    return (
        l3.join(l2, F.col("up3") == F.col("lau2_code"), "left")
        .join(l1, F.col("up2") == F.col("lau1_code"), "left")
        .select(*UNIT_COLUMNS)
    )


def with_geography(fact: DataFrame, flat: DataFrame, code: str = "id_rel_lau") -> DataFrame:
    """Left join of a fact to the flat geography; rows without a parish stay."""
    return fact.join(flat, F.col(code) == F.col("lau3_code"), "left")


def level1_units(lau: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return lau.filter(F.col("level") == 1).select("code", "name", "area", *extra)


def level2_units(lau: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Municipalities with their district's name; those without a district are left out."""
    own = lau.filter(F.col("level") == 2).select("code", "name", "area", "code_parent", *extra)
    up = lau.filter(F.col("level") == 1).select(F.col("code").alias("up1"), F.col("name").alias("parent_name"))
    return own.join(up, F.col("code_parent") == F.col("up1")).select("code", "name", "area", "parent_name", *extra)


def level3_units(lau: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Parishes with the names of municipality and district."""
    own = lau.filter(F.col("level") == 3).select("code", "name", "area", "code_parent", *extra)
    mid = lau.filter(F.col("level") == 2).select(
        F.col("code").alias("up2"), F.col("name").alias("parent_name"), F.col("code_parent").alias("up2_parent"))
    top = lau.filter(F.col("level") == 1).select(
        F.col("code").alias("up1"), F.col("name").alias("grand_parent_name"))
    return (
        own.join(mid, F.col("code_parent") == F.col("up2")).join(top, F.col("up2_parent") == F.col("up1"))
        .select("code", "name", "area", "grand_parent_name", "parent_name", *extra)
    )


def rollup_by_prefix(
    parishes: DataFrame, code: str = "dicofre", names: tuple[str, str, str] = ("freguesia", "concelho", "distrito"),
    area: str = "area", lengths: tuple[int, int] = (4, 2),
) -> DataFrame:
    """`code, code_parent, name, level, area` of all three levels from parish rows.

    The upper levels take the leading `lengths` characters of the parish code; areas add up. All
    levels come from one pass: each row is expanded to its three units and summed map-side first.
    """
    mid, top = (F.substring(F.col(code), 1, n) for n in lengths)
    units = F.array(
        F.struct(F.lit(3).alias("level"), F.col(code).alias("code"), mid.alias("code_parent"),
                 F.col(names[0]).alias("name")),
        F.struct(F.lit(2).alias("level"), mid.alias("code"), top.alias("code_parent"),
                 F.col(names[1]).alias("name")),
        F.struct(F.lit(1).alias("level"), top.alias("code"), F.lit(None).cast("string").alias("code_parent"),
                 F.col(names[2]).alias("name")))
    return (
        parishes.select(F.explode(units).alias("u"), F.col(area).alias("area"))
        .groupBy("u.level", "u.code", "u.code_parent", "u.name").agg(F.sum("area").alias("area"))
        .select("code", "code_parent", "name", "level", "area")
    )


def units_from_boundaries(boundaries: DataFrame, rings: str = "rings") -> DataFrame:
    """The three-level unit table from parish polygons; areas are taken in the polygons' own units.

    Outlines of the upper levels come from `spatial.dissolved_edges` on the same code prefixes.
    """
    measured = boundaries.select("dicofre", "freguesia", "concelho", "distrito", polygon_area(rings).alias("area"))
    return rollup_by_prefix(measured)


def join_by_statistical_code(
    df: DataFrame, lau: DataFrame, ine: str = "INE", width: int = 6, level: int = 3
) -> DataFrame:
    """Parish found by the statistical code, zero-padded to the width of the unit codes; a longer code finds none."""
    digits = F.col(ine).cast("bigint").cast("string")
    padded = F.when(F.length(digits) <= width, F.lpad(digits, width, "0"))
    units = lau.filter(F.col("level") == level).select(
        F.col("code").alias("ine_code"), F.col("name").alias("ine_name"))
    return df.join(units, padded == F.col("ine_code"), "left")
