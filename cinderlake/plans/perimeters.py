"""Fire perimeters: usable parts, their union, and the fact rows they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlake.functions import geometry as g
from cinderlake.operators import overlay
from cinderlake.plans import layers
from cinderlake.session import staged


def usable_parts(parts: DataFrame, grid: float = 1e-5) -> DataFrame:
    """Parts `fire_id, part, rings` snapped to the grid, without those that are no valid polygon.

    Rows that share a fire and a part number are judged by their own rings. The parts are staged.
    """
    keys = ["fire_id", "part", "_rings"]
    named = parts.select("fire_id", "part", F.xxhash64("rings").alias("_rings"), "rings")
    judged = overlay.judged_parts(named, keys, grid=grid).filter("_fault IS NULL")
    # Snapped once, where they are written; only parts that are judged later keep their own rings.
    judged = staged(judged.select(
        *keys, "_judged", F.when(F.col("_judged"), g.snap_rings("rings", grid)).otherwise(F.col("rings")).alias("rings")), "judged-parts")
    usable, large = judged.filter("_judged").select("fire_id", "part", "rings"), judged.filter("NOT _judged").drop("_judged")
    if large.isEmpty():
        return usable
    out = ["fire_id", "part", g.snap_rings("rings", grid).alias("rings")]
    faults = overlay.ring_faults(large, keys, grid=grid).select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return usable.unionByName(staged(large.join(faults, same, "left_anti").select(*out), "large-parts"))


def attach_united(fact: DataFrame, parts: DataFrame, key: str = "id") -> DataFrame:
    """The fact with `perimeter_parts` and `perimeter_area` of the union of its usable parts; NULL without any.

    What parts of one fire share counts once. Only the parts of a fire of few edges are gathered in one row.
    """
    usable = usable_parts(parts)
    counts = usable.groupBy(F.col("fire_id").alias("_fire")).agg(F.count(F.lit(1)).alias("perimeter_parts"))
    areas = overlay.union_areas(usable).select(F.col("fire_id").alias("_of"), F.col("area").alias("perimeter_area"))
    found = counts.join(areas, F.col("_fire") == F.col("_of"), "left").drop("_of")
    return fact.join(found, F.col(key) == F.col("_fire"), "left").drop("_fire")


def perimeters_since(fact: DataFrame, parts: DataFrame, year: int, start, limit: int | None = None) -> DataFrame:
    """`attach_united` for the fires of one year from `start` on, newest first; only their parts are looked at."""
    wanted = layers.newest_first(fact, year, start, limit)
    mine = parts.join(wanted.select(F.col("id").alias("_fire")), F.col("fire_id") == F.col("_fire"), "left_semi")
    return attach_united(wanted, mine)
