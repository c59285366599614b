"""Connected components by repeated contraction.

Every round each vertex joins its smallest neighbour if that is smaller than itself; edges are then
drawn between the joined vertices and repeated ones dropped. A star is done in one round, a chain in
about the logarithm of its length, since what is left shrinks by half or more. Minima are combined on
the map side, so a vertex with very many neighbours is no heavier than another; no neighbourhood is
ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlake.session import staged


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) of every vertex of `edges` (a, b); component_id is the smallest id that can be reached.

    Direction, repeats and loops of edges do not matter. Without edges the result is empty.
    """
    live = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    members = live.select(F.col("a").alias("id")).union(live.select("b")).distinct().withColumn("component_id", F.col("id"))
    members = staged(members, "members")
    while not live.isEmpty():
        # b > a, so each b has a smaller neighbour; the smallest of them is its parent.
        parent = live.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("p"))
        # A vertex between two others joins what its parent joins: one more step of the way.
        above = parent.select(F.col("v").alias("pv"), F.col("p").alias("pp"))
        parent = staged(parent.join(above, F.col("p") == F.col("pv"), "left").select("v", F.coalesce("pp", "p").alias("p")), "parents")
        members = staged(members.join(parent, F.col("component_id") == F.col("v"), "left")
                         .select("id", F.coalesce("p", "component_id").alias("component_id")), "members")
        left = live.join(parent, F.col("a") == F.col("v"), "left").select(F.coalesce("p", "a").alias("a"), "b")
        left = left.join(parent, F.col("b") == F.col("v"), "left").select("a", F.coalesce("p", "b").alias("b"))
        live = staged(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    return members
