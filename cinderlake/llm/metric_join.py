"""Exact range join of vectors: pivots, replication by the triangle inequality, independent cells.

Vectors are scaled to length 1, where cosine >= c is a distance of at most r = sqrt(2 - 2c). Pivots
are vectors of lowest hash. A vector is native to the cell of its nearest pivot p. If it is within r
of a native of the cell of q, then d(x, q) <= d(x, p) + 2r, so it is copied to just the cells where
that holds, and where it also lies within r of the half-space nearer to q than to p. Every link of a
native is then found inside its own cell, and no pair is counted twice.

Equal vectors are one class from the start, so a vector that a third of all rows share is compared
once. A cell is cut into blocks by its measured size; a task holds two blocks. It gives each native's
number of links and a spanning forest of the links, never the pairs.

High-dimensional vectors without structure are nearly as far from one pivot as from another; then
few cells can be spared and the work is that of comparing every two blocks of a label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake.llm.components import components
from cinderlake.llm.tables import table
from cinderlake.session import staged

# One class in so many becomes a pivot; there are at most MAX_PIVOTS, which bounds what tasks carry.
CELL = 2_000
MAX_PIVOTS = 1_024
BLOCK = 4_096
# Rounding of distances and of the products that are compared first.
SLACK = 1e-6

CLASS = ["label", "h1", "h2"]


def unit(vectors: list) -> np.ndarray:
    """Vectors scaled to length 1, in double precision."""
    x = np.array([np.asarray(v, float) for v in vectors]).reshape(len(vectors), -1)
    # The scale is taken out first, so that squares of very small or large components stay finite.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def usable() -> Column:
    """Whether a row has an id, a label and a vector without null or non-finite components that isn't zero."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)
    return F.coalesce(sound, F.lit(False))


def to_cells(classes: DataFrame, pivots: dict, radius: float) -> DataFrame:
    """Each class in its own cell (native) and in those that it may have links in."""
    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts = []
            for (label, dim), group in frame.groupby(["label", "dim"]):
                there = pivots.get((label, dim))
                if there is None:
                    parts.append(group.assign(cell=0, native=True))
                    continue
                x = unit(group["embedding"].tolist())
                d = np.sqrt(np.maximum(0, 2 - 2 * (x @ there.T)))
                own = d.argmin(1)
                near = d[np.arange(len(x)), own]
                apart = np.sqrt(np.maximum(0, 2 - 2 * (there @ there.T)))[own]
                beyond = (d * d - (near * near)[:, None]) / (2 * np.maximum(apart, 1e-12))
                copied = (d <= near[:, None] + 2 * radius + SLACK) & (beyond <= radius + SLACK)
                copied[np.arange(len(x)), own] = True
                rows, cells = np.nonzero(copied)
                parts.append(group.iloc[rows].assign(cell=cells, native=cells == own[rows]))
            yield (pd.concat(parts) if parts else frame.assign(cell=0, native=True))[["label", "dim", "cell", "native", "rep", "n", "embedding"]]

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema.fields}
    return classes.select("label", "dim", "rep", "n", "embedding").mapInPandas(
        assign, f"label {kinds['label']}, dim int, cell int, native boolean, rep long, n long, embedding {kinds['embedding']}")


def links_in_cells(placed: DataFrame, cosine: float) -> DataFrame:
    """(rep, n_links, other): a count for each native, null for a row that is a link to `other`."""
    def join(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        left, right = group[group["side"] == 0], group[group["side"] == 1]
        if not len(left) or not len(right):
            return pd.DataFrame({"rep": left["rep"], "n_links": 0, "other": None})
        x, y = unit(left["embedding"].tolist()), unit(right["embedding"].tolist())
        a, b, size = left["rep"].to_numpy(), right["rep"].to_numpy(), right["n"].to_numpy()
        names, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
        at_a, at_b = inverse[:len(a)], inverse[len(a):]
        root = np.arange(len(names))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        counts = np.zeros(len(a), np.int64)
        for start in range(0, len(a), 512):
            linked = x[start:start + 512] @ y.T >= cosine - SLACK * SLACK
            linked &= at_a[start:start + 512, None] != at_b[None]
            counts[start:start + 512] = linked @ size
            for i in np.flatnonzero(linked.any(1)):
                # All that a native links with are in one tree; a tree is walked once, not once a link.
                mine = at_b[linked[i]]
                roots = {find(k) for k in np.unique(root[mine])} | {find(at_a[start + i])}
                least = min(roots)
                root[list(roots)] = least
                root[mine] = least
        tree = np.array([find(i) for i in range(len(names))])
        moved = np.flatnonzero(tree != np.arange(len(names)))
        return pd.DataFrame({
            "rep": np.concatenate([a, names[moved]]),
            "n_links": pd.array([*counts.tolist(), *[None] * len(moved)], "Int64"),
            "other": pd.array([*[None] * len(a), *names[tree[moved]].tolist()], "Int64")})

    cell = ["label", "dim", "cell"]
    sizes = staged(placed.groupBy(*cell).agg(F.sum(F.col("native").cast("int")).alias("natives"), F.count(F.lit(1)).alias("all")), "cell-sizes")
    dealt = placed.join(sizes, cell)
    rows, columns = F.ceil(F.col("natives") / BLOCK).cast("int"), F.ceil(F.col("all") / BLOCK).cast("int")
    # Natives of a block meet every block of the cell's members.
    row = F.pmod(F.xxhash64("rep"), F.greatest(rows, F.lit(1))).cast("int")
    column = F.pmod(F.xxhash64(F.lit(1), "rep"), columns).cast("int")
    kept = [*cell, "rep", "n", "embedding"]
    left = dealt.where("native").select(*kept, F.lit(0).alias("side"), row.alias("row"), F.explode(F.sequence(F.lit(0), columns - 1)).alias("column"))
    right = dealt.where("natives > 0").select(*kept, F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), rows - 1)).alias("row"), column.alias("column"))
    return left.unionByName(right).groupBy(*cell, "row", "column").applyInPandas(join, "rep long, n_links long, other long")


def metric_join(vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row of `vectors`: vec_id, n_links, component_id, kept.

    Vectors of equal label and length are linked when their cosine is `cosine` or more. One that is null,
    empty, zero, or has a null or non-finite component, or has no label or no id, links with nothing: it
    has 0 links and is its own component. Rows with equal vectors link with each other; a repeated row
    counts as another vector. Different vectors under one id are not told apart when they are the smallest
    of their classes. An empty table gives an empty result; other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("embedding"))
    sound = usable()
    rows = rows.withColumns({"h1": F.when(sound, F.xxhash64("embedding")), "h2": F.when(sound, F.xxhash64(F.lit(7), "embedding"))})
    good = rows.where(sound)
    classes = good.groupBy(*CLASS).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("embedding").alias("embedding"))
    classes = staged(classes.withColumn("dim", F.size("embedding")), "vector-classes")
    chosen = (classes.where(F.pmod(F.xxhash64(F.lit(3), "h1"), F.lit(CELL)) == 0).orderBy(F.xxhash64(F.lit(3), "h1"), "h2")
              .select("label", "dim", "embedding").limit(MAX_PIVOTS).collect())
    pivots: dict = {}
    for r in chosen:
        pivots.setdefault((r["label"], r["dim"]), []).append(r["embedding"])
    pivots = {k: unit(v) for k, v in pivots.items()}
    placed = staged(to_cells(classes, pivots, math.sqrt(2 - 2 * cosine)), "cells")
    found = staged(links_in_cells(placed, cosine), "cell-links")
    counts = found.where("n_links IS NOT NULL").groupBy("rep").agg(F.sum("n_links").alias("outside"))
    tree = components(found.where("other IS NOT NULL").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    of_class = classes.select(*CLASS, "rep", "n").join(counts, "rep", "left").join(tree.withColumnRenamed("id", "rep"), "rep", "left")
    of_class = staged(of_class.select(*CLASS, (F.coalesce("outside", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")), "class-links")
    joined = rows.select("vec_id", *CLASS).join(of_class, CLASS, "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def op2_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all embeddings at a cosine of 0.93."""
    return metric_join(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS id, vec_id AS other FROM embeddings UNION SELECT r.id, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT id, min(other) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.id = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""

QUERIES = {"op2_embedding_links": (op2_embedding_links, SQL)}
