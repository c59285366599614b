"""Clusters around centroids, with zone maps along a space-filling curve.

Vectors are whole numbers, so every distance, sum and mean is exact and any partitioning gives the
same result. They are put in Hilbert order and cut into blocks; the smallest and largest component of
a block in each dimension are its box. In each round a block first meets the centroids as a box: a
centroid whose least distance to the box is above the smallest of the largest distances of any centroid
to it cannot be the nearest of one of the block's vectors. The block's vectors are compared with the
centroids that are left, at once, in arrays; with one left they need no comparison at all, and the
block's stored sum goes into the mean.

Only centroids and sums per centroid, `k` rows whatever the table's size, pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake.llm.shipping import ship
from cinderlake.llm.tables import table
from cinderlake.session import staged

SCALE = 256
# Components beyond are held at this bound, so that a squared distance is below 2**63 in 64 dimensions.
BOUND = 2**27
BLOCK = 256
# Bits of a dimension on the curve.
BITS = 4
LONGEST = 2**63 - 1


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Keys in Hilbert order of the rows of `cells`, whole numbers below 2**bits in each dimension.

    Every bit level, from the top, exchanges or flips the lower bits of the first and of each other
    dimension; a Gray code over all dimensions follows.
    """
    x = cells.astype(np.uint32).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = np.uint32((1 << level) - 1)
        for i in range(dims):
            set_ = (x[i] >> np.uint32(level)) & np.uint32(1) == 1
            swap = np.where(set_, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint32(level)) & np.uint32(1) == 1, np.uint32((1 << level) - 1), np.uint32(0))
    x ^= turn
    # The key has the top bit of every dimension first, then the next.
    planes = [(x >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of packed little-endian 32-bit whole numbers as an array."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dims)


def squared(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids, whole numbers."""
    reach = max(int(np.abs(rows).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * reach * reach * rows.shape[1] < 2**53:
        # All numbers on the way are whole and below 2**53, so doubles hold them.
        a, b = rows.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    wide = rows.astype(np.int64)
    return np.stack([((wide - c) ** 2).sum(1) for c in centroids.astype(np.int64)], axis=1)


def nearby(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers, rising, of the centroids that may be the nearest of a vector in the box, ties included."""
    c = centroids.astype(np.int64)
    least = (np.maximum(np.maximum(low - c, c - high), 0) ** 2).sum(1)
    most = (np.maximum(np.abs(c - low), np.abs(c - high)) ** 2).sum(1)
    return np.flatnonzero(least <= most.min())


def assigned(rows: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Number of the nearest centroid of every row of a block, the smaller one of ties, and the distances where they had to be compared."""
    may = nearby(low, high, centroids)
    if len(may) == 1:
        return np.full(len(rows), may[0]), None
    distances = squared(rows, centroids[may])
    at = distances.argmin(1)
    return may[at], distances[np.arange(len(rows)), at]


def whole_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the vectors with exactly `dims` components, none null or not finite; v: floor(scale * x) as packed 32-bit numbers."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)
            v = np.clip(np.floor(scale * x), -BOUND, BOUND).astype("<i4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in v], pa.binary())], ["vec_id", "v"])

    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where((F.size(vector_col) == dims) & finite)
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x")).mapInArrow(
        pack, "vec_id long, v binary")


def extent(packed: DataFrame, dims: int) -> np.ndarray | None:
    """Smallest and largest component in each dimension: two rows; None without vectors."""
    def widths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = None, None
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column(0), dims)
                low = v.min(0) if low is None else np.minimum(low, v.min(0))
                high = v.max(0) if high is None else np.maximum(high, v.max(0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(low, pa.int32()), pa.array(high, pa.int32())], ["dim", "low", "high"])

    ends = packed.select("v").mapInArrow(widths, "dim int, low int, high int").groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    rows = sorted(ends.collect())  # one row per dimension
    return np.array([[r["low"] for r in rows], [r["high"] for r in rows]], np.int64) if rows else None


ZONED = "vec_id long, v binary, block_low binary, block_high binary, block_sum binary, block_rows int"


def zoned(packed: DataFrame, ends: np.ndarray, dims: int, block: int) -> DataFrame:
    """The vectors in Hilbert order, in blocks; a block's first row has its box, its sum and its number of rows."""
    top = (1 << BITS) - 1

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.maximum(ends[1] - ends[0], 1)
        for batch in batches:
            v = matrix(batch.column(1), dims).astype(np.int64)
            keys = hilbert_keys((v - ends[0]) * top // width, BITS) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], ["vec_id", "v", "key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                v = matrix(part.column(1), dims)
                first = [x.tobytes() for x in (v.min(0), v.max(0), v.sum(0, dtype=np.int64))]
                rest = [None] * (part.num_rows - 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *[pa.array([x, *rest], pa.binary()) for x in first], pa.array([part.num_rows, *rest], pa.int32())],
                    [f.split()[0] for f in ZONED.split(", ")])

    # Equal vectors may be very many: the id takes part in the order, so they spread over partitions.
    ordered = packed.mapInArrow(keyed, "vec_id long, v binary, key binary").repartitionByRange("key", "vec_id").sortWithinPartitions("key", "vec_id")
    return staged(ordered.select("vec_id", "v").mapInArrow(cut, ZONED), "zoned-vectors")


def blocks(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, vectors, low, high, sum) of the blocks of a batch; of parts of blocks that a batch or a file cuts, as they are."""
    v = matrix(batch.column(1), dims)
    rows = batch.column(5).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(~np.isnan(rows.astype(np.float64)))
    edges = np.unique(np.concatenate([[0], starts, [len(v)]])).astype(int)
    for at, end in zip(edges, edges[1:], strict=False):
        part = v[at:end]
        if rows[at] == end - at:
            low, high = (np.frombuffer(batch.column(c)[at].as_py(), "<i4").astype(np.int64) for c in (2, 3))
            yield at, part, low, high, np.frombuffer(batch.column(4)[at].as_py(), "<i8")
        else:
            yield at, part, part.min(0).astype(np.int64), part.max(0).astype(np.int64), part.sum(0, dtype=np.int64)


def moved(zones: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: of each its vectors' mean, rounded down; as it was, if it has none."""
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for _, v, low, high, total in blocks(batch, dims):
                cluster, compared = assigned(v, low, high, centroids)
                if compared is None:
                    counts[cluster[0]] += len(v)
                    sums[cluster[0]] += total
                else:
                    order = np.argsort(cluster, kind="stable")
                    found, first = np.unique(cluster[order], return_index=True)
                    sums[found] += np.add.reduceat(v[order].astype(np.int64), first)
                    counts += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))], ["cluster", "n", "s"])

    parts = zones.mapInArrow(add, "cluster int, n long, s array<long>")
    totals = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.get("s", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)])
    out = centroids.copy()
    for row in totals.collect():  # one row per centroid
        out[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dims)]
    return out


def nearest(zones: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of all vectors."""
    dims = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = np.empty(batch.num_rows, np.int32), np.empty(batch.num_rows, np.int64)
            for at, v, low, high, _ in blocks(batch, dims):
                found, compared = assigned(v, low, high, centroids)
                cluster[at:at + len(v)] = found
                distance[at:at + len(v)] = squared(v, centroids[found[:1]])[:, 0] if compared is None else compared
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return zones.mapInArrow(assign, "vec_id long, cluster int, distance long")


def first_centroids(packed: DataFrame, k: int, seed: int) -> np.ndarray | None:
    """The `k` vectors whose `<seed>:<id>` have the smallest sha256, in that order; of repeated ids the smaller vector first."""
    keyed = packed.where("vec_id IS NOT NULL").withColumn("_hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    rows = keyed.orderBy("_hash", "v").limit(k).collect()  # a top-k
    return np.array([np.frombuffer(r["v"], "<i4") for r in rows], np.int64) if rows else None


def clusters(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, dims: int = 64, scale: int = SCALE, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are the vectors with exactly `dims` components, none null or not finite; a component x counts
    as floor(scale * x), at most 2**27 either way. After `rounds` rounds of nearest centroid and mean
    rounded down, vectors are assigned once more; of equal distances the smaller number counts. With
    fewer vectors than `k` each is a first centroid. A row without an id is clustered like another but
    no first centroid; without any id there is one centroid, at 0. A repeated row is a vector of its
    own. Sums above 2**63 - 1 are given as that. An empty table gives an empty result; other columns
    are not read.
    """
    ship(vectors.sparkSession)
    packed = staged(whole_vectors(vectors, dims, scale, id_col, vector_col), "whole-vectors")
    ends = extent(packed, dims)
    if ends is None:
        return packed.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"))
    zones = zoned(packed, ends, dims, block)
    centroids = first_centroids(packed, k, seed)
    if centroids is None:
        centroids = np.zeros((1, dims), np.int64)
    for _ in range(rounds):
        centroids = moved(zones, centroids)
    found = staged(nearest(zones, centroids), "clusters")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # one row per centroid

    def held(total) -> int:
        return min(int(total), LONGEST)

    whole = held(sum(r["s"] for r in sums))
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = vectors.sparkSession.createDataFrame([(r["cluster"], held(r["s"]), whole, digests[r["cluster"]]) for r in sums],
                                                 "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty clusters of all embeddings after five rounds."""
    return clusters(table(spark, sf_dir, "embeddings"))


def _sql(rounds: int = 5) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS MATERIALIZED (
  SELECT v.r, c.c, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS d FROM v JOIN c{r} c ON v.i = c.i GROUP BY v.r, c.c),
a{r} AS MATERIALIZED (SELECT r, c, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1),
n{r} AS MATERIALIZED (
  SELECT a.c, v.i, sum(v.x)::BIGINT AS s, count(*) AS n FROM a{r} a JOIN v ON v.r = a.r GROUP BY a.c, v.i),
c{r + 1} AS MATERIALIZED (
  SELECT c.c, c.i, CASE WHEN n.n IS NULL THEN c.x ELSE (n.s - ((n.s % n.n) + n.n) % n.n) // n.n END AS x
  FROM c{r} c LEFT JOIN n{r} n ON n.c = c.c AND n.i = c.i)""")
    return f"""
WITH e AS MATERIALIZED (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS r, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
v AS MATERIALIZED (
  SELECT r, i, CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x FROM (SELECT r, embedding, unnest(range(1, 65)) AS i FROM e)),
first AS (
  SELECT r, row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR))) - 1 AS c FROM e
  QUALIFY c < 40),
c0 AS MATERIALIZED (SELECT first.c, v.i, v.x FROM first JOIN v ON v.r = first.r),
{",".join(steps)},
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT e.vec_id, CAST(a.c AS INT) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN e ON e.r = a.r JOIN h ON h.c = a.c
"""


QUERIES = {"op12_centroid_clusters": (op12_centroid_clusters, _sql())}
