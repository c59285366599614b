"""Code dimensions: new members, ids, lookups and codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ID_BUCKETS = 1024


def distinct_members(df: DataFrame, label: str) -> DataFrame:
    """Distinct lower-cased labels as `raw_name`; a missing label is not a member."""
    return df.select(F.lower(label).alias("raw_name")).filter("raw_name IS NOT NULL").distinct()


def distinct_labels(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """`dimension, raw_name` of several dimensions from one pass; `labels` maps dimension to column."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.lower(c).alias("raw_name")) for d, c in labels.items()])
    return df.select(F.inline(pairs)).filter("raw_name IS NOT NULL").distinct()


def new_members(df: DataFrame, label: str, ref: DataFrame) -> DataFrame:
    """Labels of `df` that the dimension does not know yet, compared in lower case."""
    known = ref.select(F.lower("raw_name").alias("_known"))
    return distinct_members(df, label).join(known, F.col("raw_name") == F.col("_known"), "left_anti")


def number_rows(df: DataFrame, key: str, first: int, out: str = "id") -> DataFrame:
    """Consecutive numbers from `first`, the same on every run, without one global sort.

    Rows are numbered inside hash buckets of the key and each bucket starts where the one before
    ended; only the bucket sizes meet in one place.
    """
    hashed = df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(ID_BUCKETS)))
    sizes = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = sizes.select("_bucket", (F.sum("_n").over(upto) - F.col("_n")).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return hashed.withColumn("_i", inside).join(starts, "_bucket").select(
        *df.columns, (F.lit(int(first) - 1) + F.col("_start") + F.col("_i")).cast("int").alias(out))


def extend_dimension(df: DataFrame, label: str, ref: DataFrame) -> DataFrame:
    """The dimension `id, raw_name, code` with the new labels of `df` added under fresh ids."""
    top = ref.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    added = number_rows(new_members(df, label, ref), "raw_name", top + 1)
    return ref.select("id", "raw_name", "code").unionByName(
        added.select("id", "raw_name", F.lit(None).cast("string").alias("code")))


def map_codes(ref: DataFrame, codes: DataFrame) -> DataFrame:
    """The dimension with the code of each known label; unknown labels keep what they have.

    `codes` is a fixed table of a few dozen rows, so it is broadcast.
    """
    known = codes.select(F.col("raw_name").alias("_raw"), F.col("code").alias("_code"))
    return ref.join(F.broadcast(known), F.col("raw_name") == F.col("_raw"), "left").select(
        "id", "raw_name", F.coalesce("_code", "code").alias("code"))


def lookup_id(df: DataFrame, label: str, ref: DataFrame, out: str) -> DataFrame:
    """Left join of the dimension id by lower-cased label; a missing label stays without id."""
    ids = ref.select(F.col("raw_name").alias(f"_{out}_raw"), F.col("id").alias(out))
    return df.join(ids, F.lower(F.col(label)) == F.col(f"_{out}_raw"), "left").drop(f"_{out}_raw")


def decode(df: DataFrame, id_column: str, ref: DataFrame, out: str) -> DataFrame:
    """Left join of the dimension code by id."""
    codes = ref.select(F.col("id").alias(f"_{out}_id"), F.col("code").alias(out))
    return df.join(codes, F.col(id_column) == F.col(f"_{out}_id"), "left").drop(f"_{out}_id")
