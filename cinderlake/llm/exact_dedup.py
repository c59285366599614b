"""Exact duplicates: heavy digests by a frequent-items sketch and a broadcast, the others by a shuffle.

A Misra-Gries style sketch (`approx_top_k`, which keeps a fixed number of counters and merges them)
names the digests that may be frequent. Their groups are verified by one exact aggregate, which the
map side combines, and the verified winners, at most `counters` rows, are broadcast; rows of a heavy
group are answered where they are read. No digest outside the sketch holds more than about
1/counters of the rows, so the window over the remaining digests has no crowded partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinderlake.llm.tables import table, whole_text
from cinderlake.session import staged

COUNTERS = 1024


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their UTF-8 bytes are. The row with the largest id stays. A null text is an
    empty one. A repeated row counts in group_size and shares the verdict of its id. A row without an
    id is in its group but never kept; a group of such rows only has a null keep_id. An empty table
    gives an empty result; other columns are not read.

    `counters` bounds the sketch and the broadcast: digests held by more than n / counters rows are
    always found; any other digest is only shuffled, so the result does not depend on it.
    """
    keyed = staged(docs.select(F.col(id_col).alias("doc_id"), F.sha2(whole_text(text_col), 256).alias("text_sha256")), "digests")
    frequent = keyed.agg(F.expr(f"approx_top_k(text_sha256, {counters}, {counters})").alias("top")).select(
        F.explode("top").alias("top")).select(F.col("top.item").alias("text_sha256"), F.col("top.count").alias("seen"))
    frequent = frequent.where(F.col("seen") > 1).select("text_sha256")
    winners = (keyed.join(F.broadcast(frequent), "text_sha256", "left_semi").groupBy("text_sha256")
               .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    winners = staged(winners.withColumn("heavy", F.lit(True)), "heavy-digests")
    marked = keyed.join(F.broadcast(winners), "text_sha256", "left")
    heavy = marked.where("heavy").drop("heavy")
    group = Window.partitionBy("text_sha256")
    light = marked.where("heavy IS NULL").select(
        "text_sha256", "doc_id", F.max("doc_id").over(group).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"))
    return heavy.unionByName(light).select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "text_sha256")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact groups of all documents."""
    return exact_groups(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, d.text_sha256
FROM d JOIN g ON d.text_sha256 = g.text_sha256
"""

QUERIES = {"op8_exact_dedup": (op8_exact_dedup, SQL)}
