"""A corpus made ready for training, stage by stage.

Each stage takes the documents its predecessor kept and returns documents with the same columns; the
last one returns the pieces of packed sequences. Every stage's input is written as Parquet and read
again, so a lost executor repeats part of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake.llm import line_dedup, minmax_dedup, packing, secret_scan, toxicity
from cinderlake.llm.shipping import ship
from cinderlake.llm.tables import table
from cinderlake.session import staged


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now; a null text keeps its n_chars."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; the field is trained on the labelled ones among them."""
    ship(spark)
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.add_scores(docs, chain, score_col="_toxic_score", spans_col="_toxic_spans")
    return scored.where(F.col("_toxic_score") < toxicity.THRESHOLD).select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stay in another one; null texts stay null."""
    ship(spark)
    found = line_dedup.drop_repeated_lines(docs.withColumnRenamed("lines", "_own_lines"))
    text = F.when(F.col("text").isNotNull(), F.col("lines.kept_text"))
    found = found.withColumn("text", text).drop("lines").withColumnRenamed("_own_lines", "lines")
    return _recounted(found.select(docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words a shingle, a similarity of 0.8 or more."""
    ship(spark)
    gone = minmax_dedup.near_duplicates(docs, words=5, percent=80).where("NOT kept").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone.distinct(), F.col("doc_id") == F.col("_gone"), "left_anti").select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the spans of secrets masked."""
    ship(spark)
    return _recounted(secret_scan.redact(docs, secret_scan.train(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 2048 tokens."""
    import public_tokenizers

    ship(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

# The toxicity, secret and packing stages are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
