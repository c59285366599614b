"""Streaming forms: live counts and the trailing refresh, batch by batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cinderlake.operators.incremental import pick_per_key
from cinderlake.session import staged
from cinderlake.sources.sinks import stored_years, write_fact


def windowed_counts(stream: DataFrame, ts: str, width: str, late: str, by: list[str] = ()) -> DataFrame:
    """Counts per time window, with state kept no longer than the allowed lateness."""
    return (
        stream.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "count")
    )


def drop_repeats(stream: DataFrame, key: str, ts: str, late: str) -> DataFrame:
    """First arrival per key within the allowed lateness."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def write_partial_counts(stream: DataFrame, keys: list[str], path: str, checkpoint: str, partial=None) -> StreamingQuery:
    """Counts of each micro-batch, stored under the batch id.

    A batch that is run again after a failure replaces its own folder, so the stored counts add up
    to the batch result however often a batch is retried. No state is kept between batches.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        rows = batch if partial is None else partial(batch)
        counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
        counts.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def total_counts(spark: SparkSession, keys: list[str], path: str, schema: str) -> DataFrame:
    """Sum of the stored partial counts."""
    stored = spark.read.schema(schema).parquet(path)
    return stored.groupBy(*keys).agg(F.sum("count").alias("count"))


def write_arrivals(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Arriving occurrences appended under their batch id, with the batch id as ingest order."""
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("ingest_seq", F.lit(batch_id).cast("bigint")) \
             .write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def current_rows(arrivals: DataFrame, keys: list[str], tie: list[str]) -> DataFrame:
    """Last write per key over all arrivals."""
    return pick_per_key(arrivals, keys, ["ingest_seq", *tie])


def write_upserts(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str], year: str = "year"
) -> StreamingQuery:
    """Each micro-batch merged into a year-partitioned table, the last row per key by `order` staying.

    Only the years of the batch are read and written, and the keys include the year. A batch that is
    run again after a failure changes nothing.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = staged(pick_per_key(batch, keys, order), "upsert")
        years = sorted(stored_years(fresh, year))
        if not years:
            return
        try:
            touched = spark.read.schema(fresh.schema).parquet(path).filter(F.col(year).isin(years)).select(*fresh.columns)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            touched = fresh.limit(0)
        write_fact(staged(pick_per_key(touched.unionByName(fresh), keys, order), "merged"), path, year, tuple(keys))

    return (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
