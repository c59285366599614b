"""All corpus queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from cinderlake.llm import bpe, centroids, exact_dedup, language, license_scan, line_dedup, metric_join, minmax_dedup, packing, secret_scan, spelling, token_counts, toxicity
from cinderlake.llm.shipping import ship

MODULES = (token_counts, metric_join, minmax_dedup, license_scan, toxicity, line_dedup, bpe, exact_dedup, packing, secret_scan, spelling, centroids, language)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with this package on the workers."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def corpus_queries() -> dict:
    """Query name -> (function of (spark, sf_dir), check SQL or None)."""
    out = {name: (shipped(query), sql) for module in MODULES for name, (query, sql) in module.QUERIES.items()}
    return out | {"pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)}
