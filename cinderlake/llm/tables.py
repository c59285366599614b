"""Reading the supplied tables, and small column helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# The characters 0x20 and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is.

    `lower` does the same for pure ASCII and is much faster there; a text is pure ASCII when it has
    as many bytes as characters.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def table_rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of the named columns; one batch is held at a time."""
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns), strict=True)


class Memo(dict):
    """A worker's memory of `compute(key)`: what was asked for lately, at most 2 * `size` keys, none longer than `longest`."""

    def __init__(self, compute: Callable, size: int = 300_000, longest: int = 200):
        super().__init__()
        self.compute, self.size, self.longest, self.before = compute, size, longest, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value
