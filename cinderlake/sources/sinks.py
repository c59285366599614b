"""Writers: filtered text, yearly text, weather tables and the year-partitioned fact."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def _refuse_input_path(df: DataFrame, path: str) -> None:
    target = path.rstrip("/")
    clash = [f for f in df.inputFiles() if f.split(":", 1)[-1].lstrip("/").startswith(target.split(":", 1)[-1].lstrip("/") + "/")
             or f.split(":", 1)[-1].lstrip("/") == target.split(":", 1)[-1].lstrip("/")]
    if clash:
        raise ValueError(f"refusing to write onto the input: {clash[0]}")


def write_pipe_csv(df: DataFrame, path: str, source_column: str = "source_file") -> None:
    """Pipe-separated output in one folder per input file; never onto the input itself."""
    _refuse_input_path(df, path)
    df.write.mode("overwrite").partitionBy(source_column).option("sep", "|").option("header", "true").csv(path)


def write_yearly_csv(df: DataFrame, path: str, year: str = "ANO", key: str = "id") -> None:
    """Pipe-separated output in one folder per year, sorted by the id as text.

    Rows are ranged on year and id, so a heavy year is spread over several files.
    """
    _refuse_input_path(df, path)
    (
        df.repartitionByRange(df[year], df[key].cast("string"))
        .sortWithinPartitions(df[year], df[key].cast("string"))
        .write.mode("overwrite").partitionBy(year)
        .option("sep", "|").option("header", "true").csv(path)
    )


def write_fact(
    df: DataFrame, path: str, year: str = "year", order: tuple[str, ...] = ("ts",), replace_all: bool = False
) -> None:
    """Year-partitioned parquet; only the years present in `df` are replaced, or with `replace_all`
    the whole table.

    Ranging on year and time keeps files of one heavy year balanced and gives each file a narrow
    time span, so the scan can skip files by their statistics.
    """
    (
        df.repartitionByRange(year, *order).sortWithinPartitions(year, *order)
        .write.mode("overwrite").option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(year).parquet(path)
    )


def stored_years(df: DataFrame, year: str = "year") -> set[int]:
    """Years present in a fact; a few dozen at most."""
    return {r[0] for r in df.select(year).distinct().collect()}


def remove_years(spark: SparkSession, path: str, years: Iterable[int], year: str = "year") -> None:
    """Drop the folders of years that have become empty, which an overwrite by partition leaves."""
    for gone in years:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{year}={gone}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_weather(detail: DataFrame, summary: DataFrame, path: str, header: bool = True) -> None:
    """Weather detail and summary as comma-separated files; empty frames keep their header."""
    for name, frame in (("meteorology", detail), ("summary", summary)):
        frame.write.mode("overwrite").option("header", str(header).lower()).csv(f"{path.rstrip('/')}/{name}")
