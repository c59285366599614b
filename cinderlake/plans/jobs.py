"""The jobs a user runs: clean files, extract weather, build or refresh the fact."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake import schema
from cinderlake.functions.parsing import on_or_after
from cinderlake.operators.filters import FilterChain, default_chain
from cinderlake.operators.incremental import landed_periods, last_write_wins, window_start, without_keys
from cinderlake.operators.weather import incident_spans, weather_detail, weather_summary
from cinderlake.plans import conform
from cinderlake.session import staged
from cinderlake.sources.occurrences import accepted, quarantined, read_pipe_csv, typed_occurrences
from cinderlake.sources.sinks import remove_years, stored_years, write_fact, write_pipe_csv, write_weather

# Days a daily, weekly and monthly refresh go back.
REFRESH_DAYS = {"daily": 5, "weekly": 30, "monthly": 730}


def clean_files(
    spark: SparkSession, source: str, target: str, *, pattern: str = "*.csv", recursive: bool = False,
    chain: FilterChain | None = None,
) -> None:
    """Filter every matching file into `target`, one folder per input file, all in one job."""
    rows = read_pipe_csv(spark, source, pattern=pattern, recursive=recursive)
    write_pipe_csv((chain or default_chain()).apply(rows), target)


def extract_weather(
    spark: SparkSession, source: str, daily: DataFrame, target: str, *, pattern: str = "*.csv",
    at: dict[str, str] | None = None,
) -> None:
    """Write the weather detail and summary of every incident in the matching files."""
    spans = incident_spans(read_pipe_csv(spark, source, pattern=pattern))
    detail = staged(weather_detail(spans, daily, at), "weather-detail")
    write_weather(detail, weather_summary(detail), target)


def typed_from_files(spark: SparkSession, source: str, start: dt.date | None = None, pattern: str = "*.csv", recursive: bool = False) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) occurrences of the yearly files, one row per year and id.

    The file written last wins on equal ids, the remaining columns break ties.
    """
    text = read_pipe_csv(spark, source, pattern=pattern, recursive=recursive, ingest_column="ingest_seq", na_tokens=False)
    # staged: the text is read and cast once for good rows and bad ones
    typed = typed_occurrences(text)
    if start is not None:
        # a row without a whole date stays, so that it is rejected and not lost
        typed = typed.filter(F.coalesce(on_or_after(F.col("ANO"), F.col("MES"), F.col("DIA"), start), F.lit(True)) | (F.size("bad_columns") > 0))
    typed = staged(typed, "typed-text")
    good = accepted(typed)
    return _last_written(good), quarantined(typed)


def _last_written(good: DataFrame) -> DataFrame:
    """One row per year and id of staged rows. Only rows whose key another row has are compared; the others stay as they are."""
    keys = ("ANO", "original_id")
    shared = staged(good.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys), "shared-keys")
    if shared.isEmpty():
        return good
    taken = shared.select(*[F.col(c).alias(f"_{c}") for c in keys])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    rest = [c for c in good.columns if c not in (*keys, "ingest_seq")]
    last = last_write_wins(good.join(taken, same, "left_semi"), keys, ("ingest_seq", *rest))
    # staged: it is read several times
    return staged(without_keys(good, shared, keys).unionByName(last), "typed")


def _table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], ddl)


def build_fact(
    spark: SparkSession, source: str, parishes: DataFrame, warehouse: str, *, start: dt.date | None = None,
    cell: float = 0.1, pattern: str = "*.csv", recursive: bool = False, use_ine: bool = False,
) -> None:
    """Load yearly files into `<warehouse>/fire`, growing the dimensions in `<warehouse>/ref`.

    With `start` only occurrences from that day on are loaded: the years from it on are rewritten
    with the stored facts before it and the fresh ones after it. Without it the fact is built anew.
    Everything that is read and overwritten is staged first.
    """
    root = warehouse.rstrip("/")
    good, bad = typed_from_files(spark, source, start, pattern, recursive)
    dims = {n: _table(spark, f"{root}/ref/{n}", "id int, raw_name string, code string") for n in schema.CODE_TABLES}
    done = conform.conform(good, parishes, dims, start=start, cell=cell, use_ine=use_ine)
    fresh = staged(done.fact, "fact")
    # Dimensions only grow and go first: facts of a job that dies later never hold ids that no dimension has.
    _grow_dimensions(dims, done.dimensions, f"{root}/ref")
    if start is None:
        write_fact(fresh, f"{root}/fire", replace_all=True)
    else:
        stored = _table(spark, f"{root}/fire", ", ".join(f"`{n}` {t}" for n, t in fresh.dtypes))
        touched = stored.filter(F.col("year") >= start.year)
        merged = staged(conform.reload(touched, fresh, start).select(*fresh.columns), "merged")
        old_years, new_years = stored_years(touched), stored_years(merged)
        if new_years:
            write_fact(merged, f"{root}/fire")
        remove_years(spark, f"{root}/fire", old_years - new_years)
    _write_left_out(bad, f"{root}/quarantine", start)
    _write_left_out(done.rejected, f"{root}/rejected", start)


def _grow_dimensions(stored: dict[str, DataFrame], grown: dict[str, DataFrame], path: str) -> None:
    """Append the members that are not stored yet; a table is written anew only where a stored member has another code.

    Appending keeps all stored members whenever the job dies.
    """
    for name, frame in grown.items():
        frame = staged(frame.select("id", "raw_name", "code"), "dimension")
        old = stored[name].select(F.col("id").alias("_id"), F.col("code").alias("_code"))
        known = frame.join(old, F.col("id") == F.col("_id"), "left")
        if not known.filter(F.col("_id").isNotNull() & ~F.col("code").eqNullSafe(F.col("_code"))).isEmpty():
            frame.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")
            continue
        new = known.filter(F.col("_id").isNull()).select(frame.columns).coalesce(1)
        # The first load writes a table even if it has no members.
        if stored[name].isEmpty() or not new.isEmpty():
            new.write.mode("append").parquet(f"{path}/{name}")


def _write_left_out(df: DataFrame, path: str, start: dt.date | None) -> None:
    """Rows that did not become facts, under the load that found them; a full load starts anew."""
    load = "full" if start is None else start.isoformat()
    df.withColumn("load", F.lit(load)).write.mode("overwrite").partitionBy("load").option(
        "partitionOverwriteMode", "static" if start is None else "dynamic").parquet(path)


def refresh_fact(
    spark: SparkSession, source: str, parishes: DataFrame, warehouse: str, today: dt.date, schedule: str = "daily",
    landed: str = "{year}*.csv", **options,
) -> None:
    """`build_fact` over the trailing window of a daily, weekly or monthly refresh.

    Only files of the years that the landed pulls of the window belong to are read; `landed` is the
    pattern of a year's files. A `pattern` among the options is used as it is.
    """
    days = REFRESH_DAYS[schedule]
    start = window_start(today, days)
    years = sorted({start.year, *(y for y, _, _ in landed_periods(today, days))})
    options.setdefault("pattern", "{" + ",".join(landed.format(year=y) for y in years) + "}")
    build_fact(spark, source, parishes, warehouse, start=start, **options)
