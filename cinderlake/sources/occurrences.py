"""Occurrence files: XML and pipe-separated text, and their typed form."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake import schema

# Files have up to 80 columns, so the per-column expressions below are SQL text: one parse each
# select instead of thousands of calls into the JVM.
NA_LIST = ", ".join("'" + token + "'" for token in schema.NA_TOKENS)


def read_occurrence_xml(spark: SparkSession, path: str | list[str], row_tag: str) -> DataFrame:
    """Occurrences of landed XML replies, one row per `row_tag` element.

    `id` is the element's attribute, the other columns its children; a child that is absent is
    NULL, a reply that only says "no data" gives no rows, and a cell holding exactly `|` becomes
    `/`. Elements are split by Spark's XML reader, so one large reply is read by many tasks.
    """
    raw = (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("attributePrefix", "")
        .schema(schema.occurrence_schema())
        .load(path)
    )
    cells = [F.when(F.col(c) == "|", F.lit("/")).otherwise(F.col(c)).alias(c) for c in raw.columns]
    any_value = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in raw.columns])
    return raw.select(*cells).filter(any_value)


def plain_name(name: Column) -> Column:
    """A file's name as it was written; names in Spark's file metadata are percent-encoded, with `+` as itself."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def find_files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """`source_file, path, modified` of the matching files, sorted by name; no such folder gives no rows."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern) \
                       .option("recursiveFileLookup", str(recursive).lower())
    try:
        found = reader.load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "source_file string, path string, modified timestamp")
    return found.select(
        F.element_at(F.split("path", "/"), -1).alias("source_file"), "path", F.col("modificationTime").alias("modified"),
    ).orderBy("source_file", "path")


def _text_reader(spark: SparkSession):
    return (
        spark.read.option("sep", "|").option("header", "true").option("inferSchema", "false")
        .option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"')
    )


def read_pipe_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    columns: list[str] | None = None,
    pattern: str | None = None,
    recursive: bool = False,
    encoding: str | None = None,
    na_tokens: bool = True,
    source_column: str = "source_file",
    ingest_column: str | None = None,
) -> DataFrame:
    """Pipe-separated files as text columns plus the name of the file each row came from.

    `ingest_column` adds the file's modification time in microseconds, an explicit write order.

    Each file is read by its own header, with names trimmed, and files are united by name; a column
    that a file lacks is NULL. With `columns` given, the header of each file is checked against them
    instead. With `encoding=None` each file is taken as UTF-8, or as Latin-1 as a whole when any of its
    lines is not valid UTF-8. Headers and encodings come from one scan of the lines as they are; the
    driver gets one row per header and encoding, with the names of its files, as a reader needs them.
    """
    tags = [source_column] + ([ingest_column] if ingest_column else [])
    groups = _file_groups(spark, path, recursive, pattern)
    if not groups:
        names = columns or []
        empty = ", ".join([f"{_quoted(c)} string" for c in names] + [f"`{source_column}` string"] + [f"`{c}` bigint" for c in tags[1:]])
        return spark.createDataFrame([], empty)
    parts = []
    for header, latin, files in groups:
        names = columns or header
        reader = _text_reader(spark).schema(", ".join(f"{_quoted(c)} string" for c in names))
        reader = reader.option("enforceSchema", "true" if columns is None else "false")
        raw = reader.option("encoding", encoding or ("ISO-8859-1" if latin else "UTF-8")).csv(files)
        parts.append(_with_file_tags(raw, tags))
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    names = [c for c in rows.columns if c not in tags]
    if na_tokens:
        return rows.selectExpr(*[f"CASE WHEN {c} NOT IN ({NA_LIST}) THEN {c} END AS {c}" for c in map(_quoted, names)], *tags)
    return rows.select(*map(_quoted, names), *tags)


def _file_groups(spark: SparkSession, path: str | list[str], recursive: bool, pattern: str | None) -> list[tuple[list[str], bool, list[str]]]:
    """(header names, whether Latin-1, files) of the files that have lines, in the order of their first file."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    # Lines of a split keep their order, so the first line of a file is the least id of the split at 0.
    lines = reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"))
    text = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), "ISO-8859-1"))
    per_file = lines.groupBy("file").agg(
        F.min_by(text, F.when(F.col("start") == 0, F.col("line"))).alias("header"),
        F.bool_or(~F.is_valid_utf8("value")).alias("latin"))
    found = per_file.groupBy("header", "latin").agg(F.array_sort(F.collect_list("file")).alias("files")).collect()
    groups = []
    for row in sorted(found, key=lambda r: r["files"][0]):
        names = [c.strip().strip('"').strip() for c in row["header"].lstrip("\ufeff").rstrip("\r").split("|")]
        groups.append((names, row["latin"], [unquote(f) for f in row["files"]]))
    return groups


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _with_file_tags(raw: DataFrame, tags: list[str]) -> DataFrame:
    values = [plain_name(F.col("_metadata.file_name")), F.unix_micros("_metadata.file_modification_time")]
    return raw.select("*", *[v.alias(n) for v, n in zip(values, tags)])


def typed_occurrences(text: DataFrame) -> DataFrame:
    """Cast every feed column to its warehouse type.

    `id` is renamed `original_id`. A cell that has text but cannot be cast is NULL and its column
    is listed in `bad_columns`, so one bad value costs one row and not the load; split the result
    with `accepted` and `quarantined`.
    """
    types = {c: t for c, t in schema.typed_columns().items() if c in text.columns}

    def cast(c: str) -> str:
        return f"try_cast(nullif({_quoted(c)}, '') AS {types[c]})"

    failed = ", ".join(
        f"CASE WHEN nullif({_quoted(c)}, '') IS NOT NULL AND {cast(c)} IS NULL THEN '{c}' END"
        for c, t in types.items() if t != "string")
    return text.selectExpr(
        *[f"{cast(c)} AS {'original_id' if c == 'id' else _quoted(c)}" for c in types],
        *[_quoted(c) for c in text.columns if c not in types],
        f"array_compact(array({failed or 'cast(null AS string)'})) AS bad_columns",
    )


def accepted(typed: DataFrame) -> DataFrame:
    """Rows whose every cell could be typed."""
    return typed.filter(F.size("bad_columns") == 0).drop("bad_columns")


def quarantined(typed: DataFrame) -> DataFrame:
    """Rows with at least one cell that could not be typed, with the names of those columns."""
    return typed.filter(F.size("bad_columns") > 0)
