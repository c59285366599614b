"""Repeated lines: levelled sorted runs of line hashes, and an anti-join of each batch with the runs.

The index is a set of runs on shared storage, each sorted by the 128-bit hash of the line's key.
Batches come in falling order of document id. A batch is merged with the runs: keys that no run has
(anti-join) enter with their owner, the largest id of the batch and so of the corpus; keys already
known only add to the count. Both become the batch's own run at level 0. When a level has `fan_in`
runs they are compacted into one run of the next level, so a key is rewritten once a level.

Only hashes travel: lines are hashed beside the scan, 24 bytes a line; texts are shuffled once, to
meet the hashes of the lines they lose.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake.llm.tables import BLANKS, ascii_lower, table, whole_text
from cinderlake.session import scratch_path, staged

KEY = ["h1", "h2"]
RUN = "h1 long, h2 long, owner long, n_docs long"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def key_hash(key: Column) -> Column:
    """128 bits as two hashes of different seed."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"))


class LineRuns:
    """Levelled runs of (h1, h2, owner, n_docs) below the shared folder."""

    def __init__(self, spark: SparkSession, fan_in: int = 4):
        self.spark, self.fan_in = spark, fan_in
        self.root = scratch_path(spark, "line-runs")
        self.levels: list[list[str]] = [[]]
        self.written = 0

    def _write(self, run: DataFrame) -> str:
        path = f"{self.root}/run-{self.written}"
        self.written += 1
        run.sortWithinPartitions(*KEY).write.parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(RUN).parquet(*paths)

    def runs(self) -> list[str]:
        return [path for level in self.levels for path in level]

    def add(self, batch: DataFrame) -> None:
        """Merge a batch of (h1, h2, doc_id), one row per document and key, whose ids are below all earlier ones."""
        mine = batch.groupBy(*KEY).agg(F.max("doc_id").alias("owner"), F.count(F.lit(1)).alias("n_docs"))
        paths = self.runs()
        if paths:
            # The merge anti-join: what no run has is new, the rest only counts.
            known = self._read(paths).groupBy(*KEY).agg(F.lit(True).alias("known"))
            mine = mine.join(known, KEY, "left").select(
                *KEY, F.when(F.col("known").isNull(), F.col("owner")).alias("owner"), "n_docs")
        self.levels[0].append(self._write(mine))
        for level, paths in enumerate(self.levels):
            if len(paths) >= self.fan_in:
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._write(self._merged(paths)))
                self.levels[level] = []

    def _merged(self, paths: list[str]) -> DataFrame:
        return self._read(paths).groupBy(*KEY).agg(F.max("owner").alias("owner"), F.sum("n_docs").alias("n_docs"))

    def frequent(self, min_docs: int) -> DataFrame:
        """(h1, h2, owner) of the keys held by at least `min_docs` documents."""
        paths = self.runs()
        if not paths:
            return self.spark.createDataFrame([], "h1 long, h2 long, owner long")
        return self._merged(paths).where(F.col("n_docs") >= min_docs).select(*KEY, "owner")


def drop_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with a struct column `lines` of n_lines, n_dropped and the kept text.

    A line whose key has `min_chars` code points or more and is found in `min_docs` documents or more
    stays only in the largest id that holds it; the others stay, joined by a newline. A null or empty
    text is one empty line; a text that loses all lines becomes empty. Rows without an id lose nothing
    and do not count. A repeated row is a document of its own, and rows that share the largest id all
    keep the line. `batches` splits the ids into ranges of about equal size. A column named `lines` is
    replaced; names that begin with `_lost` or `_kept` are reserved.
    """
    spark = docs.sparkSession
    lines = F.split(whole_text(text_col), "\n", -1)
    keys = F.filter(F.transform(lines, line_key), lambda k: F.length(k) >= min_chars)
    hashed = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.explode(F.array_distinct(F.transform(keys, key_hash))).alias("h"))
    hashed = staged(hashed.select("doc_id", "h.h1", "h.h2"), "line-hashes")
    cuts = hashed.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000).alias("at")).first()["at"]
    runs = LineRuns(spark)
    edges = [None, *sorted(set(cuts)), None] if cuts else [None, None]
    for low, high in reversed(list(zip(edges, edges[1:], strict=False))):
        inside = [F.col("doc_id") > low] * (low is not None) + [F.col("doc_id") <= high] * (high is not None)
        runs.add(hashed.where(reduce(Column.__and__, inside, F.lit(True))))
    frequent = staged(runs.frequent(min_docs), "frequent-lines")
    lost = (hashed.join(frequent, KEY).where(F.col("doc_id") < F.col("owner"))
            .groupBy("doc_id").agg(F.collect_list(F.struct(*KEY)).alias("_lost_hashes")))
    kept = F.filter(lines, lambda line: ~((F.length(line_key(line)) >= min_chars) & F.array_contains("_lost_hashes", key_hash(line_key(line)))))
    kept = F.when(F.col("_lost_hashes").isNull(), lines).otherwise(kept)
    kept_text = F.when(F.col("_lost_hashes").isNull(), whole_text(text_col)).otherwise(F.array_join("_kept_lines", "\n"))
    found = docs.join(lost.withColumnRenamed("doc_id", "_lost_id").hint("shuffle_hash"), F.col(id_col) == F.col("_lost_id"), "left")
    found = found.withColumn("_kept_lines", kept)
    return found.select(*[c for c in docs.columns if c != "lines"], F.struct(
        F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size("_kept_lines")).cast("long").alias("n_dropped"),
        kept_text.alias("kept_text")).alias("lines"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept and dropped in all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs).select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.kept_text", 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
k AS (SELECT doc_id, line, pos,
             translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.line, k.pos, coalesce(k.doc_id < c.owner, false) AS lost FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

QUERIES = {"op6_line_dedup": (op6_line_dedup, SQL)}
