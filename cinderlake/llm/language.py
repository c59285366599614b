"""Languages by error-correcting output codes.

Every language is given a codeword, and a binary classifier over byte n-grams predicts each bit: the
weight of an n-gram is the logarithm of the ratio of its shares in the languages with and without the
bit, so a text's margin for a bit is the mean weight of its n-grams. Codewords are all splits of few
languages in two, or random ones far apart for many. Decoding adds for each codeword the exponential
loss of the margins, each bit weighted by how often its classifier is right for that language; the
nearest codeword wins, and a text whose two nearest are about as far is marked as ambiguous. Bits that
fail are outvoted by others.

n-grams are hashed to a fixed number of buckets, so a model is languages x buckets whatever the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderlake.llm.shipping import ship
from cinderlake.llm.tables import table, table_rows
from cinderlake.session import staged

BUCKET_BITS = 15
LENGTHS = 4
SAMPLE_DOCS = 5000
# Bytes and documents whose n-grams are counted at once.
CHUNK, TOGETHER = 1 << 17, 32
AMBIGUOUS = 0.1
UNDETERMINED = "und"
FOLDS, HELD_OUT = 4, 2
# A to Z become a to z; other ASCII that is no letter becomes a space.
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_STEP = np.uint32(0x9E3779B1)


def letters_of(text: str) -> bytes:
    """The text's UTF-8 bytes, ASCII letters lower-cased, everything in ASCII that is no letter as one space, and a space at both ends."""
    words = text.encode("utf-8", "replace").translate(_FOLDED).split()
    return b" " + b" ".join(words) + b" " if words else b""


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def buckets(data: bytes) -> Iterator[np.ndarray]:
    """Hash buckets of all n-grams of 1 to LENGTHS bytes, one array for each length."""
    a = np.frombuffer(data, np.uint8).astype(np.uint32)
    path = np.zeros(len(a), np.uint32)
    for n in range(LENGTHS):
        if len(a) <= n:
            return
        path = (path[:len(a) - n] + a[n:] + np.uint32(1)) * _STEP
        path ^= path >> np.uint32(15)
        yield (path * np.uint32(0x85EBCA77)) >> np.uint32(32 - BUCKET_BITS)


def counted(texts: Iterator[tuple]) -> Iterator[tuple[list[tuple], np.ndarray]]:
    """(rows, counts) of rows that end in a text: a line of n-gram counts for each row. Long texts are counted in chunks."""
    width = 1 << BUCKET_BITS
    rows: list[tuple] = []
    lines = np.zeros((TOGETHER, width), np.float32)
    for row in texts:
        data, line = letters_of(row[-1]), lines[len(rows)]
        for at in range(0, max(len(data) - LENGTHS + 1, 1), CHUNK):
            # Chunks overlap, so that every n-gram is in one of them; those of the overlap are taken off again.
            for b in buckets(data[at:at + CHUNK + LENGTHS - 1]):
                line += np.bincount(b, minlength=width)
            if at + CHUNK < len(data) - LENGTHS + 1:
                for b in buckets(data[at + CHUNK:at + CHUNK + LENGTHS - 1]):
                    line -= np.bincount(b, minlength=width)
        rows.append(row)
        if len(rows) == TOGETHER:
            yield rows, lines
            rows, lines = [], np.zeros((TOGETHER, width), np.float32)
    if rows:
        yield rows, lines[:len(rows)]


def codewords(languages: int) -> np.ndarray:
    """A row of -1 and 1 for each language; rows differ in about half of the columns, no column is constant or the reverse of another."""
    if languages < 2:
        return np.zeros((languages, 0))
    if languages <= 7:
        # All splits in two: those of the others that go with the first language.
        splits = [s for size in range(languages - 1) for s in combinations(range(1, languages), size)]
        return np.array([[1 if i == 0 or i in s else -1 for s in splits] for i in range(languages)], float)
    rng, best, apart = np.random.default_rng(languages), None, -1
    bits = math.ceil(10 * math.log2(languages))
    for _ in range(200):
        # Half of the languages on either side, so that a bit's classifier has enough of both; no column or its reverse twice.
        sides, columns = np.where(np.arange(languages) < languages // 2, 1, -1), set()
        while len(columns) < bits:
            column = rng.permutation(sides)
            columns.add(tuple((column * column[0]).tolist()))
        code = np.array(sorted(columns)).T
        agree = code @ code.T - 2 * bits * np.eye(languages, dtype=int)
        if bits - agree.max() > apart:
            best, apart = code, bits - agree.max()
    return best.astype(float)


class Model:
    """Languages, their codewords, n-gram weights for each bit, the bits' scales and their weights in decoding."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.code = codewords(len(languages))
        bits = self.code.shape[1]
        self.weights = np.zeros((1 << BUCKET_BITS, bits), np.float32)
        self.scale = np.ones(bits)
        self.trust = np.full(self.code.shape, 1 / max(bits, 1))

    def learn(self, counts: np.ndarray) -> None:
        """Weights from the n-gram counts, a row for each language; languages count alike, whatever the size of their part."""
        shares = (counts + 0.1) / (counts + 0.1).sum(1, keepdims=True)
        for b in range(self.code.shape[1]):
            with_bit, without = shares[self.code[:, b] > 0].mean(0), shares[self.code[:, b] < 0].mean(0)
            self.weights[:, b] = np.log(with_bit / without)

    def margins(self, lines: np.ndarray) -> np.ndarray:
        """A row of margins between -1 and 1 for each line of counts."""
        return np.tanh(lines @ self.weights / np.maximum(lines.sum(1, keepdims=True), 1) / self.scale)

    def decode(self, margins: np.ndarray) -> np.ndarray:
        """Losses: a row of a number for each language, the least for the nearest codeword."""
        return np.stack([(t * np.exp(-c * margins)).sum(1) for c, t in zip(self.code, self.trust, strict=True)], axis=1)

    def predict(self, margins: np.ndarray) -> list[tuple[str, float, bool]]:
        """(language, score, ambiguous) for each row; the score is the winner's share when losses are turned to probabilities."""
        if len(self.languages) < 2:
            return [(self.languages[0], 1.0, False)] * len(margins)
        losses = self.decode(margins)
        likely = np.exp(-8 * (losses - losses.min(1, keepdims=True)))
        first = losses.argmin(1)
        two = np.partition(losses, 1, axis=1)
        close = (two[:, 1] - two[:, 0]) < AMBIGUOUS * two[:, 1]
        scores = 1 / likely.sum(1)
        return [(self.languages[i], float(s), bool(c)) for i, s, c in zip(first, scores, close, strict=True)]


def fold(doc_id: str) -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def sample_of(labelled: DataFrame, per_language: int) -> DataFrame:
    """About `per_language` rows (lang, text) of each language: the ids whose hash is below a share that its number of rows gives.

    Texts are not shuffled; one row per language is broadcast.
    """
    sizes = labelled.groupBy("lang").agg(F.least(F.lit(float(per_language)) / F.count(F.lit(1)), F.lit(1.0)).alias("share"))
    at = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return labelled.join(F.broadcast(sizes), "lang").where(at < F.col("share")).select("lang", "text")


def train(docs: DataFrame, per_language: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of the languages of the labelled rows of `docs`, all of which are learned from.

    The documented bound: of a language with more rows than `per_language`, about so many are sampled, by
    the hash of their id. Rows without an id, a language or a text teach nothing; a language all of whose sampled
    texts have no letters is a language nevertheless. Repeated rows count each. Without labelled rows
    the model has no languages.
    """
    ship(docs.sparkSession)
    labelled = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        "doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    sample = staged(sample_of(labelled, per_language), "language-sample")
    width = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for rows, lines in counted(table_rows(batches, "lang", "text")):
            for (lang, _), line in zip(rows, lines, strict=True):
                seen[lang] = seen.get(lang, 0) + line.astype(np.float64)
        for lang, line in seen.items():
            at = np.flatnonzero(line)
            at = at if len(at) else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(line[at].astype(np.int64))], ["lang", "bucket", "n"])

    # Languages x buckets rows, whatever the corpus.
    counts = sample.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    model = Model(sorted(counts["lang"].unique()))
    if len(model.languages) < 2:
        return model
    number = {lang: i for i, lang in enumerate(model.languages)}
    totals = np.zeros((len(number), width))
    np.add.at(totals, (counts["lang"].map(number).to_numpy(), counts["bucket"].to_numpy()), counts["n"].to_numpy())
    model.learn(totals)

    def examine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = model.code.shape[1]
        n, right, size = np.zeros(len(number), np.int64), np.zeros((len(number), bits), np.int64), np.zeros((len(number), bits))
        for rows, lines in counted(table_rows(batches, "lang", "text")):
            own = np.array([number[lang] for lang, _ in rows])
            means = lines @ model.weights / np.maximum(lines.sum(1, keepdims=True), 1)
            np.add.at(n, own, 1)
            np.add.at(right, own, means * model.code[own] > 0)
            np.add.at(size, own, abs(means))
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(n[found]), pa.array(list(right[found]), pa.list_(pa.int64())),
                                          pa.array(list(size[found]), pa.list_(pa.float64()))], ["lang", "n", "right", "size"])

    bits = model.code.shape[1]
    parts = sample.mapInArrow(examine, "lang int, n long, right array<long>, size array<double>").select("lang", "n", F.posexplode(F.arrays_zip("right", "size")).alias("bit", "x"))
    found = parts.groupBy("lang", "bit").agg(F.sum("n").alias("n"), F.sum("x.right").alias("right"), F.sum("x.size").alias("size")).collect()  # languages x bits rows
    right, size = np.zeros((len(number), bits)), np.zeros((len(number), bits))
    for r in found:
        right[r["lang"], r["bit"]], size[r["lang"], r["bit"]] = r["right"] / r["n"], r["size"] / r["n"]
    model.scale = np.maximum(size.mean(0), 1e-9)
    # A bit that is right no oftener than by chance has no say.
    model.trust = np.maximum(2 * right - 1, 1e-6)
    model.trust /= model.trust.sum(1, keepdims=True)
    return model


def add_languages(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score", ambiguous_col: str = "ambiguous") -> DataFrame:
    """`docs` with the language of each whole text, its score (0 to 1) and whether another is about as near.

    Columns of these three names are replaced. A text that is null or has no letter is `und` with a
    score of 0, as is every text when the model has no languages; neither is ambiguous. Equally near
    languages: the first in alphabetical order, marked as ambiguous. Rows are answered one by one, so
    repeated rows and other columns don't matter. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    docs = docs.drop(lang_col, score_col, ambiguous_col)
    names = docs.columns

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, float, bool]] = [(UNDETERMINED, 0.0, False)] * batch.num_rows
            texts = batch.column(names.index(text_col)).to_pylist()
            spoken = ((i, t) for i, t in enumerate(texts) if model.languages and t is not None and has_letter(t))
            for rows, lines in counted(spoken):
                for (i, _), found in zip(rows, model.predict(model.margins(lines)), strict=True):
                    out[i] = found
            langs, scores, close = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(close, pa.bool_())],
                                             [*names, lang_col, score_col, ambiguous_col])

    schema = T.StructType([*docs.schema.fields, T.StructField(lang_col, T.StringType()), T.StructField(score_col, T.DoubleType()),
                           T.StructField(ambiguous_col, T.BooleanType())])
    return docs.mapInArrow(predict, schema)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents; a quarter of the ids is held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold("doc_id") == HELD_OUT, F.lit(False))
    model = train(docs.where(~held_out))
    found = add_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


QUERIES = {"op13_language_id": (op13_language_id, None)}
