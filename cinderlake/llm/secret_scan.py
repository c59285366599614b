"""Secrets in texts: fixed patterns, and character Markov models compared by log-likelihood ratio.

Two first-order models over the characters of tokens are trained from labelled samples: what the
fixed patterns catch in a bounded sample of documents is the sample of random strings, the other long
tokens there are the ordinary identifiers. Counting is a Spark aggregate with at most two rows per
pair of characters; no text reaches the driver. A token whose likelihood under the first model exceeds
that under the second by the threshold is a span of kind `markov`.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake.llm.tables import table, table_rows

# Fixed patterns and lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "markov")
ACCESS_MIN, ASSIGN_MIN = 16, 8

TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
_HEX_CLASS = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind number, end, start of the secret itself) of the fixed patterns, in code points."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    if b"h" * 32 in text.encode("utf-8", "replace").translate(_HEX_CLASS):
        found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


class MarkovRatio:
    """Log-likelihood ratio of random strings against ordinary identifiers."""

    def __init__(self, counts: dict[tuple[int, str, str], int], uniform: float = 0.5, extra: float = 0.05):
        totals: Counter = Counter()
        for (kind, before, _), n in counts.items():
            totals[kind, before] += n
        size = len(ALPHABET)
        self.step: dict[str, float] = {}
        for before in "^" + ALPHABET:
            for char in ALPHABET:
                seen = totals[1, before]
                random = uniform / size + (1 - uniform) * ((counts.get((1, before, char), 0) / seen) if seen else 1 / size)
                plain = (counts.get((0, before, char), 0) + extra) / (totals[0, before] + extra * size)
                self.step[before + char] = math.log(random) - math.log(plain)

    def ratio(self, token: str) -> float:
        step = self.step
        return sum(step[a + b] for a, b in zip("^" + token, token, strict=False))


def transitions(text: str) -> Iterator[tuple[int, str, str]]:
    """(1 for a caught secret or 0, character before, character) of a text's labelled samples."""
    caught = base_spans(text)
    for _, _, end, start in caught:
        token = text[start:end].replace(".", "")
        yield from ((1, a, b) for a, b in zip("^" + token, token, strict=False))
    covered = [(s, e) for s, _, e, _ in caught]
    for m in re.finditer(r"[A-Za-z0-9+/_-]{6,}={0,2}", text):
        if not any(s < m.end() and m.start() < e for s, e in covered):
            yield from ((0, a, b) for a, b in zip("^" + m[0], m[0], strict=False))


def train(docs: DataFrame, sample_docs: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> MarkovRatio:
    """The ratio from the `sample_docs` documents whose ids hash lowest (all, if there are fewer).

    Without any caught secret the model of random strings is uniform; without any document the
    ordinary one is too.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for (text,) in table_rows(batches, "text"):
            counts.update(transitions(text))
        rows = [(k, a, b, n) for (k, a, b), n in counts.items()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        kinds = (pa.int32(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["kind", "before", "char", "n"])

    order = F.xxhash64(F.lit(10), F.col(id_col).cast("long"))
    cut = docs.select(order.alias("at")).orderBy("at").limit(sample_docs).agg(F.max("at").alias("at")).first()["at"]
    if cut is None:
        return MarkovRatio({})
    sample = docs.where(order <= cut).select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = sample.mapInArrow(count, "kind int, before string, char string, n long").groupBy("kind", "before", "char").agg(F.sum("n").alias("n")).collect()
    return MarkovRatio({(r["kind"], r["before"], r["char"]): r["n"] for r in rows})


def all_spans(text: str, model: MarkovRatio, threshold: float) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of base spans and of the model's, which overlap no base one."""
    base = base_spans(text)
    found = [(s, k, e) for s, k, e, _ in base]
    for m in TOKEN.finditer(text):
        if not any(s < m.end() and m.start() < e for s, _, e, _ in base) and model.ratio(m[0]) >= threshold:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end of spans, comma-joined."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with its spans, merged where they overlap, replaced by a mark."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


SCANNED = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(docs: DataFrame, model: MarkovRatio, threshold: float = 20.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are in code points, end exclusive. A null text counts as empty and has no spans (the digest
    is that of the empty string); ids may be null or repeated; an empty table gives an empty result;
    other columns are not read. Whole texts are scanned.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in table_rows([batch], "doc_id", "text"):
                spans = all_spans(text, model, threshold)
                base = [s for s in spans if s[1] < 3]
                counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                rows.append((doc_id, *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [f.split()[0] for f in SCANNED.split(", ")])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return picked.mapInArrow(find, SCANNED)


def redact(docs: DataFrame, model: MarkovRatio, threshold: float = 20.0, mark: str = "[secret]", text_col: str = "text") -> DataFrame:
    """`docs` with the spans of secrets in `text_col` replaced by `mark`; null texts stay null, other columns as they are."""
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [t and redacted(t, all_spans(t, model, threshold), mark) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(mask, docs.schema)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    docs = table(spark, sf_dir, "documents")
    return scan(docs, train(docs))


QUERIES = {"op10_secret_scan": (op10_secret_scan, None)}
