"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Documents are labelled, tokens are not. Words and word beginnings that labelled toxic documents hold
far more often than others do (a likelihood-ratio test over the sample) label the tokens: a token is
toxic where its document is and it has such a feature. A two-state chain is trained on windows of
those labelled tokens: a weight for each feature, a bias and the transitions, by gradient ascent on
the conditional likelihood with forward-backward expectations.

Scoring is exact on texts of any length at a cost of the tokens that have a feature: a stretch of g
tokens without one multiplies the forward vector by the g-th power of a fixed 2 x 2 matrix. A
logistic curve over the largest marginal and the expected number and share of toxic tokens, fitted on
the sample, gives the document's score; the marginals of single tokens give the offending offsets.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderlake.llm.tables import Memo, table, table_rows
from cinderlake.session import staged

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
BEGINNINGS = (3, 4, 5, 6, 7, 8)
EDGE = re.compile(r"^\W+|\W+$")
WORD = re.compile(r"\S+")
WINDOW = 48


def features(word: str) -> list[str]:
    """The word without punctuation around it in lower case, and its beginnings."""
    word = EDGE.sub("", word).lower()
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) >= n)] if word else []


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(F.col(id_col).cast("string")) % FOLDS


@dataclass
class Chain:
    """The trained field: feature weights, bias of the toxic state, log transitions, and the document curve."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: np.ndarray = field(default_factory=lambda: np.array([-3.0, 0.0, 0.0, 0.0]))

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("weights", "bias", "moves", "curve")}

    def prepare(self) -> None:
        """What a worker needs beside the parameters."""
        self.emission = Memo(lambda w: sum(self.weights.get(f, 0.0) for f in features(w)), 150_000)
        move = np.exp(self.moves)
        self.step = move.tolist()
        plain = move * np.array([1.0, math.exp(self.bias)])
        self.doublings = []
        for _ in range(40):
            plain = plain / plain.sum()
            self.doublings.append(plain)
            plain = plain @ plain
        self.gap = Memo(self._power, 50_000, longest=1 << 30)

    def _power(self, bits: str) -> tuple[float, float, float, float]:
        out = np.eye(2)
        for k, bit in enumerate(reversed(bits)):
            if bit == "1":
                out = out @ self.doublings[k]
                out = out / out.sum()
        return tuple(out.ravel().tolist())

    def marginals(self, words: list[str]) -> list[tuple[int, float]]:
        """(index, probability of the toxic state) of the words that have a feature."""
        emission = self.emission
        active = [(i, e) for i, e in enumerate(map(emission.__getitem__, words)) if e]
        if not active:
            return []
        (t00, t01), (t10, t11) = self.step
        a0, a1, last, forward = 1.0, 0.0, -1, []
        for i, e in active:
            if gap := i - last - 1:
                m00, m01, m10, m11 = self.gap[f"{gap:b}"]
                a0, a1 = a0 * m00 + a1 * m10, a0 * m01 + a1 * m11
            weight = math.exp(min(50.0, self.bias + e))
            a0, a1 = a0 * t00 + a1 * t10, (a0 * t01 + a1 * t11) * weight
            total = a0 + a1
            a0, a1, last = a0 / total, a1 / total, i
            forward.append((a0, a1))
        b0 = b1 = 1.0
        after, out = len(words), []
        for (i, e), (a0, a1) in zip(reversed(active), reversed(forward), strict=True):
            if gap := after - i - 1:
                m00, m01, m10, m11 = self.gap[f"{gap:b}"]
                b0, b1 = m00 * b0 + m01 * b1, m10 * b0 + m11 * b1
            total = a0 * b0 + a1 * b1
            out.append((i, a1 * b1 / total))
            weight = math.exp(min(50.0, self.bias + e))
            b0, b1 = t00 * b0 + t01 * weight * b1, t10 * b0 + t11 * weight * b1
            total = b0 + b1
            b0, b1, after = b0 / total, b1 / total, i
        return out[::-1]

    def summary(self, words: list[str]) -> tuple[list[float], list[tuple[int, float]]]:
        """What the document curve reads, and the marginals."""
        found = self.marginals(words)
        expected = sum(p for _, p in found)
        return [1.0, max((p for _, p in found), default=0.0), math.log1p(expected), expected / max(1, len(words))], found

    def score(self, x: list[float]) -> float:
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, float(np.dot(self.curve, x))))))


def select_features(counted: DataFrame, toxic: int, clean: int, min_ratio: float, max_features: int) -> list[str]:
    """The features of highest likelihood ratio, at most `max_features`; `counted` has feature, in_toxic, in_clean."""
    if not toxic or not clean:
        return []

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    k, n = F.col("in_toxic"), F.col("in_clean")
    share = toxic / (toxic + clean)
    ratio = 2 * (part(k, (k + n) * share) + part(n, (k + n) * (1 - share))
                 + part(toxic - k, (toxic + clean - k - n) * share) + part(clean - n, (toxic + clean - k - n) * (1 - share)))
    kept = counted.where((k + 0.5) / (k + n + 1) >= 0.8).withColumn("ratio", ratio).where(F.col("ratio") >= min_ratio)
    return [r["feature"] for r in kept.orderBy(F.desc("ratio"), "feature").limit(max_features).collect()]


def train_chain(windows: list[tuple[list[list[int]], list[int]]], n_features: int, steps: int = 100, ridge: float = 0.02) -> tuple[np.ndarray, float, np.ndarray]:
    """(feature weights, bias, log transitions) that maximise the conditional likelihood of labelled windows."""
    rows, length = len(windows), max(len(w) for w, _ in windows)
    mask, truth = np.zeros((rows, length), bool), np.zeros((rows, length), int)
    where, which = [], []
    for r, (tokens, labels) in enumerate(windows):
        mask[r, :len(tokens)] = True
        truth[r, :len(labels)] = labels
        for t, ids in enumerate(tokens):
            where += [r * length + t] * len(ids)
            which += ids
    where, which = np.array(where, int), np.array(which, int)
    before = np.concatenate([np.zeros((rows, 1), int), truth[:, :-1]], axis=1)
    true_moves = np.array([[((before == i) & (truth == j) & mask).sum() for j in (0, 1)] for i in (0, 1)], float)
    theta = np.zeros(n_features + 4)
    theta[n_features] = -2.0
    pace, old = np.full(theta.shape, 0.1), np.zeros(theta.shape)
    for _ in range(steps):
        w, bias, (m01, m10, m11) = theta[:n_features], theta[n_features], theta[n_features + 1:]
        move = np.exp(np.array([[0.0, m01], [m10, m11]]))
        toxic = np.exp(np.clip(bias + np.bincount(where, w[which], rows * length).reshape(rows, length), -40, 40))
        emit = np.stack([np.ones_like(toxic), toxic], axis=2)
        a, alphas = np.tile([1.0, 0.0], (rows, 1)), []
        for t in range(length):
            nxt = (a @ move) * emit[:, t]
            a = np.where(mask[:, t, None], nxt / nxt.sum(1, keepdims=True), a)
            alphas.append(a)
        b, node, moves = np.ones((rows, 2)), np.zeros((rows, length)), np.zeros((2, 2))
        for t in range(length - 1, -1, -1):
            live = mask[:, t]
            prior = alphas[t - 1] if t else np.tile([1.0, 0.0], (rows, 1))
            joint = prior[:, :, None] * move[None] * (emit[:, t] * b)[:, None, :]
            joint = joint / joint.sum((1, 2), keepdims=True) * live[:, None, None]
            moves += joint.sum(0)
            node[:, t] = joint[:, :, 1].sum(1)
            back = (emit[:, t] * b) @ move.T
            b = np.where(live[:, None], back / back.sum(1, keepdims=True), b)
        error = ((truth - node) * mask).ravel()
        moved = true_moves - moves
        slope = np.concatenate([np.bincount(which, error[where], n_features), [error.sum(), moved[0, 1], moved[1, 0], moved[1, 1]]])
        slope -= ridge * rows / 100 * theta
        # Each parameter goes its own pace, faster while its slope keeps its sign.
        same = np.sign(slope) * np.sign(old)
        pace = np.clip(np.where(same > 0, pace * 1.2, np.where(same < 0, pace * 0.5, pace)), 1e-5, 1.0)
        theta = theta + np.sign(slope) * pace
        old = slope
    m01, m10, m11 = theta[n_features + 1:]
    return theta[:n_features], float(theta[n_features]), np.array([[0.0, m01], [m10, m11]])


def fit_curve(xs: np.ndarray, ys: np.ndarray, ridge: float = 0.1, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps."""
    beta = np.zeros(xs.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(xs @ beta, -30, 30)))
        slope = xs.T @ (ys - p) - ridge * beta
        bend = (xs * (p * (1 - p))[:, None]).T @ xs + ridge * np.eye(len(beta))
        beta = beta + np.clip(np.linalg.solve(bend, slope), -5, 5)
    return beta


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = 20_000, min_ratio: float = 25.0, max_features: int = 5_000,
          max_windows: int = 2_000, id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """The field and the document curve from labelled documents outside the held-out fold.

    The sample is the `sample_docs` labelled ids of lowest hash. Bounds: features, windows and one short
    row per sampled document reach the driver. Without toxic and clean documents the score is constant.
    A null label is no label; of several labels of an id the largest counts.
    """
    order = F.xxhash64(F.lit(5), F.col("doc_id"))
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "toxic")
    known = known.where(fold("doc_id") != HELD_OUT).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    cut = known.select(order.alias("at")).orderBy("at").limit(sample_docs).agg(F.max("at").alias("at")).first()["at"]
    if cut is None:
        return Chain()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where((order <= cut) & (fold("doc_id") != HELD_OUT))
    sample = staged(texts.join(known.where(order <= cut), "doc_id"), "toxic-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {0: Counter(), 1: Counter()}
        parts = Memo(features, 100_000)
        for text, toxic in table_rows(batches, "text", "toxic"):
            seen[int(bool(toxic))].update({f for w in set(text.split()) for f in parts[w]})
        names = sorted(seen[1])  # a feature of no toxic document is never selected
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([seen[1][f] for f in names], pa.int64())], ["feature", "n"])

    def count_clean(wanted):
        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter = Counter()
            parts = Memo(lambda w: [f for f in features(w) if f in wanted], 100_000)
            for text, toxic in table_rows(batches, "text", "toxic"):
                if not toxic:
                    seen.update({f for w in set(text.split()) for f in parts[w]})
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["feature", "n"])
        return counted

    sizes = {bool(r["toxic"]): r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic or not clean:
        return Chain()
    # Enough toxic documents for the test even if no clean one has the feature, most frequent first.
    least = max(2, math.ceil(min_ratio / (2 * math.log((toxic + clean) / toxic)) / 2))
    often = sample.mapInArrow(count, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("in_toxic")).where(F.col("in_toxic") >= least)
    often = often.orderBy(F.desc("in_toxic"), "feature").limit(20 * max_features)
    wanted = {r["feature"]: r["in_toxic"] for r in often.collect()}
    spark = docs.sparkSession
    in_clean = sample.mapInArrow(count_clean(frozenset(wanted)), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("in_clean"))
    counted = spark.createDataFrame(list(wanted.items()), "feature string, in_toxic long").join(in_clean, "feature", "left").fillna(0, ["in_clean"])
    chosen = select_features(counted, toxic, clean, min_ratio, max_features)
    number = {f: k for k, f in enumerate(chosen)}
    chain = Chain()
    if chosen:
        cut_out = labelled_windows(sample, number)
        rows = [r for kind, share in ((True, 3), (False, 1)) for r in cut_out.where(F.col("found") == kind).orderBy("at").limit(max_windows * share // 4).collect()]
        windows = [(list(map(list, r["tokens"])), r["labels"]) for r in rows]
        weights, chain.bias, chain.moves = train_chain(windows, len(chosen))
        chain.weights = {f: float(weights[k]) for f, k in number.items() if weights[k]}

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain.prepare()
        rows = [(int(bool(y)), chain.summary(text.split())[0]) for text, y in table_rows(batches, "text", "toxic")]
        yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.list_(pa.float64()))], ["y", "x"])

    rows = sample.mapInArrow(summarise, "y int, x array<double>").collect()  # one short row per sampled document
    chain.curve = fit_curve(np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], float))
    return chain


def labelled_windows(sample: DataFrame, number: dict[str, int]) -> DataFrame:
    """Windows of tokens around those with a feature, and the first tokens of each text, with their labels."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Memo(lambda w: [number[f] for f in features(w) if f in number], 100_000)
        rows = []
        for doc_id, text, toxic in table_rows(batches, "doc_id", "text", "toxic"):
            tokens = [ids[w] for w in text.split()]
            starts, end = ([0] if tokens else []), WINDOW
            for i, found in enumerate(tokens):
                if found and i >= end:
                    starts.append(max(end, i - 8))
                    end = starts[-1] + WINDOW
            for s in starts[:4]:
                part = tokens[s:s + WINDOW]
                rows.append((doc_id, s, any(part), part, [int(bool(toxic and found)) for found in part]))
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.int32()))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "start", "found", "tokens", "labels"])

    windows = sample.mapInArrow(cut, "doc_id long, start long, found boolean, tokens array<array<int>>, labels array<int>")
    return windows.withColumn("at", F.xxhash64(F.lit(6), "doc_id", "start"))


def add_scores(docs: DataFrame, chain: Chain, text_col: str = "text", score_col: str = "score", spans_col: str = "toxic_spans") -> DataFrame:
    """`docs` with a score and the toxic spans (columns of these two names are replaced).

    Spans are code points, end exclusive, of the words whose marginal is 0.5 or more. A null text
    counts as empty and gets the score of a text without toxic words. Texts are read whole.
    """
    docs = docs.drop(score_col, spans_col)
    names = docs.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain.prepare()
        for batch in batches:
            scores, spans = [], []
            for text in batch.column(names.index(text_col)).to_pylist():
                words = (text or "").split()
                x, found = chain.summary(words)
                scores.append(chain.score(x))
                bad = {i: p for i, p in found if p >= 0.5}
                spans.append([{"start": m.start(), "end": m.end(), "p": bad[i]} for i, m in enumerate(WORD.finditer(text)) if i in bad] if bad else [])
            span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))], [*names, score_col, spans_col])

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())])
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType()), T.StructField(spans_col, T.ArrayType(span))])
    return docs.mapInArrow(score, schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = train(docs, table(spark, sf_dir, "labels"))
    scored = add_scores(docs, chain).select("doc_id", "score", "toxic_spans")
    return scored.select("doc_id", F.coalesce(fold("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "toxic_spans")


QUERIES = {"op5_toxicity": (op5_toxicity, None)}
