"""Packing documents into sequences by bin completion.

Lengths are at most the capacity, so the corpus is a histogram of at most `capacity` rows whatever
its size, and the driver plans on that: the largest length left is put into a sequence, and a
branch-and-bound enumerates undominated fillings of the rest (sizes in falling order, so none that
a larger item could replace comes first), pruned by the waste that the sizes left cannot avoid, with
the best-fit filling as the first incumbent. The filling found is used as many times as the counts
allow. Every step uses up a size for its pattern, so the plan has a few steps a length, not one a
sequence.

Pieces find their place without meeting each other: a piece's rank among those of its length, from
counts by (length, bucket) and a row number inside the bucket, is looked up in the plan. A length
that a third of all pieces share is spread over all buckets.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinderlake.llm.bpe import byte_alphabet
from cinderlake.llm.tables import Memo, table, table_rows
from cinderlake.session import staged

CAPACITY = 2048
BUCKETS = 1024
RANK_BITS = 40


# The byte-level split of texts in ASCII and Latin letters, on which regex engines agree.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER = re.compile("[^\x00-\x7f\u00a1-\u024f]")


class ByteEncoder:
    """Ids of a byte-level tokenizer file.

    Its merges are numbered like the tokens they make, so a part is encoded by merging the pair of
    lowest rank, which is much faster than through the library's own objects. Texts with other
    characters are split by the library itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre, vocab = spec["pre_tokenizer"], spec["model"]["vocab"]
        if spec["normalizer"] is not None or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("not a tokenizer of this kind")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("not a tokenizer of this kind")
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        if any(vocab[m] != 256 + k for k, m in enumerate(merges)):
            raise ValueError("the ids of merged tokens are not in the order of the merges")
        self.model = self.library.model
        self.special = [t["content"] for t in spec["added_tokens"]]
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in vocab.items() if t not in self.special}
        self.ranked = tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.parts = Memo(self._part, 100_000)

    def _part(self, part: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(part)]).tobytes()

    def ids(self, text: str) -> bytes:
        """Ids of a whole text, packed as little-endian unsigned 32-bit numbers."""
        if any(s in text for s in self.special):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        if OTHER.search(text):
            return b"".join([self.parts[p] for p, _ in self.library.pre_tokenizer.pre_tokenize_str(text)])
        return array("I", self.ranked.encode_ordinary(text)).tobytes()


_ENCODERS: dict[str, ByteEncoder] = {}


def byte_encoder(path: str) -> ByteEncoder:
    """This worker's encoder of a file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteEncoder(path)
    return _ENCODERS[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, separator: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of the documents' ids: a document's ids and the separator, cut from the end into full pieces if too long."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = byte_encoder(path), struct.pack("<I", separator)
        for batch in batches:
            rows = []
            for doc_id, text in table_rows([batch], "doc_id", "text"):
                ids = memoryview(encoder.ids(text) + end)
                total = len(ids) // 4
                start, k = 0, 0
                while start < total:
                    length = (total - 1) % capacity + 1 if k == 0 else capacity
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
                    start, k = start + length, k + 1
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return picked.mapInArrow(cut, PIECES)


def best_filling(sizes: list[int], counts: list[int], rest: int) -> list[tuple[int, int]]:
    """(index, copies) of a filling with the least waste; `sizes` fall. Among equals, the one with the largest sizes first."""
    left = np.array(sizes, dtype=object) * np.array(counts, dtype=object)
    behind = np.cumsum(left[::-1])[::-1].tolist() if sizes else []
    rising = [-s for s in sizes]
    greedy, room = [], rest
    k = bisect_left(rising, -room)
    while room and k < len(sizes):
        if copies := min(counts[k], room // sizes[k]):
            greedy.append((k, copies))
            room -= copies * sizes[k]
        k = max(k + 1, bisect_left(rising, -room))
    best, least, seen = greedy, room, set()

    def branch(k: int, room: int, chosen: list[tuple[int, int]]) -> None:
        nonlocal best, least
        if room < least:
            best, least = chosen, room
        k = max(k, bisect_left(rising, -room))
        if not least or k >= len(sizes) or (k, room) in seen:
            return
        seen.add((k, room))
        for j in range(k, len(sizes)):
            if room - behind[j] >= least:
                return
            for copies in range(min(counts[j], room // sizes[j]), 0, -1):
                branch(j + 1, room - copies * sizes[j], [*chosen, (j, copies)])
                if not least:
                    return

    branch(0, rest, [])
    return best


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns ([(size, copies), ...], times) that use up every size exactly."""
    left = {s: n for s, n in histogram.items() if n}
    if any(not 0 < s <= capacity for s in left):
        raise ValueError("a size is not between 1 and the capacity")
    steps = []
    while left:
        largest = max(left)
        left[largest] -= 1
        fits = sorted((s for s, n in left.items() if n and s <= capacity - largest), reverse=True)
        filling = best_filling(fits, [left[s] for s in fits], capacity - largest)
        left[largest] += 1
        pattern = {largest: 1}
        for k, copies in filling:
            pattern[fits[k]] = pattern.get(fits[k], 0) + copies
        times = min(left[s] // copies for s, copies in pattern.items())
        for s, copies in pattern.items():
            left[s] -= copies * times
            if not left[s]:
                del left[s]
        steps.append((list(pattern.items()), times))
    return steps


def places(steps: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Columns: size and first rank as one number, sorted; first rank; copies; first sequence; offset; size."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in steps:
        offset = 0
        for size, copies in pattern:
            first = used.get(size, 0)
            rows.append(((size << RANK_BITS) + first, first, copies, sequence, offset, size))
            used[size] = first + copies * times
            offset += size * copies
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 6).T.copy()


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, separator: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text has the separator only. A row without an id, and each of several rows with
    one id, is a document of its own. An empty table gives an empty result; other columns are not
    read. Sequences are numbered from 0; those that share a pattern hold the same lengths.
    """
    cut = staged(pieces(docs, path, capacity, separator, id_col, text_col), "pieces")
    spread = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(BUCKETS)))
    by_bucket = spread.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    histogram = {r["length"]: r["n"] for r in by_bucket.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most `capacity` rows
    table_of_places = places(plan(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, first, copies, sequence, offset, _ = table_of_places
        for batch in batches:
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            size = batch.column(batch.schema.get_field_index("length")).to_numpy()
            at = np.searchsorted(keys, (size << RANK_BITS) + rank, side="right") - 1
            turn, slot = np.divmod(rank - first[at], copies[at])
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence[at] + turn), pa.array(offset[at] + slot * size)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_bucket.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = spread.withColumn("_in", F.row_number().over(inside)).join(offsets, ["length", "_bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("_in") - 1).alias("rank"))
    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")


def op9_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op9_bin_packing": (op9_bin_packing, None)}
