"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum and its maximum, so 64
hash evaluations make a signature of 128 values; both agree between two sets with the probability of
their Jaccard similarity, and min and max of one permutation vary less together than two minima of
independent ones. Bands of the signature are the buckets in which candidates meet; rows per band are
the most for which a pair at the threshold is missed with a probability of at most 1e-6.

Documents with the same set are one class from the start. In each bucket the members are first
compared with its smallest one, so a bucket of m near copies makes m pairs, not m squared. Only
buckets that then still hold different components are searched further, in blocks of bounded size:
members whose signatures agree closely across components stay, and their full sets meet in one task
that gives a forest of links. Every link is confirmed on the full sets; nothing is capped, and no step
puts out a row for each pair of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake.llm.components import components
from cinderlake.llm.tables import Memo, table, table_rows
from cinderlake.session import staged

PERMUTATIONS = 64
MISS = 1e-6
# Rows of a bucket that one task compares with as many others.
BLOCK = 2048
# Pairs that agree in a smaller share of the signature than the threshold less this are no candidates:
# over 5 standard deviations of 128 values.
MARGIN = 0.2
GROUP = 1_000_000
# 64-bit words of the filter that marks the documents whose full sets are wanted.
MARK_WORDS = 1 << 20

_RNG = np.random.default_rng(20240503)
_A = _RNG.integers(0, 2**64, PERMUTATIONS, np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 2**64, PERMUTATIONS, np.uint64)
_PLACE = _RNG.integers(0, 2**64, 64, np.uint64) | np.uint64(1)


def banding(similarity: float, miss: float = MISS) -> tuple[int, int]:
    """(bands, rows): the most rows a band for which (1 - s^rows)^bands <= miss."""
    for rows in range(12, 0, -1):
        bands = 2 * PERMUTATIONS // rows
        if (1 - similarity ** rows) ** bands <= miss:
            return bands, rows
    raise ValueError("the similarity is too small for this signature")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _word_hash(word: bytes) -> int:
    return int.from_bytes(blake2b(word, digest_size=8).digest(), "little")


class Shingler:
    """Sets of hashed word shingles; words are separated by 0x20 and 0x09 to 0x0D, A-Z are lower-cased."""

    def __init__(self, words: int):
        self.words, self.hash = words, Memo(_word_hash, 150_000)

    def set_of(self, text: str) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles; of all words as one, when there are fewer than a shingle has."""
        words = text.encode("utf-8", "replace").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(self.hash.__getitem__, words), np.uint64, len(words))
        k = min(self.words, len(words))
        n = len(words) - k + 1
        mix = np.full(n, k, np.uint64)
        for i in range(k):
            mix = mixed(mix * _PLACE[i] + hashes[i:i + n])
        return np.unique(mix)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of minima, then maxima, for each of the non-empty sets."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), 2 * PERMUTATIONS), np.uint64)
    for k in range(PERMUTATIONS):
        permuted = flat * _A[k] + _B[k]
        out[:, k] = np.minimum.reduceat(permuted, starts)
        out[:, PERMUTATIONS + k] = np.maximum.reduceat(permuted, starts)
    return out


def _grouped(rows: Iterator[tuple], size) -> Iterator[list[tuple]]:
    group, total = [], 0
    for row in rows:
        group.append(row)
        total += size(row)
        if total >= GROUP:
            yield group
            group, total = [], 0
    if group:
        yield group


SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sketch binary"


def signed(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """doc_id, size and digest of the set, band keys and the signature's bytes; of `docs` (doc_id, text)."""
    bands, rows = banding(similarity)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        made = ((i, shingler.set_of(t)) for i, t in table_rows(batches, "doc_id", "text"))
        for group in _grouped(made, lambda row: len(row[1]) + 100):
            full = [s for _, s in group if len(s)]
            digests = iter([np.frombuffer(blake2b(s.tobytes(), digest_size=16).digest(), np.int64) for s in full])
            if full:
                values = mixed(signatures(full))
                keys = np.zeros((len(full), bands), np.uint64)
                for r in range(rows):
                    keys = mixed(keys * _PLACE[r] + values[:, r:bands * rows:rows])
                keys = iter(keys.astype(np.int64))
                bytes_of = iter((values >> np.uint64(56)).astype(np.uint8))
            columns: tuple[list, ...] = ([], [], [], [], [], [])
            for doc_id, s in group:
                row = (doc_id, len(s), *next(digests), next(keys), next(bytes_of).tobytes()) if len(s) else (doc_id, 0, None, None, None, None)
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [f.split()[0] for f in SIGNED.split(", ")])

    return docs.mapInArrow(sign, SIGNED)


def mark_places(ids: np.ndarray) -> np.ndarray:
    """Two bit places in the filter for each id, a row each."""
    first = mixed(ids.astype(np.int64).view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15))
    return np.stack([first, mixed(first)]) % np.uint64(64 * MARK_WORDS)


def marks(wanted: DataFrame) -> np.ndarray:
    """A Bloom filter of the wanted doc_id. Its size is fixed; with very many ids it only lets more of the others through."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(mark_places(batch.column(0).to_numpy()).ravel())
            word, bit = (at >> np.uint64(6)).astype(np.int32), np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit.view(np.int64))], ["word", "bits"])

    rows = wanted.select("doc_id").mapInArrow(places, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most MARK_WORDS rows
    words = np.zeros(MARK_WORDS, np.uint64)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return words


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """doc_id and the whole set as bytes, of all wanted documents of `docs` (doc_id, text) and perhaps a few others.

    Texts are not shuffled: a filter of fixed size picks the wanted ones where they are read.
    """
    spark = docs.sparkSession
    filled = spark.sparkContext.broadcast(marks(wanted))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, marked = Shingler(words), filled.value
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            at = mark_places(batch.column(0).to_numpy())
            picked = ((marked[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(0)
            rows = [(i, shingler.set_of(t).tobytes()) for i, t in table_rows([batch.filter(pa.array(picked))], "doc_id", "text")]
            ids, sets = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["doc_id", "shingles"])

    return docs.mapInArrow(make, "doc_id long, shingles binary")


def agreeing(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree closely enough for a link."""
    least = int((percent / 100 - MARGIN) * 2 * PERMUTATIONS)

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(1) >= least))

    met = pairs.join(classes.select(F.col("rep").alias("b"), F.col("sketch").alias("sb")), "b")
    met = met.join(classes.select(F.col("rep").alias("a"), F.col("sketch").alias("sa")), "a")
    return met.select("a", "b", "sa", "sb").mapInArrow(agree, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for a, b, sa, sb in table_rows([batch], "a", "b", "sa", "sb"):
                x, y = np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    kept.append((a, b))
            left, right = zip(*kept, strict=True) if kept else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    met = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
    met = met.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
    return met.select("a", "b", "sa", "sb").mapInArrow(confirm, "a long, b long")


BUCKET = ["band", "key", "low", "high"]


def candidates(members: DataFrame, percent: int) -> DataFrame:
    """(band, key, low, high, side, rep, n, comp) of the members that may have a link to look for there.

    `members` holds band, key, m, rep, n, comp, bands, sketch. Buckets are cut into blocks, and a task
    compares two blocks. A member stays if its signature agrees closely with that of a member of another
    component, and this is the first bucket that the two share; rows never outnumber the members.
    """
    least = int((percent / 100 - MARGIN) * 2 * PERMUTATIONS)

    def compare(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        rep, comp, n, side = (group.column(c).to_numpy() for c in ("rep", "comp", "n", "side"))
        sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(len(rep), -1)
        earlier = np.array(group.column("bands").to_pylist(), np.int64)[:, :key[0].as_py()]
        rows = np.flatnonzero(side == 0)
        # In a block against itself every member is on both sides.
        columns = rows if key[2].as_py() == key[3].as_py() else np.flatnonzero(side == 1)
        stay = np.zeros(len(rep), bool)
        for i in rows:
            other = columns[(comp[columns] != comp[i]) & (100 * np.minimum(n[columns], n[i]) >= percent * np.maximum(n[columns], n[i]))]
            other = other[(sketch[other] == sketch[i]).sum(1) >= least]
            other = other[~(earlier[other] == earlier[i]).any(1)]
            stay[other] = True
            stay[i] |= len(other) > 0
        kept = group.select(["rep", "n", "comp", "side"]).filter(pa.array(stay))
        names = dict(zip(BUCKET, key, strict=True))
        for name in reversed(BUCKET):
            kept = kept.add_column(0, name, pa.array([names[name].as_py()] * kept.num_rows, names[name].type))
        return kept

    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    mine = members.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    dealt = mine.select("band", "key", "rep", "comp", "n", "bands", "sketch", "block", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = dealt.select("band", "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                         F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"), "rep", "comp", "n", "bands", "sketch")
    return dealt.groupBy(*BUCKET).applyInArrow(compare, "band int, key long, low int, high int, rep long, n long, comp long, side int")


def links_between(found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links on the full sets between components of the candidates, as a forest for each two blocks.

    Intersections of one set with all others are counted at once, through the sets that hold each shingle.
    """
    def link(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        comp, n, side = (group.column(c).to_numpy() for c in ("comp", "n", "side"))
        flat = np.frombuffer(b"".join(group.column("shingles").to_pylist()), np.uint64)
        ends = np.cumsum(n)
        _, shingle, held = np.unique(flat, return_inverse=True, return_counts=True)
        holder = np.repeat(np.arange(len(n)), n)[np.argsort(shingle, kind="stable")]
        first = np.cumsum(held) - held
        column = side == 0 if key[2].as_py() == key[3].as_py() else side == 1
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c]
            return c

        left, right = [], []
        for i in np.flatnonzero(side == 0):
            own = shingle[ends[i] - n[i]:ends[i]]
            times = held[own]
            at = np.repeat(first[own] - (np.cumsum(times) - times), times) + np.arange(times.sum())
            both = np.bincount(holder[at], minlength=len(n))
            for j in np.flatnonzero(column & (comp != comp[i]) & (100 * both >= percent * (n + n[i] - both))):
                x, y = find(int(comp[i])), find(int(comp[j]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    left.append(int(comp[i]))
                    right.append(int(comp[j]))
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    met = found.join(sets.select(F.col("doc_id").alias("rep"), "shingles"), "rep")
    return met.groupBy(*BUCKET).applyInArrow(link, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 * intersection >= percent * union of their shingle sets;
    component_id is the smallest id that links reach, and that document is kept. A null, empty or
    blank text has no shingles and links with nothing. A row without an id keeps itself out of all
    components: its component_id is null and it is kept. Repeated ids are one document in the links,
    and each of their rows is returned. An empty table gives an empty result; other columns are not read.
    """
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signs = staged(signed(text, words, percent / 100), "signatures")
    classes = signs.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("rep"), F.min_by(F.struct("n_shingles", "bands", "sketch"), "doc_id").alias("s"))
    classes = staged(classes.select("d1", "d2", "rep", F.col("s.n_shingles").alias("n"), "s.bands", "s.sketch"), "classes")

    places = classes.select("rep", "n", F.posexplode("bands").alias("band", "key"))
    buckets = places.groupBy("band", "key").agg(F.min("rep").alias("center"), F.min_by("n", "rep").alias("center_n"), F.count(F.lit(1)).alias("m")).where("m > 1")
    crowded = staged(places.join(staged(buckets, "buckets"), ["band", "key"]), "crowded")
    stars = crowded.where((F.col("rep") != F.col("center")) & (100 * F.least("n", "center_n") >= percent * F.greatest("n", "center_n")))
    stars = staged(stars.select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct(), "stars")
    stars = staged(agreeing(stars, classes, percent), "agreeing-stars")

    wanted = crowded.select(F.col("rep").alias("doc_id")).distinct()
    sets = staged(full_sets(text, wanted, words).dropDuplicates(["doc_id"]), "sets")
    edges = staged(confirmed(stars, sets, percent), "star-links")
    joined = components(edges)

    placed = crowded.join(joined.withColumnRenamed("id", "rep"), "rep", "left").withColumn("comp", F.coalesce("component_id", "rep")).drop("component_id")
    placed = staged(placed, "placed")
    split = placed.groupBy("band", "key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1").select("band", "key")
    members = placed.join(staged(split, "split-buckets"), ["band", "key"]).join(classes.select("rep", "bands", "sketch"), "rep")
    found = staged(candidates(members.select("band", "key", "m", "rep", "n", "comp", "bands", "sketch"), percent), "candidates")
    # Links between the components found so far; what they connect is contracted once more.
    more = staged(links_between(found, sets, percent), "more-links")
    final = components(more).select(F.col("id").alias("component_id"), F.col("component_id").alias("whole"))
    of_class = classes.select("d1", "d2", "rep").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    of_class = of_class.withColumn("component_id", F.coalesce("component_id", "rep")).join(final, "component_id", "left")
    of_class = of_class.select("d1", "d2", F.coalesce("whole", "component_id").alias("component_id"))
    found = signs.select("doc_id", "n_shingles", "d1", "d2").join(staged(of_class, "class-components"), ["d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def op3_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents by 3-word shingles at 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), 3, 85)


SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 85 * (na.n + nb.n - common)),
r AS (SELECT doc_id AS id, doc_id AS other FROM documents UNION SELECT r.id, l.b FROM r JOIN l ON r.other = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT id, min(other) AS component_id FROM r GROUP BY id) c ON c.id = d.doc_id
"""

QUERIES = {"op3_minmax_dedup": (op3_minmax_dedup, SQL)}
