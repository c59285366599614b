"""Spelling variants: words one edit apart, by a dictionary of pairs of trie nodes.

Every prefix of a word is a node of the forward trie and every suffix one of the reversed trie. With
the nodes numbered, a word is written down as integer pairs: (prefix, suffix) around each skipped
letter, and (prefix, suffix) around each gap between letters, where a letter could stand. Two words
that differ by a replaced letter meet in the pair of their skipped letters; a word and the one that
has a letter more meet where the gap of the first is the skipped letter of the second. Of a run of
equal letters only the first may be skipped against a gap, so two words meet exactly once.

A pair of nodes fixes a word but for one letter, so what meets in a pair is at most one word for each
letter of the alphabet, and one more: no group can be crowded, and no rows of pairs of words are put
out; each word takes the number and the best of its neighbours from the pair.

Nodes near the root, which very many words share, are numbered by their letters; deeper ones get their
number from a table of distinct nodes, keyed by a 128-bit digest of the path.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinderlake.llm.shipping import ship
from cinderlake.llm.tables import ascii_lower, table, table_rows
from cinderlake.session import staged

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
# A node of this depth or less is numbered by its letters, 21 bits each.
SHALLOW = 3
# Numbers of deeper nodes begin here, above all packed letters.
DEEP = 1 << 61 | 1 << 62
ROWS = 50_000


def node_keys(letters: list[int]) -> tuple[list[int | None], list[bytes | None]]:
    """For each depth from the root to the whole path: the packed letters of a shallow node, else None; the digest of a deep one, else None."""
    packed: list[int | None] = [0]
    for c in letters[:SHALLOW]:
        packed.append(packed[-1] << 21 | c)
    digests: list[bytes | None] = [None] * len(packed)
    path = blake2b(b"".join(c.to_bytes(3, "little") for c in letters[:SHALLOW]), digest_size=16)
    for c in letters[SHALLOW:]:
        path.update(c.to_bytes(3, "little"))
        packed.append(None)
        digests.append(path.copy().digest())
    return packed, digests


RECORD = "word_id long, n long, whole boolean, free boolean, p long, p_key binary, s long, s_key binary"
KINDS = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.binary(), pa.int64(), pa.binary())


def records(words: DataFrame) -> DataFrame:
    """The pairs of every word of (word_id, word, n), nodes by number or by digest; 2 * length + 1 rows a word.

    `whole` pairs are around a gap, the others around a skipped letter; `free` letters begin a run.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * len(KINDS)
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, KINDS, strict=True)], [f.split()[0] for f in RECORD.split(", ")])

        for word_id, word, n in table_rows(batches, "word_id", "word", "n"):
            letters = list(map(ord, word))
            size = len(letters)
            p, p_key = node_keys(letters)
            s, s_key = node_keys(letters[::-1])
            for i in range(size + 1):
                out.append((word_id, n, True, False, p[i], p_key[i], s[size - i], s_key[size - i]))
                if i < size:
                    free = i == 0 or letters[i] != letters[i - 1]
                    out.append((word_id, n, False, free, p[i], p_key[i], s[size - i - 1], s_key[size - i - 1]))
                if len(out) >= ROWS:
                    yield batch()
        yield batch()

    return words.select("word_id", "word", "n").mapInArrow(write, RECORD)


def numbered(rows: DataFrame, side: str) -> DataFrame:
    """`rows` with the digest column of `side` (p or s) replaced by the number of the node."""
    key = f"{side}_key"
    deep = rows.where(F.col(key).isNotNull())
    nodes = deep.select(key).distinct().select(key, (F.monotonically_increasing_id() + F.lit(DEEP)).alias("_number"))
    deep = deep.join(staged(nodes, f"trie-{side}"), key).withColumn(side, F.col("_number"))
    return rows.where(F.col(key).isNull()).drop(key).unionByName(deep.drop(key, "_number"))


def neighbours(words: DataFrame) -> DataFrame:
    """(word_id, n_near, best_n, best_id) of the words of (word_id, word, n) that have a near word.

    Near words differ by exactly one inserted, deleted or replaced code point. The best one has the
    largest n; of equal ones the smallest word_id. Words are distinct.
    """
    pairs = numbered(staged(numbered(staged(records(words), "word-pairs"), "p"), "word-pairs-p"), "s")
    # At most one word for each letter of the alphabet, and one: a window and a list of bounded size.
    met = pairs.withColumn("_met", F.count(F.lit(1)).over(Window.partitionBy("p", "s"))).where("_met > 1")
    groups = met.groupBy("p", "s").agg(F.collect_list(F.struct("whole", "free", "n", "word_id")).alias("members"))
    mine = groups.select("members", F.explode("members").alias("me"))

    def near(x):
        replaced = ~F.col("me.whole") & ~x["whole"] & (x["word_id"] != F.col("me.word_id"))
        return replaced | (F.col("me.whole") & ~x["whole"] & x["free"]) | (F.col("me.free") & x["whole"])

    found = mine.select("me.word_id", F.filter("members", near).alias("near")).where(F.size("near") > 0)
    found = found.select("word_id", F.size("near").cast("long").alias("near"), F.array_max(F.transform(
        "near", lambda x: F.struct(x["n"].alias("n"), (-x["word_id"]).alias("turned")))).alias("best"))
    return found.groupBy("word_id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best")).select(
        "word_id", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.turned")).alias("best_id"))


def roots(forms: DataFrame) -> DataFrame:
    """(word_id, root_id): the last of the forms that follow from each row of (word_id, form_id).

    A form is `ratio` times as frequent as its word, so a chain has at most some dozens of steps, and
    each round doubles the step.
    """
    at = staged(forms.select("word_id", F.col("form_id").alias("root_id")), "roots")
    while True:
        then = at.select(F.col("word_id").alias("_from"), F.col("root_id").alias("_to"))
        moved = at.join(then, F.col("root_id") == F.col("_from"), "left")
        at = staged(moved.select("word_id", F.coalesce("_to", "root_id").alias("root_id"), F.col("_to").isNotNull().alias("moved")), "roots")
        if at.where("moved").isEmpty():
            return at.select("word_id", "root_id")
        at = at.select("word_id", "root_id")


def spelling_variants(counts: DataFrame, ratio: int = RATIO, word_col: str = "word", n_col: str = "n") -> DataFrame:
    """One row per word of `counts`: word, form, root, n, n_near, form_n.

    `form` is the near word (one code point inserted, deleted or replaced) of largest n, of equal ones
    the smallest in code-point order, if its n is at least `ratio` (2 or more) times that of the word; `root` is the end of the
    forms that follow from the word, or the word itself. A repeated word counts once with the sum of
    its n; a null word is left out, a null n is 0; the empty word is a word. An empty table gives an
    empty result; other columns are not read. Words may be of any length.
    """
    if ratio < 2:
        raise ValueError("forms have to be more frequent than their words")
    ship(counts.sparkSession)
    sums = counts.where(F.col(word_col).isNotNull()).groupBy(F.col(word_col).alias("word")).agg(
        F.coalesce(F.sum(F.col(n_col)).cast("long"), F.lit(0)).alias("n"))
    # Numbered in the order of the words, so that of equal counts the smallest number is the smallest word.
    words = staged(sums.orderBy("word").select(F.monotonically_increasing_id().alias("word_id"), "word", "n"), "words")
    near = staged(neighbours(words), "near-words")
    known = words.join(near, "word_id", "left")
    formed = F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False))
    known = staged(known.select("word_id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                F.when(formed, F.col("best_id")).alias("form_id"), F.when(formed, F.col("best_n")).alias("form_n")), "forms")
    changed = known.where("form_id IS NOT NULL")
    ends = changed.join(roots(changed), "word_id")
    form, last = (words.select(F.col("word_id").alias(f"_{c}_id"), F.col("word").alias(c)) for c in ("form", "root"))
    ends = ends.join(form, F.col("form_id") == F.col("_form_id")).join(last, F.col("root_id") == F.col("_root_id"))
    plain = known.where("form_id IS NULL").withColumn("form", F.lit(None).cast("string")).withColumn("root", F.col("word"))
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    return ends.select(columns).unionByName(plain.select(columns))


def marked_words(docs: DataFrame, every: int = 199, min_length: int = MIN_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (word) per run of letters of the whole texts, A-Z lower-cased; some runs lose a letter.

    With h the unsigned crc32 of `<id>:<run>`, a run for which `every` divides h loses the code point
    at h % length. Words of fewer than `min_length` code points are left out. A null text has no runs;
    in a row without an id no run loses a letter.
    """
    runs = docs.select(F.col(id_col).cast("string").alias("_id"), F.explode(F.regexp_extract_all(
        ascii_lower(F.col(text_col)), F.lit(RUN), F.lit(0))).alias("run")).where(F.length("run") >= min_length)
    hashed = runs.select("run", F.crc32(F.concat("_id", F.lit(":"), "run")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= min_length)


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants among the words of all documents."""
    words = marked_words(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)
    return spelling_variants(counts)


SQL = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(0, 256), lambda b: list_reduce(list_prepend(b, range(0, 8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS run
  FROM documents),
d AS (SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
u AS (
  SELECT doc_id, run, times, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR) || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195::BIGINT, CAST(unicode(c) - 64 AS BIGINT)] END)) AS bytes
  FROM d),
h AS (
  SELECT doc_id, run, times, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, bytes),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM u, crc),
m AS (
  SELECT times, CASE WHEN h % 199 = 0 THEN run[:CAST(h % length(run) AS INT)] || run[CAST(h % length(run) AS INT) + 2:] ELSE run END AS word
  FROM h),
w AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM m WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
s AS (SELECT word, n, i, word[:i] AS head, word[i + 2:] AS tail FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM w)),
near AS (
  SELECT a.word AS a, b.word AS b, b.n AS n FROM s a JOIN s b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM s JOIN w ON s.head || s.tail = w.word
  UNION SELECT w.word, s.word, s.n FROM s JOIN w ON s.head || s.tail = w.word),
k AS (SELECT a, count(*) AS n_near, max(n) AS best_n FROM near GROUP BY a),
best AS (SELECT near.a, min(near.b) AS b, k.best_n FROM near JOIN k ON near.a = k.a AND near.n = k.best_n GROUP BY near.a, k.best_n),
f AS (
  SELECT w.word, w.n, coalesce(k.n_near, 0) AS n_near, CASE WHEN best.best_n >= 5 * w.n THEN best.b END AS form,
         CASE WHEN best.best_n >= 5 * w.n THEN best.best_n END AS form_n
  FROM w LEFT JOIN k ON k.a = w.word LEFT JOIN best ON best.a = w.word),
walk AS (
  SELECT word, word AS at, form AS next FROM f
  UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON f.word = walk.next)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n FROM f JOIN walk ON walk.word = f.word AND walk.next IS NULL
"""

QUERIES = {"op11_spelling_groups": (op11_spelling_groups, SQL)}
