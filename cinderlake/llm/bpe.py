"""BPE encoding and decoding on whole texts; long unsplit stretches by tree concatenation.

A stretch without blanks is looked up in a bounded memo; a stretch seen for the first time is split
by the tokenizer's own rules and its words are encoded by the merges. A word longer than a leaf is
cut in halves, the halves again, down to leaves; leaves are encoded on their own, and halves are
joined from below: the tokens around the join are encoded again as one window, which grows until its
first token is the left side's and its last token the right side's.

That is exact. A row of tokens is the encoding of its text when every two neighbours are the encoding
of theirs: the first merge across a boundary would have happened in the two neighbours' own run too.
Tokens outside the window keep a neighbour they had, and those inside it are an encoding themselves.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake.llm.tables import Memo, table, table_rows

LEAF = 128


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself when printable in Latin-1, else one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def tree_concatenation(word: str, encode: Callable[[str, bool], list[int]], width: Callable[[int], int], leaf: int = LEAF, final: bool = True) -> list[int]:
    """Ids of a word of any length.

    `encode(part, at_end)` gives the ids of a short part that does or doesn't end the word;
    `width(id)` the characters of a token.
    """
    # Parts stand in order; each round joins neighbours, as the levels of a binary tree do.
    halves = max(1, 1 << max(0, (len(word) - 1) // leaf).bit_length())
    edges = sorted({len(word) * k // halves for k in range(halves + 1)})
    parts = [(a, b, encode(word[a:b], final and b == len(word))) for a, b in zip(edges, edges[1:], strict=False)]
    while len(parts) > 1:
        joined = []
        for k in range(0, len(parts) - 1, 2):
            (a, mid, left), (_, b, right) = parts[k], parts[k + 1]
            joined.append((a, b, _join(word, a, mid, b, left, right, encode, width, final and b == len(word))))
        parts = joined + parts[len(parts) - len(parts) % 2:]
    return parts[0][2] if parts else []


def _join(word, a, mid, b, left, right, encode, width, final) -> list[int]:
    span = 2
    while True:
        ours, theirs = left[-span:], right[:span]
        low, high = mid - sum(map(width, ours)), mid + sum(map(width, theirs))
        window = encode(word[low:high], final and high == b)
        if (low == a or window[0] == ours[0]) and (high == b or window[-1] == theirs[-1]):
            return left[:len(left) - len(ours)] + window + right[len(theirs):]
        span *= 2


class WordEncoder:
    """Encoder and decoder of a tokenizer file whose words end in a suffix and whose white space is dropped."""

    def __init__(self, path: str, leaf: int = LEAF):
        from tokenizers import Tokenizer, models

        self.library, self.leaf = Tokenizer.from_file(path), leaf
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        norm = [n["type"] for n in spec["normalizer"]["normalizers"]]
        pre = spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or norm != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None:
            raise ValueError("not a tokenizer of this kind")
        if [p["type"] for p in pre] != ["Split", "ByteLevel"] or pre[0]["behavior"] != "Removed" or not pre[0]["invert"] or pre[1]["use_regex"]:
            raise ValueError("not a tokenizer of this kind")
        self.suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.inner = models.BPE(vocab=vocab, merges=merges)
        self.ending = models.BPE(vocab=vocab, merges=merges, end_of_word_suffix=self.suffix)
        self.token = [""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in vocab.items():
            self.token[i] = token
        for t in spec["added_tokens"]:
            self.token[t["id"]] = t["content"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.is_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        # The split pattern of the file, for printable ASCII; other texts are split by the library.
        self.ascii_words = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ a-z0-9]+")
        self.plain = re.compile("[!-~]*")
        self.memo = Memo(self._seen, 200_000)

    def _short(self, part: str, at_end: bool) -> list[int]:
        return [t.id for t in (self.ending if at_end else self.inner).tokenize(part)]

    def _width(self, token: int) -> int:
        return len(self.token[token].removesuffix(self.suffix))

    def stretch_ids(self, stretch: str) -> list[int]:
        """Ids of text without space or newline."""
        out: list[int] = []
        for k, part in enumerate(self.is_special.split(stretch)):
            if k % 2:
                out.append(self.special[part])
            elif self.plain.fullmatch(part):
                for word in self.ascii_words.findall(part.lower()):
                    out += self._word(word)
            else:
                for word, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part)):
                    out += self._word(word)
        return out

    def _word(self, word: str) -> list[int]:
        return self._short(word, True) if len(word) <= self.leaf else tree_concatenation(word, self._short, self._width, self.leaf)

    def decode(self, ids: list[int]) -> str:
        """Text of ids as the library gives it without a decoder: tokens joined by a space, special ones kept."""
        return " ".join([self.token[i] for i in ids])

    def _seen(self, stretch: str) -> tuple[int, str, str]:
        ids = self.stretch_ids(stretch)
        return len(ids), " ".join(map(str, ids)), self.decode(ids)

    def round_trip(self, text: str) -> tuple[int, str, str]:
        """(number of ids, ids as decimals joined by a space, decoded text) of a whole text."""
        memo, n, ids, words = self.memo, 0, [], []
        for stretch in text.replace("\n", " ").split(" "):
            if stretch:
                k, a, b = memo[stretch]
                if k:
                    n += k
                    ids.append(a)
                    words.append(b)
        return n, " ".join(ids), " ".join(words)

    def ids(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return [i for stretch in text.replace("\n", " ").split(" ") if stretch for i in self.stretch_ids(stretch)]


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """This worker's encoder of a file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def round_trips(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Ids are those of the tokenizers library without special tokens added; strings of special tokens
    in a text become their ids. A null text counts as empty: no ids, and both digests are of the empty
    string. Ids of rows may be null or repeated; an empty table gives an empty result; other columns
    are not read. `path` must exist on every node. A text is handled in one task in time that grows
    with its length.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for doc_id, text in table_rows([batch], "doc_id", "text"):
                n, ids, decoded = encoder.round_trip(text)
                for column, value in zip(out, (doc_id, n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return picked.mapInArrow(encode, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding and decoding of all documents under the 49k word model."""
    import public_tokenizers

    return round_trips(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op7_bpe_round_trip": (op7_bpe_round_trip, None)}
