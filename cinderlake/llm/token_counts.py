"""Token counts by a compiled finite-state transducer.

A subword model whose merges are ranked is a deterministic transducer over characters. What the
future of a text can still ask about its past is short: for every place where a piece could still be
in progress, the piece that ends there and how many tokens there were by then. That tuple is the
state; a character leads to the next state and changes the token count of the text so far, so each
transition carries the number of tokens it emits (it can be negative, when a character lets earlier
tokens merge). States are compiled when a text first reaches them and are shared by all texts.

Of two adjacent characters that no piece holds side by side, the second begins anew: the transducer
is back at its start. A space after another character always is such a cut when no piece has an
inner space, which is checked. So the state map of a chunk of text is constant behind its first cut:
it is kept as (head, emitted, tail), where head is what stands before the first cut and tail what
stands behind the last one. Maps compose associatively by running the transducer over tail + head
only, and a tree of compositions, the reduction of a parallel prefix scan, gives the whole text.
Stretches between cuts recur, so their composed transitions are memoised.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake.llm.tables import Memo, table, table_rows

SPACE = "▁"
# A worker forgets what it has compiled beyond this number and compiles again what is needed.
MAX_STATES = 150_000
CHUNK = 1 << 16


class _State(dict):
    """Transitions: character -> (next state, tokens emitted). `open` lists the places where a piece may be in progress.

    An item of `open` is (characters since the place, the token that ends there, tokens by then less tokens now).
    """

    __slots__ = ("machine", "open")

    def __init__(self, machine: Transducer, at: tuple):
        super().__init__()
        self.machine, self.open = machine, at

    def __missing__(self, char: str) -> tuple[_State, int]:
        step = self[char] = self.machine.compile(self.open, char)
        return step


class _Irregular(Exception):
    """A stretch that does not begin with exactly one space."""


class Transducer:
    """The compiled counter of one sentencepiece BPE model with byte fallback."""

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as file:
            model.ParseFromString(file.read())
        norm, trained = model.normalizer_spec, model.trainer_spec
        if trained.model_type != trained.BPE or not trained.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("only BPE models with byte fallback that leave texts as they are")
        if not norm.escape_whitespaces or not norm.add_dummy_prefix or trained.treat_whitespace_as_suffix:
            raise ValueError("only models that put an escaped space before a text")
        normal = {p.piece: p.score for p in model.pieces if p.type == p.NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in normal) or any(p.type in (p.USER_DEFINED, p.UNUSED) for p in model.pieces):
            raise ValueError("only models whose pieces have no inner space and no pieces of the user's own")
        self.score = normal
        self.prefixes = {p[:k] for p in normal for k in range(1, len(p))}
        self.side_by_side = {p[k:k + 2] for p in normal for k in range(len(p) - 1)}
        self.stretches = Memo(self._stretch)
        self._forget()

    def _stretch(self, word: str) -> int:
        """Tokens of a stretch behind a single space."""
        if not word or SPACE in word:
            raise _Irregular
        return self.run(SPACE + word)

    def _forget(self) -> None:
        self.states: dict[tuple, _State] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        self.start = self._state((("", None, 0),))

    def _state(self, at: tuple) -> _State:
        state = self.states.get(at)
        if state is None:
            state = self.states[at] = _State(self, at)
        return state

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text: best score first, leftmost among equals."""
        parts = list(text)
        while len(parts) > 1:
            best = max(((self.score[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.score), default=None)
            if best is None:
                break
            k = -best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _follows(self, last: str | None, token: str) -> bool:
        """Whether `token` is a token, and stays one beside `last`."""
        if token not in self.whole:
            self.whole[token] = self.merge(token) == [token]
        if not self.whole[token] or last is None:
            return self.whole[token]
        pair = (last, token)
        if pair not in self.pairs:
            self.pairs[pair] = self.merge(last + token) == [last, token]
        return self.pairs[pair]

    def compile(self, at: tuple, char: str) -> tuple[_State, int]:
        """The transition from the state that `at` describes."""
        if len(self.states) >= MAX_STATES:
            self._forget()
        if char not in self.score:
            return self.start, len(char.encode())
        last = at[-1][1]
        if last is not None and last[-1] + char not in self.side_by_side:
            at = self.start.open
        token, before = next((s + char, n) for s, l, n in at if s + char in self.score and self._follows(l, s + char))
        emitted = before + 1
        later = tuple((s + char, l, n - emitted) for s, l, n in at if s + char in self.prefixes)
        return self._state((*later, ("", token, 0))), emitted

    def run(self, escaped: str) -> int:
        """Tokens of an escaped text, from the start state."""
        state, count = self.start, 0
        for char in escaped:
            state, emitted = state[char]
            count += emitted
        return count

    def count(self, escaped: str) -> int:
        """Tokens of text behind a cut (or a text's begin), cut again wherever that is sound."""
        words = escaped.replace(SPACE, " ").split(" ")
        try:
            if words[0]:
                raise _Irregular
            return sum(map(self.stretches.__getitem__, words[1:])) if escaped else 0
        except _Irregular:
            return self.run(escaped.replace(" ", SPACE))

    def chunk_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(head, tokens between, tail) of a chunk; a chunk without a cut is all head."""
        first = next((i for i in range(1, len(chunk)) if chunk[i] == " " and chunk[i - 1] != " "), None)
        if first is None:
            return chunk, None, ""
        end = len(chunk)
        while True:
            last = chunk.rfind(" ", 0, end)
            if chunk[last - 1] != " ":
                break
            end = last
        return chunk[:first], self.count(chunk[first:last]), chunk[last:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of a's chunk followed by b's."""
        if a[1] is None and b[1] is None:
            return a[0] + b[0], None, ""
        if a[1] is None:
            return a[0] + b[0], b[1], b[2]
        if b[1] is None:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + self.count(a[2] + b[0]) + b[1], b[2]

    def tokens(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        if len(text) <= chunk:
            return self.count(" " + text)
        text = " " + text.replace(SPACE, " ")
        maps = [self.chunk_map(text[i:i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        head, between, tail = maps[0]
        return self.count(head) + (0 if between is None else between + self.count(tail))


_MACHINES: dict[str, Transducer] = {}


def machine(model_path: str) -> Transducer:
    """This worker's transducer of a model, compiled once for all its tasks."""
    if model_path not in _MACHINES:
        _MACHINES[model_path] = Transducer(model_path)
    return _MACHINES[model_path]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the sentencepiece library without begin and end tokens. A null text counts as
    empty and has no tokens; ids may be null or repeated; an empty table gives an empty result; other
    columns are not read. `model_path` must exist on every node. A text is counted in one task, chunk
    by chunk, in time that grows with its length; memory is bounded by the constants above and the text.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = machine(model_path)
        for batch in batches:
            rows = [(i, n, counter.tokens(t)) for i, t, n in table_rows([batch], "doc_id", "text", "n_bytes")]
            ids, sizes, tokens = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return picked.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents under the 32k piece model."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op1_token_counts": (op1_token_counts, None)}
