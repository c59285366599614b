"""License notices: fixed phrases, and templates with optional and replaceable regions as token automata.

A template is compiled once into an automaton over words: its states are places in the wording; a
mandatory word leads to one next place, an optional region may be stepped over, a replaceable region
takes one of its listed wordings or up to a number of any words. A notice is accepted where all
mandatory words match exactly. All states that can be reached are kept as one set, so a text is read
once from each place where a template can begin, without backtracking.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake.llm.tables import table, table_rows

# Fixed phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Markup: [[optional]], <<one|of several wordings>>, <<*n>> for up to n words of any kind.
GRANT = "<<licensed|released|distributed|available|published|provided|used>> under [[the]] [[terms of]] [[the]]"
TEMPLATES = [
    ("apache-2.0", GRANT + " apache license [[version]] 2 0"),
    ("mit-notice", GRANT + " mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this <<*8>> and associated documentation files"),
    ("gpl-2.0", "gnu general public license <<*12>> version 2 [[0]] [[only]]"),
    ("gpl-3.0", "gnu general public license <<*12>> version 3 [[0]] [[only]]"),
    ("lgpl", GRANT + " gnu <<lesser|library>> general public license [[version <<2|2 1|3>>]]"),
    ("agpl", GRANT + " gnu affero general public license [[version 3]]"),
    ("cc-by-nc", "cc by nc [[<<sa|nd>>]] [[<<1|2|3|4>> <<0|5>>]]"),
    ("cc-by-sa", "cc by sa [[<<1|2|3|4>> <<0|5>>]]"),
    ("cc-by-nd", "cc by nd [[<<1|2|3|4>> <<0|5>>]]"),
    ("cc-by-4.0", "cc by 4 0"),
    ("cc-by-text", "creative commons attribution [[<<noncommercial|sharealike|noderivatives>>]] <<*3>> [[international]] license"),
    ("cc0", "<<cc0|creative commons zero>> [[v]] [[1 0]] [[universal]]"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-notice", GRANT + " <<bsd|2 clause bsd|3 clause bsd|bsd 2 clause|bsd 3 clause>> license"),
    ("mpl-2.0", GRANT + " mozilla public license [[v|version]] 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

# Upper case to lower case, everything else that belongs to no word to a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


class Automaton:
    """Words of one template. `edges[state]` has (word, next), with None for any word; `skips[state]` the free moves."""

    def __init__(self, label: str, markup: str):
        self.label = label
        self.edges: list[list[tuple[bytes | None, int]]] = [[]]
        self.skips: list[list[int]] = [[]]
        self.needed: list[bytes] = []
        parts = re.findall(r"\[\[|\]\]|<<[^>]*>>|[^\s\[\]<>]+", markup)
        end, depth, opened = 0, 0, []
        for part in parts:
            if part == "[[":
                opened.append(end)
                depth += 1
            elif part == "]]":
                self.skips[opened.pop()].append(end)
                depth -= 1
            elif part.startswith("<<*"):
                last = self._new()
                for _ in range(int(part[3:-2])):
                    self.skips[end].append(last)
                    end = self._word(end, None)
                self.skips[end].append(last)
                end = last
            elif part.startswith("<<"):
                last = self._new()
                for wording in part[2:-2].split("|"):
                    at = end
                    for word in wording.split():
                        at = self._word(at, word.encode())
                    self.skips[at].append(last)
                end = last
            else:
                end = self._word(end, part.encode())
                if not depth:
                    self.needed.append(part.encode())
        if opened:
            raise ValueError(f"an optional region isn't closed: {markup}")
        self.end = end
        self.start = self._free({0})
        self.first = {word for state in self.start for word, _ in self.edges[state]}
        if None in self.first or self.end in self.start:
            raise ValueError(f"a template must begin with a word: {markup}")
        self.needed.sort(key=len, reverse=True)

    def _new(self) -> int:
        self.edges.append([])
        self.skips.append([])
        return len(self.edges) - 1

    def _word(self, at: int, word: bytes | None) -> int:
        to = self._new()
        self.edges[at].append((word, to))
        return to

    def _free(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for to in self.skips[todo.pop()]:
                if to not in states:
                    states.add(to)
                    todo.append(to)
        return states

    def match(self, words: list[bytes], at: int) -> int | None:
        """The end of the longest wording that is accepted from `at`, or None."""
        states, found = self.start, None
        while at < len(words) and states:
            word = words[at]
            states = self._free({to for s in states for w, to in self.edges[s] if w is None or w == word})
            at += 1
            if self.end in states:
                found = at
        return found

    def places(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(start, end) of accepted wordings, leftmost and not overlapping."""
        free = 0
        for at, word in enumerate(words):
            if at >= free and word in self.first and (end := self.match(words, at)):
                yield at, end
                free = end


AUTOMATA = [Automaton(label, markup) for label, markup in TEMPLATES]
_HINTS = (b"licen", b"cc", b"commons", b"permi", b"redistribution", b"public")


def notices(text: str, automata: list[Automaton] = AUTOMATA) -> tuple[int, list[tuple[str, int]], list[tuple[str, int, int]]]:
    """(number of words, [(label, start)] of the phrases, [(label, start, end)] of the templates), in words from 0."""
    data = text.encode("utf-8", "replace").translate(_WORDS)
    words = data.split()
    if automata is AUTOMATA and not any(h in data for h in _HINTS):
        return len(words), [], []
    joined = b" " + b" ".join(words) + b" "
    base = []
    for phrase, label in PHRASES.items():
        sought = f" {phrase} ".encode()
        at = joined.find(sought)
        while at >= 0:
            base.append((label, joined.count(b" ", 0, at)))
            at = joined.find(sought, at + 1)
    found = [(a.label, s, e) for a in automata if all(b" " + w + b" " in joined for w in a.needed) for s, e in a.places(words)]
    return len(words), base, found


SCANNED = "doc_id long, n_words long, base array<struct<label:string,start:long>>, notices array<struct<label:string,start:long,end:long>>"


def license_notices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, base places and accepted notices.

    A null or empty text has no words and no notices; ids may be null or repeated; an empty table
    gives an empty result; other columns are not read. Whole texts are read, however long.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = pa.struct([("label", pa.string()), ("start", pa.int64())])
        notice = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            ids, sizes, bases, found = [], [], [], []
            for doc_id, text in table_rows([batch], "doc_id", "text"):
                n, base, accepted = notices(text)
                ids.append(doc_id)
                sizes.append(n)
                bases.append([{"label": a, "start": s} for a, s in base])
                found.append([{"label": a, "start": s, "end": e} for a, s, e in accepted])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(bases, pa.list_(place)), pa.array(found, pa.list_(notice))],
                ["doc_id", "n_words", "base", "notices"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return picked.mapInArrow(find, SCANNED)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of all documents.

    The score is 1 for a whole notice, 0.5 for a phrase alone, else 0.
    """
    found = license_notices(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"), F.array_max("base.start").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base.label", "notices.label")), ",").alias("labels"),
        F.when(F.size("notices") > 0, 1.0).when(F.size("base") > 0, 0.5).otherwise(0.0).alias("score"))


QUERIES = {"op4_license_scan": (op4_license_scan, None)}
