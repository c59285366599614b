"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import random

import numpy as np
import pytest

from cinderlake.llm import bpe, exact_dedup, license_scan, line_dedup, metric_join, minmax_dedup, packing, secret_scan, token_counts, toxicity
from cinderlake.llm.components import components

public_tokenizers = pytest.importorskip("public_tokenizers")
PIECE, WORD, BYTE = (public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.json"))
LONG = "line of words that goes on and on\n" * 20_000 + "unsplit" * 20_000
# Names that the operators use themselves.
SCHEMA = "doc_id long, text string, rep long, lines string, score string, n long, component_id long, kept string, rank long, length long"


@pytest.fixture(scope="module")
def docs(spark):
    texts = [(1, None), (2, ""), (3, "one two three four five six"), (3, "one two three four five six"), (4, LONG), (5, LONG), (None, "one two three four five six"), (6, " \t\n ")]
    return spark.createDataFrame([(i, t, *[None] * 8) for i, t in texts], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


OPERATORS = {
    "tokens": lambda d: token_counts.token_counts(d, PIECE),
    "near": minmax_dedup.near_duplicates,
    "license": license_scan.license_notices,
    "lines": line_dedup.drop_repeated_lines,
    "round_trip": lambda d: bpe.round_trips(d, WORD),
    "exact": exact_dedup.exact_groups,
    "pack": lambda d: packing.pack(d, BYTE),
    "secrets": lambda d: secret_scan.scan(d, secret_scan.train(d)),
    "toxicity": lambda d: toxicity.add_scores(d, toxicity.Chain()),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(empty, name):
    assert OPERATORS[name](empty).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_is_answered(docs, name):
    rows = OPERATORS[name](docs).collect()
    if name == "pack":
        rows = [r for r in rows if r["piece"] == 0]
    assert sorted(str(r["doc_id"]) for r in rows) == ["1", "2", "3", "3", "4", "5", "6", "None"]


def test_token_counts(docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    found = by_id(token_counts.token_counts(docs, PIECE))
    assert (found[1]["n_tokens"], found[1]["n_bytes"], found[2]["n_tokens"]) == (0, 0, 0)
    assert found[4]["n_tokens"] == len(library.encode(LONG)) and found[4]["over_limit"]


def test_transducer_on_odd_texts_and_chunks():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    machine, rng = token_counts.Transducer(PIECE), random.Random(5)
    parts = ["a", "e", "st", "▁", " ", "  ", "\n", "é", "ß", "中", "😀", "\t", "0", "the", "ing", ".", "<s>", "ā", "\x00", "A"]
    for k in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        text = text.replace(" ", "") if k % 3 == 0 else text
        assert {machine.tokens(text, c) for c in (1 << 16, 5, 16)} == {len(library.encode(text))}, repr(text)


def test_transducer_forgets_and_stays_right(monkeypatch):
    import sentencepiece

    monkeypatch.setattr(token_counts, "MAX_STATES", 5)
    text = "internationalisation of the tokenizers and nothing else"
    assert token_counts.Transducer(PIECE).tokens(text) == len(sentencepiece.SentencePieceProcessor(model_file=PIECE).encode(text))


def test_tree_concatenation_of_odd_texts():
    from tokenizers import Tokenizer

    library, encoder, rng = Tokenizer.from_file(WORD), bpe.WordEncoder(WORD, leaf=8), random.Random(4)
    parts = ["a", "b", "e", "T", "'s", " ", "\n", "é", "ß", "中", "😀", "0", "ing", ".", "<|endoftext|>", "ﬁ", "Σ", "İ", "\x1c", "\x85", "ation"]
    for k in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        text = "".join(rng.choice("abeinst") for _ in range(rng.randint(0, 300))) if k % 4 == 0 else text
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text) == ids, repr(text)
        assert encoder.round_trip(text) == (len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))


def test_round_trip_of_a_long_unsplit_text(docs):
    import hashlib

    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(WORD).encode(LONG, add_special_tokens=False).ids
    found = by_id(bpe.round_trips(docs, WORD))
    assert (found[4]["n_tokens"], found[4]["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert found[1]["ids_sha256"] == found[2]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()


def test_byte_encoder_on_odd_texts():
    import struct

    from tokenizers import Tokenizer

    library, encoder, rng = Tokenizer.from_file(BYTE), packing.ByteEncoder(BYTE), random.Random(3)
    parts = ["a", "e", "T", "'s", " ", "  ", "\n", " \n", "é", "中", "😀", "\t", "0", " the", ".", "<|endoftext|>", "ā", "\x00", " ", "\x1c", "\x85", " -", "don't"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text) == struct.pack(f"<{len(ids)}I", *ids), repr(text)


def test_plans_use_every_item_and_few_sequences():
    rng = random.Random(8)
    for _ in range(60):
        sizes = {rng.randint(1, 30): rng.randint(1, 9) for _ in range(rng.randint(1, 12))}
        steps, used = packing.plan(sizes, 30), {}
        for pattern, times in steps:
            assert sum(s * c for s, c in pattern) <= 30
            for s, c in pattern:
                used[s] = used.get(s, 0) + c * times
        assert used == sizes
    assert sum(t for _, t in packing.plan({6: 4, 5: 4, 4: 4}, 15)) == 4
    assert packing.plan({}, 15) == []


def test_best_filling_wastes_least():
    rng = random.Random(9)
    for _ in range(200):
        sizes = sorted({rng.randint(1, 20) for _ in range(rng.randint(1, 6))}, reverse=True)
        counts, rest = [rng.randint(1, 3) for _ in sizes], rng.randint(1, 40)
        sums = {0}
        for s, n in zip(sizes, counts, strict=True):
            sums = {t + s * k for t in sums for k in range(n + 1) if t + s * k <= rest}
        filling = packing.best_filling(sizes, counts, rest)
        assert sum(sizes[k] * c for k, c in filling) == max(sums)
        assert all(c <= counts[k] for k, c in filling)


def test_line_dedup(spark):
    line = "A line of more than forty characters, held by many documents"
    rows = [(i, f"{line if i % 2 else '  ' + line.upper()}\nown line {i}\nshort") for i in range(6)] + [(7, line), (8, None), (9, ""), (None, line)]
    found = {r["doc_id"]: r["lines"] for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), batches=3).collect()}
    for i in range(6):
        assert (found[i]["n_lines"], found[i]["n_dropped"], found[i]["kept_text"]) == (3, 1, f"own line {i}\nshort")
    assert (found[7]["n_dropped"], found[7]["kept_text"]) == (0, line)
    assert [tuple(found[i]) for i in (8, 9)] == [(1, 0, "")] * 2
    assert found[None]["kept_text"] == line


def test_line_runs_compact(spark):
    runs = line_dedup.LineRuns(spark, fan_in=2)
    for batch in range(4, 0, -1):
        runs.add(spark.createDataFrame([(1, 1, 10 * batch), (batch, 0, 10 * batch)], "h1 long, h2 long, doc_id long"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    assert [tuple(r) for r in runs.frequent(4).collect()] == [(1, 1, 40)]


def test_exact_groups(docs):
    found = exact_dedup.exact_groups(docs).collect()
    size = {r["doc_id"]: (r["group_size"], r["keep_id"], r["kept"]) for r in found}
    assert size[1] == (2, 2, False) and size[2] == (2, 2, True)
    assert size[3] == (3, 3, True) and size[None] == (3, 3, False)
    assert size[4] == (2, 5, False)


def test_exact_groups_do_not_depend_on_the_sketch(spark):
    rows = [(i, f"text {i % 7 if i < 300 else i}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    few, many = (sorted(map(tuple, exact_dedup.exact_groups(df, counters=c).collect())) for c in (8, 1024))
    assert few == many


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(2)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(rng.randint(3, 120))] for _ in range(12)]
    texts = [None, "", "solo", "solo"]
    for words in base:
        for _ in range(8):
            copy = list(words)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = f"x{rng.random()}"
            texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    for words, percent in ((3, 85), (5, 80)):
        sets = []
        for t in texts:
            w = (t or "").lower().split()
            sets.append({tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
        label = list(range(len(texts)))
        for i in range(len(texts)):
            for j in range(i):
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    a, b = sorted((label[i], label[j]))
                    label = [a if c == b else c for c in label]
        found = by_id(minmax_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words, percent))
        assert [(found[i]["n_shingles"], found[i]["component_id"], found[i]["kept"]) for i in found] == [(len(sets[i]), label[i], label[i] == i) for i in found]


def test_blocks_of_a_bucket_meet_every_pair_once(spark, monkeypatch):
    monkeypatch.setattr(minmax_dedup, "BLOCK", 3)
    rows = [(0, 0, 10, i, 100, i, [7], bytes(128)) for i in range(10)]
    members = spark.createDataFrame(rows, "band int, key long, m long, rep long, n long, comp long, bands array<long>, sketch binary")
    met = {}
    for r in minmax_dedup.candidates(members, 80).collect():
        met.setdefault((r["low"], r["high"]), ([], []))[r["side"]].append(r["rep"])
    pairs = [tuple(sorted(p)) for (low, high), (x, y) in met.items() for p in ([(a, b) for a in x for b in x if a < b] if low == high else [(a, b) for a in x for b in y])]
    assert sorted(pairs) == [(i, j) for i in range(10) for j in range(i + 1, 10)]


def test_pairs_of_an_earlier_band_and_of_one_component_are_left_out(spark):
    rows = [(1, 5, 3, 1, 100, 1, [4, 5], bytes(128)), (1, 5, 3, 2, 100, 2, [4, 5], bytes(128)), (1, 5, 3, 3, 100, 2, [9, 5], bytes(128))]
    members = spark.createDataFrame(rows, "band int, key long, m long, rep long, n long, comp long, bands array<long>, sketch binary")
    assert sorted(r["rep"] for r in minmax_dedup.candidates(members, 80).collect()) == [1, 3]


def test_links_that_stars_miss_are_found(spark):
    """Chains of copies, each two words on from the last, whose ends are far apart."""
    rng = random.Random(7)
    rows, label = [], {}
    for chain in range(5):
        words = [f"c{chain}w{k}" for k in range(150)]
        ids = []
        for _ in range(14):
            rows.append((rng.randrange(10**9), " ".join(words)))
            ids.append(rows[-1][0])
            for _ in range(2):
                words[rng.randrange(150)] = f"n{rng.random()}"
        label |= {i: min(ids) for i in ids}
    found = by_id(minmax_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85))
    assert {i: r["component_id"] for i, r in found.items()} == label


@pytest.mark.parametrize("cell,block", [(2_000, 4_096), (7, 5)])
def test_metric_join_against_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(metric_join, "CELL", cell)
    monkeypatch.setattr(metric_join, "BLOCK", block)
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(12, 8))
    rows = [(i, (centers[i % 12] + rng.normal(size=8) * 0.25).tolist(), i % 3) for i in range(150)]
    rows += [(200, rows[5][1], rows[5][2]), (201, rows[5][1], None), (202, None, 1), (203, [0.0] * 8, 1), (204, [float("nan")] * 8, 1), (205, [1.0, None], 1), (206, [1.0], 1), (207, [2.0], 1), (208, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "0L AS rep", "0L AS n", "'x' AS kept")
    good = {i: (np.float32(v).astype(float), label) for i, v, label in rows if label is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    links = {i: [j for j, (w, m) in good.items() if j != i and m == label and len(w) == len(v) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93] for i, (v, label) in good.items()}
    found = {r["vec_id"]: r for r in metric_join.metric_join(df).collect()}
    assert found.keys() == {r[0] for r in rows}
    for i, r in found.items():
        reach, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        assert (r["n_links"], r["component_id"], r["kept"]) == (len(links.get(i, [])), min(reach), min(reach) == i)
    assert metric_join.metric_join(df.limit(0)).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(k, 300) for k in range(200, 230)] + [(7, 7), (500, 500)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)} | {k: 200 for k in [*range(200, 230), 300]}


def test_automata():
    automaton = license_scan.Automaton("x", "<<licensed|released>> under [[the]] [[terms of <<any|this>>]] great license <<*2>> version 2 [[0]]")
    accepted = ["licensed under the great license version 2", "released under terms of this great license of us version 2 0", "licensed under great license a version 2"]
    refused = ["licensed under a great license version 2", "licensed under the great license one two three version 2", "licensed under the terms of great license version 2", "licensed under the great license version"]
    for text, wanted in [(t, True) for t in accepted] + [(t, False) for t in refused]:
        words = text.encode().split()
        assert ((0, len(words)) in automaton.places(words)) == wanted, text
    n, base, found = license_scan.notices("Licensed under the Apache License, Version 2.0.\nCC-BY-NC 4.0 GNU general PUBLIC license, version 3")
    assert n == 19 and sorted(base) == [("apache", 3), ("cc-by", 8), ("gpl", 13)] and [f[0] for f in found] == ["apache-2.0", "gpl-3.0", "cc-by-nc"]
    with pytest.raises(ValueError):
        license_scan.Automaton("x", "[[open only")


def test_secrets():
    counts = {}
    rng = random.Random(1)
    for _ in range(300):
        token = "".join(rng.choice("abcdef0123456789") for _ in range(30))
        for a, b in zip("^" + token, token, strict=False):
            counts[1, a, b] = counts.get((1, a, b), 0) + 1
    for word in "internationalisation documentation configuration_value application-settings mathematics".split() * 60:
        for a, b in zip("^" + word, word, strict=False):
            counts[0, a, b] = counts.get((0, a, b), 0) + 1
    model = secret_scan.MarkovRatio(counts)
    text = 'é PASSWORD="hunter2xyz" token: short AKIAABCDEFGHIJKL now ghp_k2Jf93kLmQz81XxYbN02plQa and internationalisation_documentation'
    spans = secret_scan.all_spans(text, model, 20.0)
    assert [(secret_scan.KINDS[k], text[s:e]) for s, k, e in spans] == [
        ("assign", 'PASSWORD="hunter2xyz'), ("access", "AKIAABCDEFGHIJKL"), ("markov", "ghp_k2Jf93kLmQz81XxYbN02plQa")]
    assert "hunter2" not in secret_scan.redacted(text, spans, "*") and secret_scan.redacted(text, spans, "*").count("*") == 3
    assert secret_scan.all_spans("paſſword=12345678", model, 20.0) == []


def test_redact_keeps_nulls_and_columns(docs):
    out = secret_scan.redact(docs, secret_scan.MarkovRatio({}))
    assert out.columns == docs.columns and by_id(out)[1]["text"] is None


def test_chain_marginals_against_brute_force():
    chain = toxicity.Chain({"bad": 4.0, "wor*": 2.5}, -2.0, np.array([[0.0, -1.0], [-0.5, 0.7]]))
    chain.prepare()
    words = "a fine day bad words here and a bad worm bad end of it".split()
    emit = [np.array([1.0, np.exp(chain.bias + sum(chain.weights.get(f, 0) for f in toxicity.features(w)))]) for w in words]
    move = np.exp(chain.moves)
    forward, a = [], np.array([1.0, 0.0])
    for e in emit:
        a = (a @ move) * e
        forward.append(a)
    b, exact = np.ones(2), [0.0] * len(words)
    for t in range(len(words) - 1, -1, -1):
        exact[t] = forward[t][1] * b[1] / (forward[t] @ b)
        b = move @ (emit[t] * b)
    found = chain.marginals(words)
    assert [i for i, _ in found] == [i for i, w in enumerate(words) if any(f in chain.weights for f in toxicity.features(w))]
    assert all(abs(p - exact[i]) < 1e-9 for i, p in found)


def test_toxicity_learns_and_holds_out(spark):
    import zlib

    rng = random.Random(4)
    plain = [f"word{k}" for k in range(60)]
    rows, labels = [], []
    for i in range(400):
        toxic = int(i % 5 == 0)
        words = [rng.choice(plain) for _ in range(40)]
        if toxic:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(["Awful,", "horrid!", "vileness", "vilely"])
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    rows += [(900, None), (901, "")]
    labels += [(900, None), (None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chain = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {r["doc_id"]: r for r in toxicity.add_scores(docs, chain).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum((found[i]["score"] >= 0.3) == (i % 5 == 0) for i in held)
    assert right >= 0.97 * len(held)
    assert found[900]["score"] == found[901]["score"] < 0.3
    text = dict(rows)[0]
    assert {text[s["start"]:s["end"]] for s in found[0]["toxic_spans"]} <= {"Awful,", "horrid!", "vileness", "vilely"}
    assert toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int")).weights == {}
