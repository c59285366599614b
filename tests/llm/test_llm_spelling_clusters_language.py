"""Spelling variants, centroid clusters and languages: SQL, brute force, held-out accuracy and edges."""

import os
import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as driver
import oracle
from cinderlake.llm import centroids, language, spelling

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
supplied = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables not present")
CLASH = "word_id long, score string, lang_pred string, cluster string, n_near long"


@supplied
@pytest.mark.parametrize("name", ["op11_spelling_groups", "op12_centroid_clusters"])
def test_against_sql(spark, name):
    equal, message = oracle.compare(driver.queries()[name](spark, SF_DIR), oracle.duck(SF_DIR), driver.oracle_sql()[name])
    assert equal, message


# --- spelling ---------------------------------------------------------------------------------

def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_variants_against_all_pairs(spark):
    rng = random.Random(2)
    words = {"".join(rng.choice("aabcé😀") for _ in range(rng.randint(0, 6))): rng.randint(0, 400) for _ in range(400)}
    words |= {"x" * 3000: 9, "x" * 3001: 90, "x" * 1500 + "y" + "x" * 1499: 1}
    frame = spark.createDataFrame([(w, n, *[None] * 5) for w, n in words.items()] + [(None, 7, *[None] * 5)], f"word string, n long, {CLASH}")
    found = {r["word"]: r for r in spelling.spelling_variants(frame).collect()}
    assert found.keys() == words.keys()
    form = {}
    for w, n in words.items():
        mine = [v for v in words if near(w, v)]
        best = min(mine, key=lambda v: (-words[v], v.encode()), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
        r = found[w]
        assert (r["n"], r["n_near"], r["form"], r["form_n"]) == (n, len(mine), form[w], words[form[w]] if form[w] is not None else None), w
    for w in words:
        end, steps = w, 0
        while form[end] is not None and steps < 500:
            end, steps = form[end], steps + 1
        assert steps == 500 or found[w]["root"] == end


def test_variants_of_nothing_and_of_repeated_words(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0
    rows = spelling.spelling_variants(spark.createDataFrame([("cats", 2), ("cats", 3), ("cat", 30), ("bat", None)], "word string, n long")).collect()
    assert sorted(map(tuple, rows)) == [("bat", "cat", "cat", 0, 1, 30), ("cat", None, "cat", 30, 2, None), ("cats", "cat", "cat", 5, 1, 30)]


def test_marked_words(spark):
    texts = [(i, f"Überlänge-{'abcdef' * (i % 5 + 1)} short ÀÉÎõü÷×") for i in range(400)] + [(None, "nothing is cut herein"), (3, None), (4, ""), (5, "z" * 50_000)]
    found = sorted(r["word"] for r in spelling.marked_words(spark.createDataFrame(texts, "doc_id long, text string")).collect())
    want = []
    for i, t in texts:
        runs = __import__("re").findall("[A-Za-zÀ-ÿ]+", t or "")
        for run in runs:
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                want.append(run)
    assert found == sorted(want)


# --- clusters ---------------------------------------------------------------------------------

def test_hilbert_neighbours_touch():
    cells = np.array(np.meshgrid(*[np.arange(8)] * 3, indexing="ij")).reshape(3, -1).T
    keys = centroids.hilbert_keys(cells, 3)
    assert len(set(keys)) == len(cells)
    walk = cells[np.argsort(np.array([int.from_bytes(k, "big") for k in keys]))]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_boxes_never_hide_the_nearest():
    rng = np.random.default_rng(1)
    for spread in (2, 20, 2**26):
        middle = rng.integers(-spread, spread, (40, 6))
        rows = rng.integers(-spread // 4, spread // 2, (50, 6))
        found, _ = centroids.assigned(rows, rows.min(0), rows.max(0), middle)
        assert (found == ((rows[:, None, :].astype(object) - middle) ** 2).sum(2).astype(np.int64).argmin(1)).all()


def test_clusters_against_brute_force(spark):
    import hashlib

    rng = random.Random(6)
    heaps = [[rng.uniform(-2, 2) for _ in range(4)] for _ in range(5)]
    vectors = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(heaps)]) for i in range(300)]
    vectors += [(500 + i, vectors[0][1]) for i in range(150)] + [(None, vectors[1][1]), (900, [1e30, -1e30, 0.0, 0.0]), (7, vectors[2][1])]
    odd = [(901, None), (902, [1.0, None, 0.0, 0.0]), (903, [float("nan")] * 4), (904, [float("inf")] * 4), (905, [1.0]), (906, [])]
    frame = spark.createDataFrame([(i, v, *[None] * 5) for i, v in vectors + odd], f"vec_id long, embedding array<double>, {CLASH}").repartition(3)
    whole = [(i, [max(-2**27, min(2**27, int(256 * x // 1))) for x in v]) for i, v in vectors]
    first = sorted(((hashlib.sha256(f"2:{i}".encode()).hexdigest(), np.array(v, "<i4").tobytes(), v) for i, v in whole if i is not None))
    middle = [v for *_, v in first[:6]]
    for step in range(4):
        at = [min(range(6), key=lambda c: (sum((a - b) ** 2 for a, b in zip(v, middle[c])), c)) for _, v in whole]
        if step < 3:
            for c in range(6):
                mine = [v for (_, v), k in zip(whole, at) if k == c]
                middle[c] = [sum(x) // len(mine) for x in zip(*mine)] if mine else middle[c]
    want = sorted(((i is None, i or 0, k, sum((a - b) ** 2 for a, b in zip(v, middle[k]))) for (i, v), k in zip(whole, at)))
    rows = centroids.clusters(frame, k=6, rounds=3, dims=4, block=16).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["cluster"], r["distance"]) for r in rows) == want
    for r in rows:
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, middle[r["cluster"]])).encode()).hexdigest()
        assert r["inertia"] == min(sum(w[3] for w in want), 2**63 - 1)
        assert r["cluster_inertia"] == min(sum(w[3] for w in want if w[2] == r["cluster"]), 2**63 - 1)


def test_clusters_of_nothing(spark):
    assert centroids.clusters(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 0


# --- languages --------------------------------------------------------------------------------

@supplied
def test_held_out_languages(spark):
    con = oracle.duck(SF_DIR)
    truth = {i: (lang, t) for i, lang, t in con.execute("SELECT doc_id, lang, text FROM documents").fetchall()}
    rows = {r["doc_id"]: r for r in driver.queries()["op13_language_id"](spark, SF_DIR).collect()}
    assert rows.keys() == truth.keys()
    right = [rows[i]["lang_pred"] == lang for i, (lang, t) in truth.items() if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(right) >= 0.97 * len(right)
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in truth[i][1] or ""))


def test_codes_correct_errors():
    for n in (2, 3, 4, 7, 8, 20, 60):
        code = language.codewords(n)
        apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert apart >= {2: 1, 3: 2}.get(n, code.shape[1] // 4) and (abs(code.sum(0)) < n).all()
    assert language.codewords(1).shape == (1, 0)
    model = language.Model([str(k) for k in range(20)])
    for k in range(20):
        margins = model.code[k].copy()
        margins[:5] *= -1
        assert model.predict(margins[None])[0][0] == str(k)


def test_counts_of_long_texts_are_those_of_one_chunk(monkeypatch):
    text = "Ein langer Text, über Dächer und Bäume; " * 300
    whole = next(language.counted(iter([(text,)])))[1][0]
    monkeypatch.setattr(language, "CHUNK", 61)
    assert (next(language.counted(iter([(text,)])))[1][0] == whole).all()
    data = language.letters_of(text)
    assert whole.sum() == sum(len(data) - k for k in range(language.LENGTHS))


def test_languages_of_odd_rows(spark):
    known = [(1, "the cat sat on the mat and the dog", "en"), (2, "le chat est dans la maison et le chien", "fr"), (3, "12 34", "en"), (4, None, "de"), (None, "weg", "de"), (5, "der", None)]
    rows = [(*r, *[None] * 5) for r in known * 3] + [(9, "", None, *[None] * 5), (10, "é" * 300_000, None, *[None] * 5), (11, "¿ 12 ½ ²", None, *[None] * 5)]
    frame = spark.createDataFrame(rows, f"doc_id long, text string, lang string, {CLASH}")
    model = language.train(frame)
    assert model.languages == ["en", "fr"]
    found = language.add_languages(frame, model)
    assert found.count() == len(rows) and found.columns.count("score") == 1
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert [by_id[i]["lang_pred"] for i in (1, 2, 3, 4, 9, 11)] == ["en", "fr", "und", "und", "und", "und"]
    assert by_id[10]["lang_pred"] in ("en", "fr")
    assert language.add_languages(frame.limit(0), model).count() == 0
    nothing = language.train(frame.where("lang = 'xx'"))
    assert {r["lang_pred"] for r in language.add_languages(frame, nothing).collect()} == {"und"}
    alone = language.train(frame.where("lang = 'fr'"))
    assert {r["lang_pred"] for r in language.add_languages(frame, alone).collect()} == {"und", "fr"}
