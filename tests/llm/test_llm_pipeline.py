"""The pipeline on a small corpus with planted cases, stage by stage against brute force, and as a whole."""

import random
import re

import pytest

import corpus_pipeline

public_tokenizers = pytest.importorskip("public_tokenizers")

SHARED = "This very line of more than forty characters stands in many documents"
SECRET = "password=9f8e7d6c5b4a39281706"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """(folder, rows): toxic documents, shared lines, near copies, secrets, null and empty texts."""
    rng = random.Random(12)
    vocabulary = [f"word{k}" for k in range(300)]
    rows, labels = [], []

    def add(text, toxic=None):
        rows.append((len(rows), text, "en", "s", None if text is None else len(text)))
        if toxic is not None:
            labels.append((len(rows) - 1, 1, toxic))

    for _ in range(160):
        words = [rng.choice(vocabulary) for _ in range(60)]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(["horrid", "vile"])
        add(" ".join(words), toxic)
    for k in range(8):
        add(" ".join(rng.choice(vocabulary) for _ in range(50)) + ("\n" + (SHARED if k % 2 else f"  {SHARED.upper()} ")))
    base = [rng.choice(vocabulary) for _ in range(120)]
    for _ in range(6):
        copy = list(base)
        copy[rng.randrange(120)] = "changed"
        add(" ".join(copy))
    add("a clean text and then " + SECRET + " in the middle of it")
    add(None)
    add("")
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, dict((i, y) for i, _, y in labels)


@pytest.fixture(scope="module")
def stages(spark, corpus, tmp_path_factory):
    """The documents behind each stage, as lists of rows."""
    folder, _, _ = corpus
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "secrets", "packing"]
    for rows in stages[:-1]:
        assert list(rows[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxic_documents_go_and_clean_ones_stay(corpus, stages):
    _, rows, labels = corpus
    kept = texts(stages[0])
    assert kept == {i: t for i, t, *_ in rows if not re.search("horrid|vile", t or "")}
    assert not any(labels.get(i) for i in kept)


def test_lines(stages):
    before, after = texts(stages[0]), texts(stages[1])
    holders = [i for i, t in before.items() if SHARED.lower() in (t or "").lower()]
    for i, t in before.items():
        lost = i in holders and i != max(holders)
        assert after[i] == ("\n".join(t.split("\n")[:-1]) if lost else t)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in stages[1])


def test_near_duplicates(stages):
    before, after = texts(stages[1]), texts(stages[2])
    sets = {}
    for i, t in before.items():
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    gone = {j for j in sets for i in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert gone and after == {i: t for i, t in before.items() if i not in gone}


def test_secrets(stages):
    before, after = texts(stages[2]), texts(stages[3])
    assert after == {i: t and t.replace(SECRET, "[secret]") for i, t in before.items()}


def test_packing(stages):
    from test_llm_tables import check_packing
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check_packing(stages[4], {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t in texts(stages[3]).items()}, 2048)


def test_run_applies_all_stages(spark, corpus, stages):
    found = corpus_pipeline.run(spark, corpus[0]).select("doc_id", "piece", "length", "ids_crc32").collect()
    assert sorted(map(tuple, found)) == sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in stages[4])


def test_without_documents_and_labels(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
