"""Every corpus query on the supplied tables: against SQL where there is some, else against brute force."""

import hashlib
import os
import re
import struct
import zlib

import pytest

import __spark_entry__ as driver
import oracle

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF_DIR)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def result(spark, name):
    return {r["doc_id"]: r for r in driver.queries()[name](spark, SF_DIR).collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", ["op2_embedding_links", "op3_minmax_dedup", "op6_line_dedup", "op8_exact_dedup"])
def test_against_sql(spark, con, name):
    equal, message = oracle.compare(driver.queries()[name](spark, SF_DIR), con, driver.oracle_sql()[name])
    assert equal, message


def test_token_counts(spark, texts):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = result(spark, "op1_token_counts")
    assert found.keys() == texts.keys()
    for i, t in texts.items():
        n = len(library.encode(t))
        assert (found[i]["n_bytes"], found[i]["n_tokens"], found[i]["over_limit"]) == (len(t.encode()), n, n > 4096)


def test_license_scan(spark, texts):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    found = result(spark, "op4_license_scan")
    for i, t in texts.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
        places = sorted((k, label) for p, label in phrases.items() for k in range(len(words)) if words[k:k + len(p.split())] == p.split())
        labels = sorted({label for _, label in places})
        r = found[i]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(words), len(places), ",".join(labels))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert set(labels) <= set(r["labels"].split(",")) if labels else True
        assert 0 <= r["score"] <= 1


def test_toxicity_folds_and_held_out_labels(spark, con, texts):
    found = result(spark, "op5_toxicity")
    assert found.keys() == texts.keys()
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert all(0 <= s["start"] < s["end"] <= len(texts[i]) for s in r["toxic_spans"])


def test_round_trip(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = result(spark, "op7_bpe_round_trip")
    for i, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        r = found[i]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_packing(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = driver.queries()["op9_bin_packing"](spark, SF_DIR).collect()
    check_packing(rows, {i: library.encode(t, add_special_tokens=False).ids + [0] for i, t in texts.items()}, 2048)


def check_packing(rows, documents, capacity, spare=2):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert pieces.keys() == documents.keys()
    for i, ids in documents.items():
        own = sorted(pieces[i], key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(own):
            part = ids[at:at + r["length"]]
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
            assert k == 0 or r["length"] == capacity
            at += r["length"]
        assert at == len(ids) and (len(ids) > capacity or len(own) == 1)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= -(-sum(map(len, documents.values())) // capacity) + spare


def test_secret_scan(spark, texts):
    found = result(spark, "op10_secret_scan")
    for i, t in texts.items():
        spans = [(m.start(), 0, m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 8]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        base = [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans)]
        r = found[i]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == n for _, k, _ in spans) for n in range(3)]
        assert r["base_sha256"] == sha(",".join(base))
        assert set(base) <= set(r["spans"].split(",")) if base else True
