"""BPE encoding and decoding against the tokenizers library."""

from __future__ import annotations

import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskframe.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocab():
    return bpe.Vocabulary(PATH)


def texts():
    rng = random.Random(3)
    signs = ["a", "e", "th", "ing", " ", "  ", "\n", "\t", "\r\n", "'s", "'ll", "'", "é", "ß", "ñ", "中文", "日本", "ع", "क्", "1", "23", "²", "½", "Ⅷ", "٣", "!", "...", "_", "-", "€",
             " ", " ", "\u0085", "\x1c", "\x00", "​", "🙂", "👩‍🚀", "͸", "՘", "Ᲊ", "Ƛ", "\U000105c0", "\U0001ccf0", "\U0010ffff", "<|endoftext|>", "<|", "endoftext", "|>"]
    made = ["".join(rng.choice(signs) for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    words = ["".join(rng.choice("etaoinshrdlucmfwypvbgkqjxz") for _ in range(rng.randrange(1, 30))) for _ in range(200)]
    return [*made, *(" ".join(rng.choices(words, k=40)) for _ in range(40)), "", " ", "\n\n\n", "the the the", "a" * 5000, "é" * 3000, "ab" * 40_000, " " * 4000 + "x", "=" * 700,
            "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|> \n<|endoftext|>", "x" * 64, "x" * 65, "The  quick\n\n  brown fox's 12345 jumps!?  "]


def as_rows(df, encoder):
    got = bpe.decode_documents(bpe.encode_documents(df, encoder), encoder)
    return {r["doc_id"]: (np.frombuffer(r["ids"], "<u4").tolist(), r["n_tokens"], r["decoded"]) for r in got.collect()}


@pytest.mark.parametrize("max_words", [0, 1, 60, 100_000])
def test_equals_the_library(spark, library, max_words):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    got = as_rows(df, bpe.fit_encoder(df, PATH, max_words=max_words))
    for i, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[i] == (ids, len(ids), library.decode(ids, skip_special_tokens=False)), text[:80]


def test_small_slices(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 50)
    test_equals_the_library(spark, library, 60)


def test_table(spark, library):
    from riskframe.llm.queries import op11_bpe

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in op11_bpe(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    import hashlib

    for r in docs:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        own = got[r["doc_id"]]
        assert own["n_tokens"] == len(ids) and own["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert own["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_merging_beside_others_and_alone(vocab, library):
    rng = random.Random(6)
    words = ["".join(rng.choice(["a", "aa", "th", "er", "in", "é", "x", "0", "\t"]) for _ in range(rng.randrange(1, 25))).encode()[:64] for _ in range(500)]
    size = np.array([len(w) for w in words])
    ids, n = bpe.merged(vocab, np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, size)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [bpe.merge_long(vocab, w) for w in words]


def test_transducer_is_minimal_and_numbers_words():
    rng = random.Random(7)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 8))) for _ in range(300)})
    parts = bpe.transducer(words)
    futures = {frozenset(w[len(p):] for w in words if w.startswith(p)) for p in {w[:k] for w in words for k in range(len(w) + 1)}}
    assert len(parts["final"]) == len(futures)
    tried = words + [w + b"a" for w in words] + [w[:-1] for w in words] + [b"", b"zz", b"a" * 100]
    size = np.array([len(w) for w in tried])
    got = bpe.walk(parts, np.frombuffer(b"".join(tried) + b"\0", np.uint8), np.cumsum(size) - size, size)
    assert got.tolist() == [words.index(w) if w in words else -1 for w in tried]
    assert (bpe.walk(bpe.transducer([]), np.zeros(3, np.uint8), np.array([0]), np.array([2])) == -1).all()


def test_defined_cases(spark, library, tmp_path):
    schema = "doc_id bigint, text string, ids string, decoded int, piece string, n int"
    df = spark.createDataFrame([(1, None, "x", 3, "p", 1), (None, "", "y", 4, "q", 2), (3, "one two", None, None, None, None), (3, "one two", None, None, None, None)], schema)
    encoder = bpe.fit_encoder(df, PATH, max_words=10)
    got = bpe.decode_documents(bpe.encode_documents(df, encoder), encoder)
    assert got.columns == ["doc_id", "text", "piece", "n", "ids", "n_tokens", "decoded"]
    assert sorted((r["n_tokens"], r["decoded"]) for r in got.collect()) == [(0, ""), (0, ""), (2, "one two"), (2, "one two")]
    empty = df.limit(0)
    assert as_rows(empty, bpe.fit_encoder(empty, PATH)) == {}
    raw = spark.createDataFrame([(1, bytearray(np.array([101, 4_000_000_000, 220, 50256], "<u4").tobytes())), (2, None)], "doc_id int, ids binary")
    out = {r["doc_id"]: r["decoded"] for r in bpe.decode_documents(raw, encoder).collect()}
    assert out == {1: library.decode([101, 220, 50256], skip_special_tokens=False), 2: ""}
    with open(PATH, encoding="utf-8") as f:
        other = json.load(f) | {"normalizer": {"type": "Lowercase"}}
    (tmp_path / "t.json").write_text(json.dumps(other))
    with pytest.raises(ValueError, match="not a plain"):
        bpe.Vocabulary(str(tmp_path / "t.json"))


def test_classes_are_the_library_s(library, vocab):
    pieces = library.pre_tokenizer.pre_tokenize_str
    split, _ = bpe.Encoder(vocab, None).tools()
    rng = random.Random(9)
    some = [*rng.sample(sorted(vocab.odd), 500), *(c for c in (rng.randrange(0x110000) for _ in range(3000)) if not 0xD800 <= c < 0xE000)]
    for c in map(chr, some):
        text = f"a{c}a {c}1{c}1!{c}! {c} {c}"
        assert split(text) == [text[a:b] for _, (a, b) in pieces(text)], hex(ord(c))
