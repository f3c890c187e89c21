"""Byte-level BPE against the library of the vocabulary file."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallywright.llm import bpe
from tallywright.llm.bpe import Codec, Vocabulary, decode_ids, encode_texts
from tallywright.llm.queries import QUERIES

FILE = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(FILE)


def some_texts():
    draw = random.Random(5)
    letters = [*map(chr, range(32, 127)), *"éüßñ漢字日本語  　\u0085\x1c\x1d\t\n\r😀👍🏽ǅʼﬁ՘࢏𞄀", "\U000323b0"]
    made = ["".join(draw.choices(letters, k=draw.randint(0, 80))) for _ in range(1500)]
    made += ["".join(draw.choices("ab ", k=draw.randint(0, 40))) for _ in range(200)]
    return made + [
        "",
        " ",
        "\n\n  x",
        "it's we're I'LL 's",
        "<|endoftext|>",
        "a<|endoftext|><|endoftext|> b<|endof",
        "aaaaaaa" * 60,
        "7" * 5001,
        "漢字仮名" * 500,
        "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=4000)),
    ]


def encoded(codec, texts):
    out = [b""] * len(texts)
    for place, ids in codec.encode(texts):
        out[place] += ids
    return [np.frombuffer(x, "<u4").tolist() for x in out]


@pytest.mark.parametrize(("long_word", "known"), [(256, 300_000), (4, 300_000), (256, 10)])
def test_ids_and_text(plain, long_word, known):
    texts = some_texts()
    codec = Codec(FILE, PATTERN, long_word, known)
    got = encoded(codec, texts)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert got == want
    for ids in got:
        raw = codec.bytes_of(np.array(ids, dtype="<u4").tobytes())
        assert raw.decode("utf-8", "replace") == plain.decode(ids, skip_special_tokens=False)
    assert len(codec.known) <= max(known, 1 + len(set().union(*map(codec.split, texts))))


def test_parts_of_long_texts(plain, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 50)
    texts = [" ".join(some_texts()[:40]), "a  b " * 300, "x" * 500, " " * 400 + "y"]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoded(Codec(FILE, PATTERN), texts) == want


def test_any_ids_decode(plain):
    draw = random.Random(2)
    codec = Codec(FILE, PATTERN)
    for _ in range(300):
        ids = [draw.randrange(50257) for _ in range(draw.randint(0, 12))]
        raw = codec.bytes_of(np.array(ids, dtype="<u4").tobytes())
        assert raw.decode("utf-8", "replace") == plain.decode(ids, skip_special_tokens=False)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_odd_rows(spark, odd_docs, no_docs, plain):
    got = encode_texts(odd_docs, FILE, PATTERN, keep_ids=True, keep_text=True)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    rows = sorted((str(r.doc_id), r.decoded, r.n_tokens, r.ids, r.decoded_sha256) for r in got.collect())
    want = []
    for r in odd_docs.collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids
        text = hashlib.sha256((r.text or "").encode()).hexdigest()
        want.append((str(r.doc_id), r.text or "", len(ids), ids, text))
    assert rows == sorted(want)
    assert encode_texts(no_docs, FILE, PATTERN).count() == 0
    back = decode_ids(got.select("doc_id", "ids", "decoded"), FILE, PATTERN).collect()
    assert sorted(r.decoded for r in back) == sorted(r[1] for r in rows)


def test_stored_ids(spark):
    rows = spark.createDataFrame(
        [(1, [64, None, -1, 99_999], 7), (2, None, 8), (3, [], 9)], "k int, ids array<bigint>, decoded int"
    )
    assert [(r.k, r.decoded) for r in decode_ids(rows, FILE, PATTERN).orderBy("k").collect()] == [
        (1, "a"),
        (2, None),
        (3, ""),
    ]


def test_query(spark, plain):
    got = QUERIES["op13_bpe"](spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        ids = plain.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        decoded = plain.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
