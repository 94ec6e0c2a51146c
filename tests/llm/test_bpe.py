import random
from array import array

import public_tokenizers as P
import pytest
import tiktoken

from fragmill.llm import bpe

RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
POOL = ["a", "aa", "the", " ", "\n", "é", "ß", "日本", "🙂", "x" * 7, "ab", "ba", "  ", "'s", "123", "!!", "--", "=", "ation", "\t", "́", "\x00"]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.parse_ranks(RANKS), P.PATTERN)


@pytest.fixture(scope="module")
def known():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(RANKS), special_tokens={})


def same(codec, known, text):
    packed = codec.encode(text)
    assert list(array("I", packed)) == known.encode_ordinary(text)
    assert codec.decode(packed) == text


def test_random_texts(codec, known):
    rng = random.Random(7)
    for _ in range(800):
        same(codec, known, "".join(rng.choice(POOL) for _ in range(rng.randint(0, 40))))


def test_long_pieces(codec, known):
    rng = random.Random(8)
    for text in ["a" * 9001, " " * 6000, "ab" * 5000, "".join(rng.choice("abc") for _ in range(9000)), "".join(chr(rng.randrange(32, 0xD000)) for _ in range(3000))]:
        same(codec, known, text)


def test_memory_that_fills(codec, known, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 20)
    monkeypatch.setattr(bpe, "MAX_PIECES", 3)
    monkeypatch.setattr(bpe, "MAX_HELD", 5)
    monkeypatch.setattr(bpe, "AT_ONCE", 50)
    rng = random.Random(9)
    small = bpe.Codec(bpe.parse_ranks(RANKS), P.PATTERN)
    for _ in range(60):
        same(small, known, " ".join("".join(rng.choice("etaoinsh") for _ in range(9)) for _ in range(20)))


def test_utf8_machine_is_as_replacing_decoder():
    rng = random.Random(1)
    for _ in range(3000):
        data = bytes(rng.choice([rng.randrange(256), 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x41, 0xED, 0xA0]) for _ in range(rng.randint(0, 12)))
        cut = rng.randint(0, len(data))
        head, state = bpe.Utf8.feed(bpe.Utf8.START, data[:cut])
        tail, state = bpe.Utf8.feed(state, data[cut:])
        assert head + tail + bpe.Utf8.end(state) == data.decode("utf-8", "replace")


def test_frames(spark, sf, known):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = {r.doc_id: known.encode_ordinary(r.text) for r in docs.collect()}
    encoded = bpe.encode(docs, RANKS, P.PATTERN)
    assert {r.doc_id: list(r.tokens) for r in encoded.collect()} == want
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.text for r in bpe.decode(encoded, RANKS, P.PATTERN).collect()} == texts


def test_odd_rows(spark):
    rows = spark.createDataFrame([(None, 1, "x"), ("", 2, "y"), ("é" * 300_000, 2, None), ("a", None, "z")], "text string, doc_id long, packed string")
    got = {(r.doc_id, r.decoded, len(r.packed) // 4 > 0) for r in bpe.round_trip(rows, RANKS, P.PATTERN).collect()}
    assert got == {(1, "", False), (2, "", False), (2, "é" * 300_000, True), (None, "a", True)}
    assert bpe.round_trip(rows.limit(0), RANKS, P.PATTERN).count() == 0
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, tokens array<int>"), RANKS, P.PATTERN).first().text == ""


def test_pieces_that_stand_once_are_not_remembered(known):
    own = bpe.Codec(bpe.parse_ranks(RANKS), P.PATTERN)
    letters = str.maketrans("0123456789", "abcdefghij")
    once, twice = ([f" {a}zq{i:04}".translate(letters) for i in range(3000)] for a in "uv")
    same(own, known, "".join([*once, *twice, *twice]))
    assert set(twice) <= set(own.pieces) and len(set(once) & set(own.pieces)) < 60
