"""Encoding in parts against the library on whole texts and against merges done by hand."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import regex
from conftest import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tierlake.llm import byte_bpe
from tierlake.llm.byte_bpe import ByteBpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe.of(RANKS, public_tokenizers.PATTERN)


def ranks():
    with open(RANKS, "rb") as f:
        return {base64.b64decode(w): int(r) for w, r in map(bytes.split, f)}


def merged(word: bytes, by: dict) -> list[int]:
    """Merge the adjacent pair of lowest rank until there is none."""
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > 1:
        rank, i = min((by.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if rank == 1 << 60:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [by[p] for p in parts]


ODD = ["", " ", "a", "don't stop  now", "x" + " " * 50 + "y", " " * 50, "\n\n \n", "<|endoftext|>", "中文" * 40, "中文。" * 40,
       "a1b2 c3", "é" * 70, "👩‍👩‍👧 ok", "áb", "1" * 60, "!" * 60 + "s", "a" * 60 + "'s", "\x1c\x1d a", "�", "\x00", "  a" * 30]


def test_against_merges_by_hand(bpe):
    by = ranks()
    for t in ODD:
        want = [i for m in regex.finditer(public_tokenizers.PATTERN, t) for i in merged(m.group().encode(), by)]
        assert bpe.encode(t) == want, t


@pytest.mark.parametrize("size", [1, 3, 16])
def test_parts_equal_whole(bpe, size):
    for t in ODD:
        assert bpe.encode(t, size) == bpe.encoding.encode_ordinary(t), t
        assert "".join(p for p, _ in bpe.parts(t, size)) == t


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=" \n\t 　ab'sé中1²!。👩́\x1f‍", max_size=60), st.integers(1, 8))
def test_parts_equal_whole_on_odd_texts(t, size):
    bpe = ByteBpe.of(RANKS, public_tokenizers.PATTERN)
    ids = bpe.encode(t, size)
    assert ids == bpe.encoding.encode_ordinary(t)
    assert bpe.decode(ids) == t.encode()


def test_runs_beyond_the_pattern_engine(bpe):
    n = 3_000_000
    ids = bpe.encode(" " * n + "x")
    assert ids[:-1] == bpe.encoding._encode_single_piece(" " * (n - 1)) and bpe.decode(ids[-1:]) == b" x"
    for t in ("ab" * 200_000, "中" * 100_000, "x " * 200_000):
        assert bpe.decode(bpe.encode(t)) == t.encode()


def test_table(spark, bpe):
    r = random.Random(3)
    texts = [None, "", "same text", "same text", *ODD, " ".join(r.choice(ODD) for _ in range(20_000))]
    docs = documents(spark, texts).selectExpr("*", "7 AS n_tokens", "lang AS ids_sha256")
    got = byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)
    assert got.columns.count("n_tokens") == 1 and "source" in got.columns
    found = {x.doc_id: x for x in got.collect()}
    assert len(found) == len(texts)
    for i, t in enumerate(texts):
        ids = bpe.encode(t or "")
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert byte_bpe.round_trip(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_encode_then_decode(spark):
    docs = documents(spark, [None, *ODD])
    back = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert {x.doc_id: bytes(x.decoded) for x in back.collect()} == {i: (t or "").encode() for i, t in enumerate([None, *ODD])}


def test_given_documents(spark, medium, bpe):
    got = {x.doc_id: (x.n_tokens, x.ids_sha256) for x in byte_bpe.round_trip(medium, RANKS, public_tokenizers.PATTERN).collect()}
    for x in medium.collect():
        ids = bpe.encoding.encode_ordinary(x.text or "")
        assert got[x.doc_id] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
