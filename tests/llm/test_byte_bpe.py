"""Operator 13 against the library that reads the same rank files."""

import base64
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskspark.llm.byte_bpe import ByteBpe, PairTable, byte_bpe, decode_bpe, encode_bpe, round_trip

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = P.path("byte_bpe_multi_50k.tiktoken")


def library(bpe):
    found = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    return lambda text: np.array(found.encode_ordinary(text), "<u4").tobytes()


OWN = byte_bpe(PATH, P.PATTERN)
WANT = library(OWN)
TEXTS = ["", " ", "\n\n \t", "a", "don't DON'T it's", "x" * 30_000, "ab" * 20_000, "日本語" * 3000, "é" * 999, " " * 5000, "-" * 5000 + "=" * 17, "<|endoftext|>", "\x00\x1f\x85 ﻿", "👩‍👩‍👧‍👦🇩🇪", "1234567890" * 400]


def test_odd_texts():
    got = OWN.encode(TEXTS)
    assert got == [WANT(t) for t in TEXTS]
    assert [OWN.decode(x) for x in got] == [t.encode() for t in TEXTS]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60), max_size=5))
def test_any_texts(texts):
    got = OWN.encode(texts)
    assert got == [WANT(t) for t in texts] and [OWN.decode(x) for x in got] == [t.encode() for t in texts]


def test_long_random_pieces():
    r = random.Random(3)
    texts = ["".join(r.choice(letters) for _ in range(n)) for letters in ("ab", "etaoin", "abcdefghijklmnopqrstuvwxyz", "äöü日本") for n in (17, 300, 20_000)]
    assert OWN.encode(texts) == [WANT(t) for t in texts]


@pytest.mark.parametrize("seed", range(12))
def test_vocabularies_whose_merges_make_pairs_of_lower_rank(tmp_path, seed):
    """Ranks in random order: a merge often opens a pair that comes before the one just merged."""
    r = random.Random(seed)
    tokens = {bytes([i]) for i in range(256)} | {"".join(r.choice("ab") for _ in range(r.randint(2, 6))).encode() for _ in range(40)}
    order = sorted(tokens)
    r.shuffle(order)
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(order)))
    own = ByteBpe(str(path), P.PATTERN)
    texts = ["".join(r.choice("ab") for _ in range(r.randint(1, 40))) for _ in range(300)] + ["".join(r.choice("ab") for _ in range(3000)), "a" * 999]
    want = library(own)
    assert own.encode(texts) == [want(t) for t in texts]


def test_pair_table_finds_its_pairs_and_no_other():
    rng = np.random.default_rng(0)
    pairs = np.unique(rng.integers(0, 300, (5000, 2)), axis=0)
    table = PairTable(pairs[:, 0], pairs[:, 1], np.arange(len(pairs)))
    assert table.ranks(pairs[:, 0], pairs[:, 1]).tolist() == list(range(len(pairs)))
    known = set(map(tuple, pairs.tolist()))
    other = np.array([p for p in rng.integers(-1, 400, (5000, 2)).tolist() if tuple(p) not in known])
    assert (table.ranks(other[:, 0], other[:, 1]) == np.iinfo(np.int32).max).all()
    assert PairTable(*np.zeros((3, 0), np.int64)).ranks(np.array([1]), np.array([2])).tolist() == [np.iinfo(np.int32).max]


def test_cache_of_few_pieces():
    own = ByteBpe(PATH, P.PATTERN)
    own.most = 3
    texts = [f"some words {i} and others, quelques mots {i % 7}" for i in range(50)]
    assert [own.encode([t])[0] for t in texts * 2] == [WANT(t) for t in texts * 2]


def test_rows(spark, odd, empty):
    got = sorted(map(tuple, round_trip(odd.repartition(3), PATH, P.PATTERN).collect()))
    hashed = lambda x: hashlib.sha256(x).hexdigest()
    rows = [(r["doc_id"], r["text"] or "") for r in odd.select("doc_id", "text").collect()]
    assert got == sorted((i, len(WANT(t)) // 4, hashed(WANT(t)), hashed(t.encode())) for i, t in rows)
    assert round_trip(empty, PATH, P.PATTERN).count() == 0
    nulls = spark.createDataFrame([(None, None), (1, None)], "doc_id long, text string")
    assert round_trip(nulls, PATH, P.PATTERN).filter("n_tokens = 0").count() == 2


def test_encoded_and_decoded_columns(spark):
    docs = spark.createDataFrame([("k", "two words", 1)], "key string, text string, ids int")
    both = decode_bpe(encode_bpe(docs, PATH, P.PATTERN, "key"), PATH, P.PATTERN, "key").first()
    assert (both["key"], bytes(both["ids"]), bytes(both["decoded"])) == ("k", WANT("two words"), b"two words")
