import random
import time
from itertools import accumulate, pairwise

import pytest
from pyspark.sql import functions as F

from riskspark.llm import secrets
from riskspark.llm.common import places, running_sums

ORDINARY = [
    "123e4567-e89b-12d3-a456-426614174000", "550E8400-E29B-41D4-A716-446655440000", "2024-01-05T12-30-00Z-2024-02-01", "2023-11-02_2023-11-03_2023-11-04", "/usr/local/lib/python3/site-packages/numpy", "/home/user/documents/report2023/page12/index",
    "release-2024-01-05-build-1234", "version-1-20-300-beta2-rc1", "12345678901234567890123", "4111-1111-1111-1111-1111", "my_variable_name_number_2", "AbstractUserFactoryBean2Impl", "customer_id_0000012345_v2", "============1============",
]
KEYS = ["kQ7zX2vB9nM4tR8wY1pL6sD3", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "ghp_16C7e42F292c6912E7710c838347Ae178B4a", "sk-proj-T3BlbkFJ4kq9Zp2Lx8Wm7Vn", "9f8e7d6c5b4a39281706f5e4", "Zx9Qw7Er5Ty3Ui1O", "AbCdEfGhXzQwVyUtRrPpLlKk"]


def spans_of(spark, texts):
    prose = ["The quick brown fox jumps over the lazy dog, and my_variable_name waits. " * 50] * 10
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *prose])], "doc_id long, text string")
    return {r.doc_id: r.spans for r in secrets.find_secrets(df).collect()}


def test_ordinary_strings_stay_and_keys_are_found(spark):
    out = spans_of(spark, [f"run {x} here" for x in [*ORDINARY, *KEYS]])
    assert [x for i, x in enumerate(ORDINARY) if out[i]] == []
    assert [x for i, x in enumerate(KEYS, len(ORDINARY)) if out[i] != f"markov:4:{4 + len(x)}"] == []


def test_recall_and_false_alarms_by_length(spark):
    r = random.Random(5)
    keys = [[f"run {''.join(r.choice(secrets.ALPHABET[:62]) for _ in range(n))} here" for _ in range(300)] for n in (16, 20, 32)]
    fresh = [f"run {x} here" for x in secrets.labelled_samples(600, seed=99)[1]]
    out = spans_of(spark, [t for own in [*keys, fresh] for t in own])
    shares = [sum("markov" in out[300 * k + i] for i in range(300)) / 300 for k in range(3)]
    assert shares[0] > 0.88 and shares[1] > 0.97 and shares[2] > 0.99
    assert sum("markov" in out[900 + i] for i in range(600)) <= 6


def test_scores_are_those_of_the_models(spark):
    keys, strings = secrets.labelled_samples(300)
    ratios = secrets.log_ratios(secrets.sample_bigrams(keys), secrets.sample_bigrams(strings))
    some = [*keys[:50], *strings[:50], "ab", "é日x"]
    df = spark.createDataFrame([(x,) for x in some], "s string").filter("char_length(s) > 1")
    place = lambda c: secrets.ALPHABET.find(c) % secrets.CLASSES
    for s, score in df.select("s", secrets.markov_score(F.col("s"), ratios)).collect():
        assert score == pytest.approx(sum(ratios[place(a) * secrets.CLASSES + place(b)] for a, b in pairwise(s)) / (len(s) - 1), abs=1e-5)


def test_places_and_long_texts(spark):
    r = random.Random(1)
    rows = [([r.randrange(50) for _ in range(n)],) for n in (0, 1, 15, 16, 17, 300, 1000)]
    for x, y in spark.createDataFrame(rows, "x array<int>").select("x", running_sums(F.col("x"))).collect():
        assert y == list(accumulate(x, initial=0))[:-1]
    text = "é ab ab日 xx ab"
    found = spark.createDataFrame([(text,)], "t string").select(places(F.col("t"), "ab|xx")).first()[0]
    assert [(x.start, x.end, x.found) for x in found] == [(2, 4, "ab"), (5, 7, "ab"), (9, 11, "xx"), (12, 14, "ab")]
    began = time.time()
    run = "".join(r.choice(secrets.ALPHABET[:64]) for _ in range(80_000))
    out = spans_of(spark, [f"x {run} y", "token=abcdefgh " * 8000])
    assert out[0] == "markov:2:80002" and out[1].count(",") == 7999
    assert time.time() - began < 60
