"""The models against slow, direct computations."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import language, quality_classifier, quality_rules


def direct_code_length(train, text, seen):
    """PPM, method C with exclusion, from the definition."""
    order = language.ORDER
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    for t in train:
        d = b" " * order + t
        for i in range(order, len(d)):
            for k in range(order + 1):
                counts[k][d[i - k : i]][d[i]] += 1

    def predictions(context):
        lower = predictions(context[1:]) if context else [1 / 256] * 256
        own = counts[len(context)].get(context)
        if not own or len(context) and sum(own.values()) < seen:
            return lower
        n, q, left = sum(own.values()), len(own), sum(lower[b] for b in range(256) if b not in own)
        return [own[b] / (n + q) if b in own else q / (n + q) * lower[b] / left for b in range(256)]

    d = b" " * order + text
    return sum(-math.log2(predictions(d[i - order : i])[d[i]]) for i in range(order, len(d)))


@pytest.mark.parametrize("seen", [1, 2, 3])
def test_code_lengths_from_the_definition(seen):
    r = random.Random(seen)
    draw = lambda letters, n: bytes(r.choice(letters) for _ in range(n))
    train = {"x": [draw(b"abc d\xc3\xa9", 70) for _ in range(5)], "y": [draw(b"efg d", 50) for _ in range(4)]}
    trees = language.build_trees({k: language.gram_counts(v) for k, v in train.items()}, seen)
    texts = [draw(b"abczefg d\xc3\xa9", 40) for _ in range(5)] + [b"", b"q"]
    got = trees.code_lengths(texts)
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx([direct_code_length(train[k], text, seen) for k in trees.languages])


def test_chunks_do_not_change_code_lengths(monkeypatch):
    trees = language.build_trees({"x": language.gram_counts([b"abracadabra hocus pocus"])}, 1)
    texts = [b"abra cadabra", b"", b"hocus" * 20, b"z"]
    want = trees.code_lengths(texts)
    for chunk in (1, 5, 17):
        monkeypatch.setattr(language, "CHUNK", chunk)
        assert np.allclose(trees.code_lengths(texts), want)


def test_many_languages_stay_small(spark):
    r = np.random.default_rng(1)
    counts = {}
    for k in range(100):
        words = ["".join(chr(0x100 * (k % 20) + 0x61 + c) for c in r.integers(0, 26, r.integers(2, 8))) for _ in range(300)]
        counts[f"l{k}"] = language.gram_counts([language.folded(" ".join(r.choice(words, 400)))])
    trees = language.build_trees(counts)
    size = sum(a.nbytes for t in trees.trees for part in (t.grams, t.gram_bits, t.contexts, t.escape_bits) for a in part)
    assert size < 40e6


def test_quadratic_discriminant_from_the_definition(spark):
    """Means, covariances and log densities by hand, from all rows at once."""
    rng = np.random.default_rng(5)
    d = len(quality_classifier.FEATURES)
    x = rng.normal(size=(200, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d)
    y = (rng.random(200) < 0.4).astype(int)
    x[y == 1] += 0.7
    df = spark.createDataFrame([(*map(float, v), int(k)) for v, k in zip(x, y, strict=True)], ", ".join([*(f"{f} double" for f in quality_classifier.FEATURES), "label int"]))
    model = quality_classifier.fit(df, F.col("label"), to_pooled=0.6, to_identity=0.02)
    z = (x - x.mean(0)) / x.std(0)
    covs = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    pooled = sum(c * (y == k).sum() for k, c in enumerate(covs)) / len(y)
    logs = []
    for k in (0, 1):
        c = 0.4 * covs[k] + 0.6 * pooled
        c = 0.98 * c + 0.02 * np.trace(c) / d * np.eye(d)
        away = z - z[y == k].mean(0)
        logs.append(np.log((y == k).mean()) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ni,ij,nj->n", away, np.linalg.inv(c), away))
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-6)


@pytest.mark.parametrize("share", [0.8, 0.25])
def test_posteriors_by_bayes_and_mostly_bad_tables(spark, share):
    """Bayes by hand on the fitted tables; the good class stays the good one in a table of mostly bad rows."""
    rng = np.random.default_rng(3)
    good = rng.random(4000) < share
    votes = np.column_stack([np.where(rng.random(4000) < a, good, ~good) for a in (0.95, 0.9, 0.85, 0.9)]).astype(int)
    votes[rng.random(votes.shape) < 0.2] = quality_rules.ABSTAIN
    patterns = Counter(map(tuple, votes.tolist()))
    prior, table = quality_rules.fit_votes(list(patterns.items()))
    assert abs(prior - share) < 0.06
    right = [quality_rules.posterior(tuple(v), prior, table) >= 0.5 for v in votes.tolist()]
    assert np.mean(np.array(right) == good) > 0.9
    names = [f"v{i}" for i in range(4)]
    df = spark.createDataFrame(list(patterns), ", ".join(f"{n} int" for n in names))
    for *vote, p in df.select(*names, quality_rules.posterior_column(prior, table, names).alias("p")).collect():
        odds = [q * math.prod(table[r][k][v] for r, v in enumerate(vote)) for k, q in ((0, 1 - prior), (1, prior))]
        assert p == pytest.approx(odds[1] / sum(odds)) == pytest.approx(quality_rules.posterior(tuple(vote), prior, table))
