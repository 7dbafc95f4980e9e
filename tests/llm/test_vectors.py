"""Operators 11 and 12 against comparing every vector with every entry."""

import hashlib
import random

import numpy as np
import pytest

from riskspark.llm.centroids import CentroidTree, cluster_vectors
from riskspark.llm.integer_vectors import Sums, squared
from riskspark.llm.vector_codes import CellMemo, compress_vectors


def brute(points, others):
    d = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, o, strict=True)) for o in others] for p in points]
    return [min(range(len(row)), key=lambda i: (row[i], i)) for row in d], [min(row) for row in d]


@pytest.mark.parametrize("cell", [1, 7, 32, 1000])
@pytest.mark.parametrize("spread", [2, 50, 2000])
def test_memo_finds_the_nearest_entry_with_ties(cell, spread):
    rng = np.random.default_rng(spread + cell)
    entries, points = rng.integers(-spread, spread, (37, 4)), rng.integers(-spread, spread, (300, 4))
    entries[5] = entries[20]
    points[:40], points[40:80] = entries[0], entries[20]
    memo = CellMemo(entries, cell, most=50)  # generations change while it is used
    for i in range(0, 300, 60):
        index, distance = memo.nearest(points[i : i + 60])
        assert (index.tolist(), distance.tolist()) == brute(points[i : i + 60], entries)
    assert len(memo.known) + len(memo.old) <= 50 + 120


def test_memo_is_asked_again_and_compares_less_than_all():
    rng = np.random.default_rng(1)
    entries = rng.integers(-500, 500, (256, 4))
    memo = CellMemo(entries, 32)
    points = rng.integers(-500, 500, (50, 4)).repeat(100, axis=0)
    memo.nearest(points)
    memo.nearest(points)
    assert memo.made <= 50 and memo.asked == 10_000 and memo.compared < 0.2 * 10_000 * 256


@pytest.mark.parametrize("leaf", [1, 3, 100])
@pytest.mark.parametrize("spread", [1, 4, 300, 2**24])
def test_tree_finds_the_nearest_centroid_with_ties(leaf, spread):
    rng = np.random.default_rng(spread)
    centroids, points = rng.integers(-spread, spread + 1, (40, 6)), rng.integers(-spread, spread + 1, (200, 6))
    centroids[30] = centroids[3]
    points[:20] = centroids[3]
    points[20:40] = (centroids[1] + centroids[2]) // 2
    number, distance = CentroidTree(centroids, leaf).nearest(points)
    assert (number.tolist(), distance.tolist()) == brute(points, centroids)


def test_tree_prunes_where_centroids_lie_apart():
    rng = np.random.default_rng(0)
    centroids = rng.integers(-100_000, 100_000, (500, 3))
    tree = CentroidTree(centroids)
    points = centroids[rng.integers(0, 500, 400)] + rng.integers(-50, 50, (400, 3))
    assert tree.nearest(points)[0].tolist() == brute(points, centroids)[0]
    assert tree.visits < 0.2 * 400 * len(tree.members)


def test_equal_centroids_and_one_centroid():
    same = np.zeros((9, 2), np.int64)
    assert CentroidTree(same, 1).nearest(np.array([[0, 0], [5, 5]]))[0].tolist() == [0, 0]
    assert CentroidTree(same[:1]).nearest(np.array([[3, 4]]))[1].tolist() == [25]


def test_distances_are_exact_or_an_error():
    big = 2**29
    assert squared(np.array([[big, -big]]), np.array([[-big, big]])).tolist() == [[2 * (2 * big) ** 2]]
    with pytest.raises(OverflowError):
        squared(np.array([[2**40]]), np.array([[0]]))
    assert squared(np.zeros((0, 2), np.int64), np.zeros((3, 2), np.int64)).shape == (0, 3)


def test_sums_by_group():
    sums = Sums(4, 2)
    sums.add(np.array([3, 1, 3]), np.array([[1, 2], [3, 4], [5, 6]]))
    sums.add(np.array([], np.int64), np.zeros((0, 2), np.int64))
    assert sums.batch().to_pydict() == {"grp": [1, 3], "n": [1, 2], "sums": [[3, 4], [6, 8]]}


NAN, INF = float("nan"), float("inf")


def odd_rows(n=60, dims=8):
    """Vectors with ties, copies, a hot label, null ids and labels, and unusable ones."""
    r = random.Random(5)
    rows = [(i, [r.choice([-0.5, -0.25, 0.0, 0.3, 0.7]) for _ in range(dims)], 1 if i % 3 else i % 7) for i in range(n)]
    rows += [(3, rows[3][1], 1), (4, [9.0] * dims, None), (None, rows[5][1], None), (n, rows[6][1], None)]
    rows += [(n + 1, None, 1), (n + 2, [None] * dims, 1), (n + 3, [NAN] + [0.0] * (dims - 1), 1), (n + 4, [INF] * dims, 1), (n + 5, [-INF] * dims, 1), (n + 6, [], 1), (n + 7, [0.5] * (dims - 1), 1), (-1, [1.0] * (dims + 1), 2)]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.selectExpr("*", *[f"7 AS {c}" for c in ("ints", "grp", "n", "sums", "code", "error", "of", "rows", "cluster", "distance", "label_error", "inertia", "vector")])


def kept(rows, scale, dims):
    ok = [r for r in rows if r[1] is not None and len(r[1]) == dims and all(x is not None and np.isfinite(x) for x in r[1])]
    return [(i, np.floor(np.array(v, np.float32).astype(float) * scale).astype(int).tolist(), label) for i, v, label in ok]


def means(groups, vectors, books):
    for g in set(groups):
        own = [v for x, v in zip(groups, vectors, strict=True) if x == g]
        books[g] = [sum(c) // len(own) for c in zip(*own, strict=True)]


@pytest.mark.parametrize("entries", [3, 16, 256])
def test_codes_agree_with_brute_force(spark, entries):
    rows = odd_rows()
    have = kept(rows, 1024, 8)
    order = sorted(have, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    parts = [[v[2 * p : 2 * p + 2] for _, v, _ in have] for p in range(4)]
    books = [[v[2 * p : 2 * p + 2] for _, v, _ in order[:entries]] for p in range(4)]
    for _ in range(4):
        for p in range(4):
            means(brute(parts[p], books[p])[0], parts[p], books[p])
    last = [brute(parts[p], books[p]) for p in range(4)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    error = [sum(last[p][1][i] for p in range(4)) for i in range(len(have))]
    of = {}
    for (_, _, label), e in zip(have, error, strict=True):
        of[label] = of.get(label, 0) + e
    want = [(i, "".join(f"{last[p][0][k]:02x}" for p in range(4)), error[k], of[label], digest) for k, (i, _, label) in enumerate(have)]
    got = compress_vectors(frame(spark, rows).repartition(5), dims=8, entries=entries)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("k", [1, 5, 500])
def test_clusters_agree_with_brute_force(spark, k):
    rows = odd_rows()
    have = kept(rows, 256, 8)
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    points = [v for _, v, _ in have]
    centroids = [list(v) for _, v, _ in sorted(have, key=key)[:k]]
    for _ in range(5):
        means(brute(points, centroids)[0], points, centroids)
    number, distance = brute(points, centroids)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    own = [sum(d for m, d in zip(number, distance, strict=True) if m == c) for c in range(len(centroids))]
    want = [(i, n, d, own[n], sum(distance), digest[n]) for (i, _, _), n, d in zip(have, number, distance, strict=True)]
    got = cluster_vectors(frame(spark, rows).repartition(5), k=k, dims=8)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_vectors_of_an_empty_table_and_of_unusable_ones(spark):
    for rows in ([], odd_rows()[-8:]):
        df = frame(spark, rows)
        assert compress_vectors(df, dims=8).count() == 0 and cluster_vectors(df, dims=8).count() == 0


def test_copies_of_one_vector(spark):
    df = frame(spark, [(7, [0.5] * 8, None)] * 3000)
    got = compress_vectors(df, dims=8).distinct().collect()
    assert len(got) == 1 and (got[0]["code"], got[0]["error"], got[0]["label_error"]) == ("00000000", 0, 0)
    assert [r["cluster"] for r in cluster_vectors(df, dims=8).distinct().collect()] == [0]
