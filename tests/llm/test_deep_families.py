import numpy as np

from riskspark.llm import near_duplicates

from test_text_operators import jaccard_components


def test_pairs_in_a_large_family_below_the_threshold(spark, monkeypatch):
    """Hundreds of texts of one template at about 0.7, and in it pairs just above 0.8."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 64)
    rng = np.random.default_rng(11)
    vocab = [f"w{i}" for i in range(5000)]
    base = list(rng.choice(vocab, 200))

    def changed(words, n):
        own = list(words)
        for at in rng.choice(np.arange(2, len(own) - 4, 5), n, replace=False):
            own[at] = rng.choice(vocab)
        return own

    rows = []
    for i in range(150):
        first = changed(base, 10)
        rows += [(2 * i, " ".join(first)), (2 * i + 1, " ".join(changed(first, 5)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = jaccard_components(rows)
    assert len({c for *_, c in want}) > 100
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(df).collect()}
    assert got == want


def test_branching_ends_where_the_bound_holds():
    level = near_duplicates.deepest_level(80, 12, 8)
    assert (1 - 0.8 ** (level + 1)) ** 12 <= near_duplicates.MISS < (1 - 0.8 ** (level + 2)) ** 12
    used = [x for t in range(12) for x in near_duplicates._paths(t, 12, level)]
    assert len(set(used)) == len(used)


def test_leader_of_many_texts_and_an_id_of_many_texts(spark, monkeypatch):
    """More texts behind one leader than a part takes, and one id that stands at hundreds of texts."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 16)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(300)]

    def near(i):
        own = list(base)
        own[rng.integers(300)] = f"x{i}"
        return " ".join(own)

    rows = [(i, near(i)) for i in range(200)] + [(1000, " ".join(f"y{i}_{j}" for j in range(20))) for i in range(150)] + [(2000, " ".join(f"y7_{j}" for j in range(20))), (3000, "z " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    salts = []
    real = near_duplicates._salted
    monkeypatch.setattr(near_duplicates, "_salted", lambda *a: salts.append(real(*a)) or salts[-1])
    got = {(r.doc_id, r.component_id) for r in near_duplicates.near_duplicates(df).collect()}
    assert got == {(i, 0) for i in range(200)} | {(1000, 1000), (2000, 1000), (3000, 3000)}
    parts = [r["count"] for r in salts[0].filter("a = 0").groupBy("a", "ma", "salt").count().collect()]
    assert sum(parts) >= 199 and max(parts) < 60


def test_family_larger_than_a_leaf(spark):
    """Over 600 texts of one template with default arguments; recall against all pairs."""
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(9000)]
    base = list(rng.choice(vocab, 120))
    rows = []
    for i in range(330):
        own = list(base)
        for at in rng.choice(120, 6, replace=False):
            own[at] = rng.choice(vocab)
        rows.append((2 * i, " ".join(own)))
        own[int(rng.integers(120))] = rng.choice(vocab)
        rows.append((2 * i + 1, " ".join(own)))
    want = {(i, c) for i, _, c in jaccard_components(rows)}
    got = {(r.doc_id, r.component_id) for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got & want) >= 0.99 * len(want) and len({c for _, c in want}) > 50
