import random

import pytest

from riskspark.llm import decontaminate


@pytest.mark.parametrize("held", [1, 300, 10**9])
def test_benchmark_in_several_parts(spark, monkeypatch, held):
    """A benchmark that isn't held at once gives what one that is does."""
    r = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(r.choices(words, k=r.choice([3, 12, 30])))) for i in range(40)] + [(40, None), (None, "w1 w2"), (41, "")]
    texts = [" ".join(r.choices(words, k=50) + r.choice(items[:40])[1].split() + r.choices(words, k=5) + r.choice(items[:40])[1].split()) for _ in range(30)] + [" ".join(r.choices(words, k=60)) for _ in range(10)] + ["", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = lambda df: sorted((x.doc_id, x.n_words, str(x.hits), str(x.items)) for x in df.collect())
    want = rows(decontaminate.scan_benchmark(docs, benchmark))
    clean = sorted(x.doc_id for x in decontaminate.keep_clean(docs, benchmark).collect())
    monkeypatch.setattr(decontaminate, "HELD_ITEMS", held)
    parts = len(list(decontaminate.scanners(benchmark, 10, 200)))
    assert parts == 1 if held > 10_000 else parts > 10
    assert rows(decontaminate.scan_benchmark(docs, benchmark, block_chars=1200 if held < 1000 else 200)) == want
    assert sorted(x.doc_id for x in decontaminate.keep_clean(docs, benchmark, block_chars=1200 if held < 1000 else 200).collect()) == clean
    assert any(h != "[]" for *_, h, _ in want) and clean != []
