from collections import defaultdict

import pytest

from riskspark.llm import packing
from riskspark.llm.queries import tokenizer_path


@pytest.mark.parametrize("weights", [None, {"s7": 2.0, "s8": 1.0}])
def test_any_number_of_sources_is_packed(spark, monkeypatch, weights):
    monkeypatch.setattr(packing, "MAX_SOURCES", 3)
    monkeypatch.setattr(packing, "SHARED_PARTS", 4)
    rows = [(i, "word " * (1 + i % 13), f"s{i % 20}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4, "doc_id")
    out = packing.pack_mixture(df, tokenizer_path(), weights, sequence_tokens=32, window_sequences=2).collect()
    pieces, sequences, size = defaultdict(int), defaultdict(list), {}
    for r in out:
        pieces[r.doc_id] += r.length
        size[r.doc_id] = r.doc_tokens
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(size) == set(range(200)) and pieces == size
    for k, own in sequences.items():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == 32 or k == max(sequences)
    assert len(sequences) == max(sequences) + 1
