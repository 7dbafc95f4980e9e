import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskspark.llm import packing, token_file, tokens
from riskspark.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokenizer_path())


def test_cut_texts_encode_as_whole_ones(encoder):
    r = random.Random(5)
    parts = [" ", " ", " ", "\n", "\t", "a", "b", "The", "é", "ß", "1", "23", "'s", "'", ".", ",", "!", "###", "!'s", "|", "日本", "\xa0", " ", "ª", "œ", "<|endoftext|>", "_", "I", '"', "\x1c", "\r\n"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(4000)]
    assert encoder.encode(texts) == [encoder.whole(x) for x in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=700))
def test_boundaries(lengths):
    ids = np.arange(sum(lengths), dtype="<u4") % 60000
    seg = token_file.Segment(token_file.pack_segment(lengths, ids.tobytes(), 2))
    ends = np.concatenate([[0], np.cumsum(lengths)])
    assert seg.boundaries().tolist() == ends.tolist()
    for i in {0, len(lengths) // 2, len(lengths)}:
        assert seg.select(i) == ends[i]
    assert (seg.document(0) == ids[: lengths[0]]).all()
    bits = 64 * len(seg.high) + 8 * len(seg.packed)
    assert bits <= len(ends) * (3 + np.log2(max(2, (ends[-1] + 1) / len(ends)))) + 128


def truth(encoder, df):
    out = defaultdict(list)
    for r in df.select("doc_id", "text").collect():
        out[r.doc_id].append(np.append(np.frombuffer(encoder.whole(r.text or ""), "<u4"), 0).astype("<u4"))
    return out


def test_token_file(odd, empty, encoder):
    want = truth(encoder, odd)
    segments = token_file.write_token_segments(odd, tokenizer_path(), segment_ids=1000)
    got = sorted(map(tuple, token_file.read_token_segments(segments).select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda x: x[1])
    at, flat = 0, sorted((k, i) for k, v in want.items() for i in range(len(v)))
    assert len(got) == len(flat)
    for (doc_id, start, n, crc), (k, i) in zip(got, flat, strict=True):
        assert (doc_id, start, n, crc) == (k, at, len(want[k][i]), zlib.crc32(want[k][i].tobytes()))
        at += n
    assert token_file.read_token_segments(token_file.write_token_segments(empty, tokenizer_path())).count() == 0


@pytest.mark.parametrize("weights", [None, {"s": 3.0, "": 1.0}, {"s": 1.0}])
def test_packing(odd, empty, encoder, weights):
    want = truth(encoder, odd)
    out = packing.pack_mixture(odd, tokenizer_path(), weights, sequence_tokens=64, window_sequences=4).collect()
    sequences, pieces = defaultdict(list), defaultdict(int)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id] += r.length
        assert any(zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and len(x) == r.doc_tokens for x in want[r.doc_id])
    assert pieces == {k: sum(map(len, v)) for k, v in want.items()}
    for k, own in sequences.items():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == 64 or k == max(sequences)
    assert packing.pack_mixture(empty, tokenizer_path()).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(1, 5000), min_size=1), st.dictionaries(st.sampled_from("abcdef"), st.floats(0.1, 9)))
def test_mixture_carries_deficits(totals, weights):
    m = packing.Mixture(totals, weights or None)
    share = m.weights / m.weights.sum()
    last = np.zeros(len(totals), int)
    for position in range(0, m.total + 1, 97):
        here = m.before(position)
        assert here.sum() == min(position, m.total) and (here >= last).all() and (here <= m.totals).all()
        if (here < m.totals).all():  # no queue is dry: each is within a token of its target
            assert (abs(here - share * position) <= len(totals)).all()
        last = here
    for s in range(len(totals)):
        for token in (0, int(m.totals[s]) - 1):
            k = m.window_of(s, token, 97)
            assert m.before(k * 97)[s] <= token < m.before((k + 1) * 97)[s]
