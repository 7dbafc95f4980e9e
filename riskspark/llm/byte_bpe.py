"""Byte-level BPE by rank files: encoding and decoding of whole texts with matrices of padded pieces.

A text is split by the vocabulary's pattern, and each distinct piece is encoded
once. Unknown pieces are dealt into buckets of similar length; a bucket is a
matrix with a row a piece, padded, next to a matrix of the ranks of neighbouring
pairs. In each round every row merges its leftmost pair of least rank; rows are
then moved together, and rows without a further pair leave the matrix.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, text_of

#: Pieces in each of the two generations of the cache, about 150 bytes each.
CACHE_PIECES = 500_000
#: Cells of a matrix; a longer piece has one of its own.
CELLS = 1_000_000
#: Characters of texts, or bytes of ids, that are worked on at once.
CHARS = 4_000_000
#: Rank of a pair that doesn't merge.
NONE = np.iinfo(np.int32).max
#: Padding behind a row's last id.
PAD = -1

_BPE: dict[tuple[str, str], "ByteBpe"] = {}


class PairTable:
    """Ids of merged pairs in an open-addressing hash table of numpy arrays, searched for many pairs at once."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)  # 2^64 by the golden ratio

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(2 * len(merged)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        keys, values = (left.astype(np.int64) << 32) | right, merged.astype(np.int32)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[free]  # of several keys for a slot one stays
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self.FACTOR) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged id of each pair, which is its rank, or ``NONE``; padding merges with nothing."""
        keys = (left.astype(np.int64) << 32) | right
        keys[(left < 0) | (right < 0)] = -2
        slots, out, open_ = self._slots(keys), np.full(len(keys), NONE, np.int32), np.arange(len(keys))
        while len(open_):
            there = self.keys[slots]
            hit = there == keys
            out[open_[hit]] = self.values[slots[hit]]
            on = ~hit & (there != -1)
            open_, keys, slots = open_[on], keys[on], (slots[on] + 1) & (len(self.keys) - 1)
        return out


def merge_rows(tokens: np.ndarray, lengths: np.ndarray, table: PairTable) -> list[np.ndarray]:
    """The ids of each row of byte ids after all merges; ``tokens`` is padded with ``PAD``.

    Along with its leftmost pair of least rank a row merges, in the same round and
    from left to right, further pairs of that rank up to the first merge that makes
    a pair of lower rank. One merge a time would choose these same pairs, so a long
    row needs a round for each rank rather than for each merge.
    """
    out: list[np.ndarray] = [None] * len(tokens)
    whose = np.arange(len(tokens))
    ranks = table.ranks(tokens[:, :-1].ravel(), tokens[:, 1:].ravel()).reshape(len(tokens), -1)
    while True:
        least = ranks.min(axis=1, initial=NONE)
        done = least == NONE
        if done.any():
            for i in np.flatnonzero(done):
                out[whose[i]] = tokens[i, : lengths[i]]
            on = ~done
            whose, tokens, lengths, ranks, least = whose[on], tokens[on], lengths[on], ranks[on], least[on]
            if not len(whose):
                return out
            width = int(lengths.max())  # compaction: finished rows and columns that are all padding go
            tokens, ranks = tokens[:, :width], ranks[:, : width - 1]
        chosen = _without_overlap(ranks == least[:, None])
        rows, at = np.nonzero(chosen)
        if len(rows) > len(tokens):
            chosen = _until_lower(tokens, chosen, rows, at, least, table)
            rows, at = np.nonzero(chosen)
        merged = tokens.copy()
        merged[rows, at] = least[rows]
        keep = np.ones(tokens.shape, bool)
        keep[rows, at + 1] = False
        count = keep.sum(1)
        filled = np.arange(tokens.shape[1])[None, :] < count[:, None]
        wide = np.concatenate([ranks, np.full((len(ranks), 1), NONE, np.int32)], axis=1)
        tokens, moved, fresh = np.full_like(tokens, PAD), np.full_like(wide, NONE), np.zeros(tokens.shape, bool)
        tokens[filled], moved[filled], fresh[filled] = merged[keep], wide[keep], chosen_wide(chosen)[keep]
        ranks = moved[:, :-1]
        lengths = lengths - (merged.shape[1] - count)
        changed = fresh[:, :-1] | fresh[:, 1:]
        rows, at = np.nonzero(changed)
        ranks[rows, at] = table.ranks(tokens[rows, at], tokens[rows, at + 1])


def chosen_wide(chosen: np.ndarray) -> np.ndarray:
    """``chosen`` with a column more, for the last id, which begins no pair."""
    return np.concatenate([chosen, np.zeros((len(chosen), 1), bool)], axis=1)


def _without_overlap(hit: np.ndarray) -> np.ndarray:
    """Of pairs that follow each other without a gap every second, from the left."""
    column = np.arange(hit.shape[1])
    first = hit.copy()
    first[:, 1:] &= ~hit[:, :-1]
    start = np.maximum.accumulate(np.where(first, column, 0), axis=1)
    return hit & ((column - start) % 2 == 0)


def _until_lower(tokens: np.ndarray, chosen: np.ndarray, rows: np.ndarray, at: np.ndarray, least: np.ndarray, table: PairTable) -> np.ndarray:
    """``chosen`` up to each row's first merge that makes a pair of lower rank."""
    new, last = least[rows], tokens.shape[1] - 1
    after_merge = (at >= 2) & chosen[rows, np.maximum(at - 2, 0)]
    before = np.where(at > 0, np.where(after_merge, new, tokens[rows, np.maximum(at - 1, 0)]), PAD)
    behind = np.where(at + 2 <= last, tokens[rows, np.minimum(at + 2, last)], PAD)
    lower = np.minimum(table.ranks(before, new), table.ranks(new, behind)) < new
    if not lower.any():
        return chosen
    end = np.full(len(tokens), tokens.shape[1])
    np.minimum.at(end, rows[lower], at[lower])
    return chosen & (np.arange(chosen.shape[1])[None, :] <= end[:, None])


class ByteBpe:
    """The vocabulary of a rank file: a token's bytes in base 64 and its rank, which is its id, a line."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = regex.compile(pattern).findall
        self.tokens = dict(zip(self.ranks.values(), self.ranks, strict=True))
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.table = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)
        self.most = CACHE_PIECES
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merged(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces, each by its bytes alone."""
        out: list[np.ndarray] = [None] * len(pieces)
        sizes = np.array([len(p) for p in pieces], np.int64)
        order = np.argsort(sizes, kind="stable")
        start = 0
        while start < len(order):
            # A bucket: pieces up to a power of two long, as many as fit.
            width = 1 << int(max(1, sizes[order[start]] - 1)).bit_length()
            end = min(int(np.searchsorted(sizes[order], width, "right")), start + max(1, CELLS // width))
            own = order[start:end]
            length = sizes[own]
            tokens = np.full((len(own), max(2, int(length.max()))), PAD, np.int32)
            tokens[np.arange(tokens.shape[1])[None, :] < length[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces[i] for i in own), np.uint8)]
            for i, ids in zip(own, merge_rows(tokens, length, self.table), strict=True):
                out[i] = ids
            start = end
        return out

    def learn(self, pieces: Iterable[str]) -> None:
        """Put the ids of these pieces into the cache."""
        new, spelt = [], []
        for p in pieces:
            if p in self.known:
                continue
            ids = self.old.get(p)
            if ids is None:
                raw = p.encode()
                whole = self.ranks.get(raw)
                if whole is None:
                    new.append(p)
                    spelt.append(raw)
                    continue
                ids = whole.to_bytes(4, "little")
            self.known[p] = ids
        for p, ids in zip(new, self.merged(spelt), strict=True):
            self.known[p] = ids.astype("<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        if len(self.known) > self.most:
            self.known, self.old = {}, self.known
        cut = [self.split(t) for t in texts]
        self.learn(set().union(*cut))
        ids = self.known.__getitem__
        return [b"".join(map(ids, pieces)) for pieces in cut]

    def decode(self, ids: bytes) -> bytes:
        """The bytes of ids; an unknown id is an error."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def byte_bpe(path: str, pattern: str, cache_pieces: int = CACHE_PIECES) -> ByteBpe:
    """The vocabulary of this Python process for a rank file and pattern; it outlives a task."""
    key = (path, pattern)
    if key not in _BPE:
        _BPE[key] = ByteBpe(path, pattern)
    _BPE[key].most = cache_pieces
    return _BPE[key]


def _blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of about ``CHARS``; one item at least."""
    start, size = 0, 0
    for i, n in enumerate(sizes):
        size += n
        if size >= CHARS or i == len(sizes) - 1:
            yield start, i + 1
            start, size = i + 1, 0


def encode_bpe(documents: DataFrame, path: str, pattern: str, id_col: str = "doc_id", cache_pieces: int = CACHE_PIECES) -> DataFrame:
    """(``id_col``, ids) of every whole text; ids are little-endian unsigned 32-bit integers.

    ``path`` is a rank file and ``pattern`` splits texts into pieces, each of which
    is encoded by itself: as one id if it is in the file, else by merges of its
    bytes. Marks that other files treat as special are ordinary text. A null text
    counts as empty and has no id. Rows are independent: repeated ones stay, a null
    id is kept, an empty table gives no row. Other columns aren't read. No shuffle.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern, cache_pieces)
        for batch in batches:
            texts = batch.column(1)
            for a, b in _blocks(pa.compute.binary_length(texts).to_pylist()):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(bpe.encode(texts.slice(a, b - a).to_pylist()), pa.binary())], names=["id", "ids"])

    kind = dict(documents.dtypes)[id_col]
    return text_of(documents, F.col(id_col).alias("id")).mapInArrow(lean(encoded), f"id {kind}, ids binary").withColumnRenamed("id", id_col)


def decode_bpe(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(``id_col``, ids, decoded): the bytes that the ids stand for; null ids count as none, an unknown id is an error."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            ids = batch.column(1)
            for a, b in _blocks(pa.compute.binary_length(ids).to_pylist()):
                own = ids.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), own, pa.array(map(bpe.decode, own.to_pylist()), pa.binary())], names=["id", "ids", "decoded"])

    kind = dict(encoded.dtypes)[id_col]
    rows = encoded.select(F.col(id_col).alias("id"), F.coalesce("ids", F.lit(b"")).alias("ids"))
    return rows.mapInArrow(lean(decoded), f"id {kind}, ids binary, decoded binary").withColumnRenamed("id", id_col)


def round_trip(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document, encoded and then decoded."""
    both = decode_bpe(encode_bpe(documents, path, pattern), path, pattern)
    return both.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
