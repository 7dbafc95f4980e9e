"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of tokens. A window (one training batch of
``window_sequences`` sequences) takes from each queue its target share of
tokens; what a share's fraction leaves over or takes in advance is the queue's
deficit and is carried to the next window. Queues that run dry leave their share
to the others, so all windows but the last are full.

The round-robin order has a closed form, which is what makes it parallel: with
a quantum of one token, token q of source s is served at virtual time
(q + 1/2) / weight(s), so the tokens of s before position R of the packed stream
are a function of R, the weights and the queue lengths alone. Each task computes
the windows of its own documents; deficits thus carry over windows, tasks and
machines without any message between them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, text_of, written
from .tokens import CACHE_PARTS, blocks, encoder, release_encoders

#: Sources with a queue of their own; the targets are a table that every task holds. The rarer rest shares one queue.
MAX_SOURCES = 10_000
#: Parts of the shared queue, by a hash of the source; their sums are collected.
SHARED_PARTS = 4096
#: Numbers of the positions that a task remembers.
KNOWN_NUMBERS = 1 << 22


class Mixture:
    """Where the round-robin stands at each position of the packed stream."""

    def __init__(self, totals: Mapping[str, int], weights: Mapping[str, float] | None = None):
        self.sources = sorted(totals)
        self.index = {s: i for i, s in enumerate(self.sources)}
        self.totals = np.array([totals[s] for s in self.sources], np.int64)
        share = self.totals if weights is None else np.array([weights.get(s, 0.0) for s in self.sources])
        # A source without a target is served only when the others are dry.
        self.weights = np.maximum(np.asarray(share, float), 1e-9 * max(1e-300, float(np.max(share, initial=0.0))))
        self.weights = self.weights / max(self.weights.sum(), 1e-300)
        self.total = int(self.totals.sum())
        self._known: dict[int, np.ndarray] = {}
        self._windows: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def _served(self, time: float) -> np.ndarray:
        return np.minimum(self.totals, np.floor(np.minimum(self.weights * time + 0.5, 2.0**62)).astype(np.int64))

    def before(self, position: int) -> np.ndarray:
        """Tokens of each source among the first ``position`` of the packed stream."""
        if (known := self._known.get(position)) is not None:
            return known
        if position >= self.total:
            return self.totals
        low, high = 0.0, float(max(position, 1))
        while self._served(high).sum() <= position:
            high *= 2
        while (mid := (low + high) / 2) not in (low, high):
            if self._served(mid).sum() <= position:
                low = mid
            else:
                high = mid
        out = self._served(low)
        left = position - int(out.sum())
        out[np.flatnonzero(self._served(high) > out)[:left]] += 1
        if len(self._known) >= 4096 or len(self._known) * len(out) > KNOWN_NUMBERS:
            self._known.clear()
        self._known[position] = out
        return out

    def window(self, k: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each source its first token in window k, its end there, and the position of that first token."""
        if (known := self._windows.get((k, size))) is not None:
            return known
        here, after = self.before(k * size), self.before((k + 1) * size)
        taken = after - here
        if len(self._windows) >= 4096 or len(self._windows) * len(here) > KNOWN_NUMBERS:
            self._windows.clear()
        out = self._windows[k, size] = here, after, k * size + np.cumsum(taken) - taken
        return out

    def window_of(self, source: int, token: int, size: int) -> int:
        """The window that serves this token of the source."""
        low, high = 0, -(-self.total // size) - 1
        guess = int(self._served((token + 0.5) / self.weights[source]).sum()) // size
        for near in (guess, guess - 1, guess + 1):  # nearly always right
            if low <= near <= high:
                here, after, _ = self.window(near, size)
                if here[source] <= token < after[source]:
                    return near
        while low < high:
            mid = (low + high) // 2
            if self.before((mid + 1) * size)[source] > token:
                high = mid
            else:
                low = mid + 1
        return low


#: The id that ends every document, as four bytes.
END = bytes(4)
TOKENS = "doc_id long, source string, part int, first long, n long, width int, ids binary"
PIECES = "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def tokenize(documents: DataFrame, tokenizer_path: str, id_col: str = "doc_id", source_col: str = "source", cache_parts: int = CACHE_PARTS, keep_encoder: bool = True) -> DataFrame:
    """The ids of every document, with its place in the queue of its source within this part."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, enc, at = TaskContext.get().partitionId(), encoder(tokenizer_path, cache_parts), {}
        for batch in batches:
            keys, sources, texts = (batch.column(i).to_pylist() for i in range(3))
            for a, b in blocks(texts):
                first, ids = [], []
                for source, raw in zip(sources[a:b], enc.encode(texts[a:b]), strict=True):
                    raw += END
                    first.append(at.get(source, 0))
                    at[source] = first[-1] + len(raw) // 4
                    ids.append(np.frombuffer(raw, "<u4").astype("<u2").tobytes() if enc.width == 2 else raw)
                n = b - a
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[a:b], pa.int64()), pa.array(sources[a:b], pa.string()), pa.array([part] * n, pa.int32()), pa.array(first, pa.int64()),
                        pa.array([len(x) // enc.width for x in ids], pa.int64()), pa.array([enc.width] * n, pa.int32()), pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "source", "part", "first", "n", "width", "ids"],
                )
        if not keep_encoder:
            del enc
            release_encoders()

    read = text_of(documents, F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"))
    return written(read.mapInArrow(lean(encoded), TOKENS), "tokens")


def pack_mixture(
    documents: DataFrame,
    tokenizer_path: str,
    weights: Mapping[str, float] | None = None,
    sequence_tokens: int = 1024,
    window_sequences: int = 32,
    id_col: str = "doc_id",
    source_col: str = "source",
    cache_parts: int = CACHE_PARTS,
    keep_encoder: bool = True,
) -> DataFrame:
    """Pieces of documents in sequences of ``sequence_tokens`` ids.

    ``weights`` are target proportions of tokens by source; the default is each
    source's own share, under which all queues end together. Sources that are
    not named come last. Only the last sequence has padding. Any number of
    sources is packed: those beyond the ``MAX_SOURCES`` largest and the named ones
    follow each other in one queue, whose target is the sum of theirs.

    Null and empty texts are one end id; a null source is the source ``""``;
    repeated rows are separate documents. An empty table gives no row. Only the
    id, source and text columns are read. ``cache_parts`` bounds the memory of the
    tokenizer's cache; without ``keep_encoder`` each task loads the tokenizer
    anew, and workers don't hold it afterwards.

    No shuffle of tokens: they are written once, the sums by part and source
    give each queue's places, and pieces are cut where the tokens are read.
    """
    tokens = tokenize(documents, tokenizer_path, id_col, source_col, cache_parts, keep_encoder)
    sums = written(tokens.groupBy("part", "source").agg(F.sum("n").alias("n")), "queue-sums")
    by_source = sums.groupBy("source").agg(F.sum("n").alias("n"))
    named = F.col("source").isin(list(weights)) if weights else F.lit(False)
    own = {r["source"]: r["n"] for r in by_source.orderBy(named.desc(), F.col("n").desc(), "source").limit(MAX_SOURCES + len(weights or ())).collect()}
    before = lambda *keys: Window.partitionBy(keys[0]).orderBy(*keys[1:]).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", "source", F.coalesce(F.sum("n").over(before("source", "part")), F.lit(0)).alias("base"))
    # The key of the queue that rare sources share sorts behind all others.
    shared, totals = (1, ""), {(0, s): n for s, n in own.items()}
    targets = None if weights is None else {(0, s): w for s, w in weights.items()}
    if len(own) >= MAX_SOURCES + len(weights or ()):
        names = F.broadcast(sums.sparkSession.createDataFrame([(s,) for s in own], "source string"))
        rare = sums.join(names, "source", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("source"), F.lit(SHARED_PARTS)))
        sizes = sorted((r["bucket"], r["n"]) for r in rare.groupBy("bucket").agg(F.sum("n").alias("n")).collect())
        if sizes:
            ends = np.cumsum([n for _, n in sizes]).tolist()
            totals[shared] = ends[-1]
            starts = sums.sparkSession.createDataFrame([(b, end - n) for (b, n), end in zip(sizes, ends, strict=True)], "bucket long, start long")
            inside = F.coalesce(F.sum("n").over(before("bucket", "source", "part")), F.lit(0))
            behind = rare.select("part", "source", "bucket", inside.alias("inside")).join(F.broadcast(starts), "bucket")
            bases = bases.join(names, "source", "left_semi").select("part", "source", "base").unionByName(behind.select("part", "source", (F.col("start") + F.col("inside")).alias("base")))
    window = sequence_tokens * window_sequences

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture = Mixture(totals, targets)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, source, first, n, width, ids in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                wide = memoryview(ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes())
                s, at = mixture.index[(0, source) if (0, source) in mixture.index else shared], 0
                k = mixture.window_of(s, first, window)
                while at < n:
                    here, after, places = mixture.window(k, window)
                    place = int(places[s]) + first + at - int(here[s])
                    end = min(n, int(after[s]) - first)
                    while at < end:
                        length = min(end - at, sequence_tokens - place % sequence_tokens)
                        out.append((doc_id, source, at, length, zlib.crc32(wide[4 * at : 4 * (at + length)]), n, place // sequence_tokens, place % sequence_tokens))
                        at, place = at + length, place + length
                    k += 1
            if out:
                kinds = (pa.int64(), pa.string(), *[pa.int64()] * 6)
                names = ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    placed = tokens.join(bases, ["part", "source"]).select("doc_id", "source", (F.col("base") + F.col("first")).alias("first"), "n", "width", "ids")
    return placed.mapInArrow(lean(cut), PIECES)
