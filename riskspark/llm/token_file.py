"""Token-ID / binary output with Elias-Fano document boundaries.

A segment is one binary value of this layout (little-endian):

    magic ``EFS1`` | id width in bytes u32 | documents u64 | ids u64 |
    low bits a boundary u32 | words of the high bits u64 | bytes of the low bits u64 |
    select samples u64 | high bits u64[] | select samples u64[] | low bits | ids

The n boundaries are the starts of the documents and the end of the last one,
a non-decreasing sequence below u = ids + 1. Each is split into its low
log2(u / n) bits, stored packed, and its high part, stored in unary: bit
``high + i`` is set for boundary i. That is about 2 + log2(u / n) bits a
boundary. ``select(i)`` finds set bit i from the nearest sample (every 256th) by
counting bits word by word, and so gives any document's offset without a table.

Segments are rows (part, segment, first id, documents, ids, doc_ids, payload) of
a Parquet folder, written by Spark's committer: a retried task leaves no partial
or double segment.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, text_of, written
from .tokens import blocks, encoder

MAGIC = b"EFS1"
HEAD = struct.Struct("<4sIQQIQQQ")
SAMPLE = 256
#: Ids after which a segment is closed; a longer document has a segment alone.
SEGMENT_IDS = 1 << 18
END_ID = 0


def pack_boundaries(values: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, bytes]:
    """(low bits, high words, select samples, packed low bits) of a non-decreasing sequence."""
    values = np.asarray(values, np.uint64)
    n, u = len(values), int(values[-1]) + 1 if len(values) else 1
    low = max(0, (u // max(n, 1)).bit_length() - 1)
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    bits = np.zeros((int(ones[-1]) // 64 + 1) * 64 if n else 64, np.uint8)
    bits[ones] = 1
    packed = b""
    if low:
        part = (values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
        packed = np.packbits(part.astype(np.uint8).ravel(), bitorder="little").tobytes()
    return low, np.packbits(bits, bitorder="little").view("<u8"), ones[::SAMPLE].astype("<u8"), packed


class Segment:
    """Random access to a segment's documents."""

    def __init__(self, payload: bytes):
        magic, self.width, self.documents, self.ids, self.low, words, packed, samples = HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at = HEAD.size
        self.high = np.frombuffer(payload, "<u8", words, at)
        at += 8 * words
        self.samples = np.frombuffer(payload, "<u8", samples, at)
        at += 8 * samples
        self.packed = np.frombuffer(payload, np.uint8, packed, at)
        self.tokens = np.frombuffer(payload, f"<u{self.width}", self.ids, at + packed)

    def select(self, i: int) -> int:
        """Boundary ``i``: the start of document i, or the end of the last one."""
        at = int(self.samples[i // SAMPLE])
        left, word = i % SAMPLE, at // 64
        bits = int(self.high[word]) >> (at % 64) << (at % 64)
        while left >= bits.bit_count():
            left -= bits.bit_count()
            word += 1
            bits = int(self.high[word])
        for _ in range(left):
            bits &= bits - 1
        high = word * 64 + (bits & -bits).bit_length() - 1 - i
        first = i * self.low
        low = int.from_bytes(self.packed[first // 8 : (first + self.low + 7) // 8].tobytes(), "little")
        return high << self.low | low >> first % 8 & (1 << self.low) - 1

    def boundaries(self) -> np.ndarray:
        """All boundaries at once."""
        n = self.documents + 1
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[:n]
        values = (ones - np.arange(n)) << self.low
        if self.low:
            bits = np.unpackbits(self.packed, bitorder="little")[: n * self.low].reshape(n, self.low)
            values |= (bits.astype(np.int64) << np.arange(self.low)).sum(1)
        return values

    def document(self, i: int) -> np.ndarray:
        return self.tokens[self.select(i) : self.select(i + 1)]


def pack_segment(lengths: list[int], ids: bytes, width: int) -> bytes:
    """A segment of the documents of these lengths; ``ids`` are unsigned 32-bit."""
    ends = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))]).astype(np.uint64)
    low, high, samples, packed = pack_boundaries(ends)
    tokens = np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()
    head = HEAD.pack(MAGIC, width, len(lengths), int(ends[-1]), low, len(high), len(packed), len(samples))
    return b"".join((head, high.tobytes(), samples.tobytes(), packed, tokens))


SEGMENTS = "part int, segment int, first long, documents int, ids long, doc_ids array<bigint>, payload binary"


def write_token_segments(documents: DataFrame, tokenizer_path: str, id_col: str = "doc_id", segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Encode whole texts and write them, in ascending order of ``id_col``, as segments.

    Null texts count as empty. Each document ends with id 0. Rows of equal id
    stay in one order fixed by their text; a null id comes first. Only ``id_col``
    and ``text`` are read, so further columns may have any name.

    One shuffle: texts are dealt by id ranges (and text hash, so that one
    repeated id doesn't meet in one task) and sorted; parts are numbered in id
    order. Returns the written table.
    """
    end = struct.pack("<I", END_ID)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, enc = TaskContext.get().partitionId(), encoder(tokenizer_path)
        segment, first, lengths, doc_ids, ids, size = 0, 0, [], [], [], 0

        def row() -> pa.RecordBatch:
            columns = [[part], [segment], [first], [len(lengths)], [size], [doc_ids], [pack_segment(lengths, b"".join(ids), enc.width)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary()), strict=True)],
                names=["part", "segment", "first", "documents", "ids", "doc_ids", "payload"],
            )

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in blocks(texts):
                for key, raw in zip(keys[a:b], enc.encode(texts[a:b]), strict=True):
                    own = raw + end
                    if size and size + len(own) // 4 > segment_ids:
                        yield row()
                        segment, first, lengths, doc_ids, ids, size = segment + 1, first + size, [], [], [], 0
                    lengths.append(len(own) // 4)
                    doc_ids.append(key)
                    ids.append(own)
                    size += lengths[-1]
        if lengths:
            yield row()

    texts = text_of(documents, F.col(id_col).cast("long").alias("id")).withColumn("tie", F.xxhash64("text"))
    ordered = texts.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")
    return written(ordered.mapInArrow(lean(encoded), SEGMENTS), "segments")


def read_token_segments(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the segments.

    ``start`` counts the ids of all documents before it. The ids of each part
    are summed by Spark; that is one small row a part.
    """
    from itertools import accumulate

    sums = segments.groupBy("part").agg(F.sum("ids").alias("ids")).orderBy("part").collect()
    starts = dict(zip([r["part"] for r in sums], accumulate([r["ids"] for r in sums], initial=0), strict=False))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, doc_ids, payload in zip(*(batch.column(c) for c in ("part", "first", "doc_ids", "payload")), strict=True):
                seg = Segment(payload.as_py())
                ends = seg.boundaries()
                wide = memoryview(seg.tokens.astype("<u4").tobytes())
                base = starts[part.as_py()] + first.as_py()
                cuts = (4 * ends).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids.as_py(), pa.int64()),
                        pa.array(base + ends[:-1], pa.int64()),
                        pa.array(np.diff(ends), pa.int64()),
                        pa.array([zlib.crc32(wide[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    read = segments.select("part", "first", "doc_ids", "payload")
    return read.mapInArrow(lean(decoded), "doc_id long, start long, n_tokens long, ids_crc32 long")
