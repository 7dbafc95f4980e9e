"""Benchmark decontamination with one Aho-Corasick automaton.

Normalising lowers A-Z and keeps words of digits, a-z and characters beyond
ASCII, joined by one space. A window is ``window`` consecutive words of an item,
or all of them where an item has fewer. The automaton holds every distinct
window between spaces, so that it matches whole words only; a text is scanned
once and each match is mapped back to word places and, for spans, to offsets in
the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, text_of, written

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Byte by byte: A-Z to a-z, other ASCII beside digits and a-z to space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Characters of item texts in one automaton, about 600 MB at most; a larger benchmark has several, held one at a time.
BLOCK_CHARS = 1_000_000
#: Characters of texts that a task holds while it goes through several automata.
HELD_CHARS = 32_000_000
#: Characters of items that the driver and a task hold at once, about.
HELD_ITEMS = 64_000_000

_TAGS = count()
_AUTOMATA: dict[tuple[int, int], object] = {}


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def windows_of(items: list[tuple[str, str]], window: int) -> dict[str, tuple[int, list[str]]]:
    """Window text, between spaces, to its number of words and the ids of its items."""
    found: dict[str, dict[str, None]] = defaultdict(dict)
    for item_id, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            found[f" {b' '.join(words[i : i + window]).decode('utf-8', 'surrogatepass')} "][item_id] = None
    return {k: (k.count(" ") - 1, list(v)) for k, v in found.items()}


def _automaton(tag: tuple[int, int], items: list[tuple[str, str]], window: int):
    """The automaton that this Python process holds; None if no item has a word."""
    if tag not in _AUTOMATA:
        _AUTOMATA.clear()
        import ahocorasick

        found = ahocorasick.Automaton()
        for key, value in windows_of(items, window).items():
            found.add_word(key, value)
        found.make_automaton()
        _AUTOMATA[tag] = found if len(found) else None
    return _AUTOMATA[tag]


def _matches(text: str, automaton) -> tuple[int, list[tuple[int, int, list[str]]]]:
    """Number of words, and (first word, end, item ids) of each window found."""
    words = words_of(text)
    if not words or automaton is None:
        return len(words), []
    line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    found = list(automaton.iter(line))
    if not found:
        return len(words), []
    spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4") == 32)
    ends = np.searchsorted(spaces, [e for e, _ in found]).tolist()
    return len(words), [(end - n, end, ids) for end, (_, (n, ids)) in zip(ends, found, strict=True)]


def _merged(found: list[tuple[int, int, list[str]]]) -> tuple[list[tuple[int, int]], list[str]]:
    """Hit word ranges, merged, end exclusive, and item ids, sorted."""
    ranges: list[list[int]] = []
    for first, end, _ in sorted(found):
        if ranges and first <= ranges[-1][1]:
            ranges[-1][1] = max(ranges[-1][1], end)
        else:
            ranges.append([first, end])
    return [tuple(x) for x in ranges], sorted({i for *_, ids in found for i in ids})


class Scanner:
    """Blocks of a benchmark's items, and the scan of texts against them all."""

    def __init__(self, items: DataFrame, blocks: range, window: int):
        self.window, self.tag = window, next(_TAGS)
        self.blocks: list[list[tuple[str, str]]] = [[] for _ in blocks]
        for r in items.filter(F.col("block").between(blocks[0], blocks[-1])).toLocalIterator():
            self.blocks[r["block"] - blocks[0]].append((r["item"], r["text"]))

    def scan(self, texts: list[str]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """(number of words, hit word ranges, item ids) of each text."""
        n_words, found = [0] * len(texts), [[] for _ in texts]
        for k, block in enumerate(self.blocks):
            automaton = _automaton((self.tag, k), block, self.window)
            for i, text in enumerate(texts):
                n_words[i], more = _matches(text, automaton)
                found[i] += more
        return [(n, *_merged(x)) for n, x in zip(n_words, found, strict=True)]

    def batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
        """Each batch with the scans of its texts; with several blocks many batches are scanned together."""
        held: list[tuple[pa.RecordBatch, list[str]]] = []
        most = 0 if len(self.blocks) == 1 else HELD_CHARS

        def scanned() -> Iterator[tuple[pa.RecordBatch, list]]:
            scans = iter(self.scan([t for _, texts in held for t in texts]))
            for batch, texts in held:
                yield batch, [next(scans) for _ in texts]
            held.clear()

        for batch in batches:
            held.append((batch, [x or "" for x in batch.column("text").to_pylist()]))
            if sum(len(t) for _, texts in held for t in texts) >= most:
                yield from scanned()
        if held:
            yield from scanned()


def scanners(benchmark: DataFrame, window: int, block_chars: int) -> Iterator[Scanner]:
    """One scanner, or several in turn that hold about ``HELD_ITEMS`` characters of items each, whatever the benchmark's size."""
    items = benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("item"), "text")
    size = items.agg(F.sum(F.char_length("text")).alias("n")).first()["n"] or 0
    parts = -(-size // block_chars) or 1
    dealt, step = items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(parts)).cast("int")), max(1, HELD_ITEMS // block_chars)
    for first in range(0, parts, step):
        yield Scanner(dealt, range(first, min(parts, first + step)), window)


HITS = "n_words long, hits array<struct<first:bigint,last:bigint>>, items array<string>"


def scan_benchmark(documents: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, text, n_words, hits, items) of every document row; hits are word ranges, end exclusive.

    Null and empty texts have no words and no hits; items without words or with a
    null id have no windows; repeated rows are each scanned. Other columns are not
    read.

    No shuffle, and texts are read once. Tasks hold the items, whose size is
    measured first. Items of up to ``block_chars`` characters are one automaton;
    more are cut by item into blocks, and a task builds one automaton after the
    other for every ``HELD_CHARS`` characters of its texts, so memory is bounded
    and texts aren't written again. Of a benchmark beyond ``HELD_ITEMS``
    characters the driver and the tasks hold one part after the other, and rows with
    the hits so far are written between them.
    """
    found = documents.select(id_col, "text")
    for scanner in scanners(benchmark, window, block_chars):
        found = _scanned(written(found, "scanned") if "hits" in found.columns else found, scanner, id_col)
    return found


def _scanned(rows: DataFrame, scanner: Scanner, id_col: str) -> DataFrame:
    """``rows`` with the hits of a scanner, and those that they have already."""
    held, more = rows.sparkSession.sparkContext.broadcast(scanner), "hits" in rows.columns

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scans in held.value.batches(batches):
            if more:
                old = zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist(), strict=True)
                scans = [(n, *_merged([(a, b, ids) for a, b in ranges] + [(h["first"], h["last"], had) for h in hits])) for (n, ranges, ids), (hits, had) in zip(scans, old, strict=True)]
                batch = batch.select([id_col, "text"])
            hits = [[{"first": a, "last": b} for a, b in ranges] for _, ranges, _ in scans]
            kinds = (pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])), pa.list_(pa.string()))
            own = [pa.array(c, t) for c, t in zip(([n for n, *_ in scans], hits, [x[2] for x in scans]), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=[*batch.schema.names, "n_words", "hits", "items"])

    return rows.mapInArrow(lean(scanned), f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, text string, {HITS}")


def keep_clean(documents: DataFrame, benchmark: DataFrame, window: int = 10, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``documents`` without a hit, with all their columns; see ``scan_benchmark``."""
    kept = documents
    for k, scanner in enumerate(scanners(benchmark, window, block_chars)):
        kept = _kept(written(kept, "kept") if k else kept, scanner)
    return kept


def _kept(rows: DataFrame, scanner: Scanner) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(scanner)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scans in held.value.batches(batches):
            yield batch.filter(pa.array([not ranges for _, ranges, _ in scans], pa.bool_()))

    return rows.mapInArrow(lean(kept), rows.schema)


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id") -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 and contaminated.

    See ``scan_benchmark`` for nulls, empty texts and repeated rows.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, n_words, hits, items = (batch.column(i).to_pylist() for i in range(4))
            n_hit = [sum(x["last"] - x["first"] for x in h) for h in hits]
            ids = items
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in ids], pa.string()), pa.array([n > 0 for n in n_hit], pa.bool_()),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    found = scan_benchmark(text_of(documents, F.col(id_col).cast("long").alias("doc_id")), benchmark, window)
    return found.select("doc_id", "n_words", "hits", "items").mapInArrow(lean(digest), "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def spans_in_text(text: str, hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets, in the original text, of hit word ranges."""
    places = [m.span() for m in WORD.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in hits]


def contaminated_spans(documents: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, start, end, passage) of every contaminated passage, in original characters."""

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, hits in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                rows += [(doc_id, a, b, text[a:b]) for a, b in spans_in_text(text, [(h["first"], h["last"]) for h in hits])]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "start", "end", "passage"])

    found = scan_benchmark(text_of(documents, F.col(id_col).cast("long").alias("doc_id")), benchmark, window)
    return found.filter(F.size("hits") > 0).select("doc_id", "text", "hits").mapInArrow(lean(located), "doc_id long, start long, end long, passage string")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
wb AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS key FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
wd AS (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS key FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM wb) WHERE len(w) >= n)),
h AS (SELECT r, i, n, item FROM wd JOIN wb USING (n, key)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM h)) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN its USING (r)
"""
