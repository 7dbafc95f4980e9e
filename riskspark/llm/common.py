"""Helpers that several text operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import shared_dir, written

__all__ = ["bound", "lean", "lower_ascii", "places", "replaced", "running_sums", "shared_dir", "table", "text_of", "written"]

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """``keep`` and the text, null as the empty string, and no other column."""
    return df.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def lean(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``f``, a function of a task's Arrow batches, that gives freed memory back to the machine when the task ends.

    Python workers outlive their tasks, and what the largest batch took would
    stay with them.
    """

    @wraps(f)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
        if trim:
            trim(0)

    return wrapped


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    ``lower`` has a fast path but also changes letters beyond ASCII, so it is
    used where a text has none.
    """
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, ASCII_UPPER, ASCII_LOWER))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_sums(numbers: Column) -> Column:
    """For each element of an array<int> the sum of those before it."""
    return _running(numbers, lambda a, b: a + b)


def running_greatest(numbers: Column) -> Column:
    """For each element of an array<int>, none negative, the greatest of those before it, 0 for the first."""
    return _running(numbers, F.greatest)


def _running(numbers: Column, both: Callable[[Column, Column], Column]) -> Column:
    """For each element what ``both`` makes of 0 and those before it.

    It runs within chunks of about the square root of the length and then over
    the chunks, so that no long array is copied for every element.
    """

    def scan(xs: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
        return F.aggregate(xs, start, lambda acc, x: F.struct(both(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    def run(xs: Column) -> Column:
        width = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(xs)))).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / width).cast("int")), lambda i: scan(F.slice(xs, i * width + 1, width)))
        placed = bound(chunks, lambda own: F.zip_with(own, scan(F.transform(own, lambda c: c["at"]))["out"], lambda c, base: F.transform(c["out"], lambda x: both(x, base))))
        return F.when(F.size(xs) > 0, F.flatten(placed)).otherwise(F.expr("cast(array() as array<int>)"))

    return bound(numbers, run)


def replaced(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with each span (start, end) replaced by ``mark``; spans that overlap count as one, from the first start to the last end.

    Spans come in order of start. The text is cut into chunks once, and what stands
    between spans is taken from its chunks, so that no span goes through the text
    from its start; the pieces are joined once.
    """

    def in_chunks(own: Column) -> Column:
        return bound(F.greatest(F.lit(256), F.ceil(F.sqrt(F.char_length(own)))).cast("int"), lambda width: of_width(own, width))

    def of_width(own: Column, width: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor(F.char_length(own) / width).cast("int")), lambda i: F.substring(own, i * width + 1, width))

        def piece(cut: Column, a: Column, b: Column) -> Column:
            first, last = F.floor(a / width).cast("int"), F.floor(b / width).cast("int")
            head, tail = F.get(cut, first), F.coalesce(F.get(cut, last), F.lit(""))
            middle = F.array_join(F.slice(cut, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
            return F.when(first == last, F.substring(head, a % width + 1, b - a)).otherwise(F.concat(F.substring(head, a % width + 1, width), middle, F.substring(tail, F.lit(1), b % width)))

        def joined(cut: Column) -> Column:
            # Ends of the spans before each, the greatest so far: by chunks of spans, as in running_sums.
            return bound(running_greatest(F.transform(spans, lambda x: x["end"].cast("int"))), lambda until: pieces(cut, until))

        def pieces(cut: Column, until: Column) -> Column:
            each = F.transform(spans, lambda x, i: F.when(x["start"] >= F.get(until, i), F.concat(piece(cut, F.get(until, i), x["start"].cast("int")), F.lit(mark))).otherwise(F.lit("")))
            last = F.greatest(F.get(until, F.size(spans) - 1), F.element_at(spans, -1)["end"].cast("int"))
            return F.concat(F.array_join(each, ""), piece(cut, last, F.char_length(own)))

        return bound(chunks, joined)

    return F.when(F.size(spans) > 0, bound(text, in_chunks)).otherwise(text)


def places(text: Column, pattern: str) -> Column:
    """array<struct<start, end, found>> of all matches, leftmost and not overlapping, in code points."""

    def located(both: Column) -> Column:
        lengths = F.transform(both, lambda x: F.char_length(x["piece"]) + F.char_length(x["found"]))

        def span(x: Column, before: Column) -> Column:
            first = before + F.char_length(x["piece"])
            return F.struct(first.alias("start"), (first + F.char_length(x["found"])).alias("end"), x["found"].alias("found"))

        return F.zip_with(both, running_sums(lengths), span)

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), matches.alias("found"))
    return bound(F.filter(both, lambda x: x["found"].isNotNull()), located)
