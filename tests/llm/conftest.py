import pytest
from pyspark.sql import functions as F

TEXTS = [None, "", " \n\t", "a", "a b", "The end.", "the end.", "word " * 5000, "x" * 30000, "émile ß 日本 <|endoftext|>", "a\n\nb  c \r\n d", "same text here for all of us", "same text here for all of us"]


@pytest.fixture
def odd(spark):
    """Documents with nulls, empty and long texts, repeated rows and clashing extra columns."""
    rows = [(i, t, None if i % 3 else "en", None if i % 2 else "s", None) for i, t in enumerate(TEXTS)] + [(11, TEXTS[11], "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = {c: F.lit(7) for c in ("id", "a", "b", "key", "first", "n_words", "tokens", "part", "ids", "tree", "component", "label", "score", "kept", "words", "base", "found", "spans", "size", "bucket", "spot", "values", "n", "row", "hits", "items", "held_out")}
    return df.withColumns(clash)


@pytest.fixture
def empty(odd):
    return odd.limit(0)


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven"), (2, "The END"), (3, None), (4, ""), (None, "a b")], "item_id long, text string")


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(14)] + [(1, None, None), (2, 1, 0)], "doc_id long, quality int, toxic int")
