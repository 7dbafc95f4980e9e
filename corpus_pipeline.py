"""A training-corpus pipeline of five of the text operators.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns the columns of ``documents``, except the last, which returns pieces
of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import table, written
from riskspark.llm.decontaminate import keep_clean
from riskspark.llm.near_duplicates import near_duplicates
from riskspark.llm.packing import pack_mixture
from riskspark.llm.quality_classifier import keep_good
from riskspark.llm.queries import tokenizer_path
from riskspark.llm.secrets import redact


#: Words that the tokenizer remembers, twice; a Python worker also holds what other stages need.
CACHE_PARTS = 100_000
#: Dropped ids up to which they are broadcast, about 100 MB; more are joined by a shuffle.
MOST_BROADCAST = 2_000_000


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject.

    Null and empty texts are scored as empty ones. Rows are judged each, repeated
    ids or not; other columns pass through. Without labels nothing is rejected,
    and an empty table stays empty.
    """
    return keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates, by sets of five-word shingles.

    Texts without words are no copies and all stay, as do rows without an id. Rows
    that repeat an id are one document: they go if any of them is a copy of a
    document of a smaller id, else the one of the smallest text stays. Other
    columns pass through.
    """
    found = near_duplicates(docs, size=5)
    copies = written(found.filter(~F.col("kept")).select("doc_id").distinct(), "copies")
    kept = docs.join(F.broadcast(copies) if copies.count() <= MOST_BROADCAST else copies, "doc_id", "left_anti").select(*docs.columns)
    repeated = written(found.filter("kept and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return kept
    again = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), F.coalesce("text", F.lit(""))).alias("row"))
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(again.select("row.*"))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item.

    Null and empty texts hold none and stay; rows are judged each, other columns
    pass through. Without items nothing goes.
    """
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and their lengths brought up to date.

    Null texts stay null, with a null length. Every row stays; other columns pass through.
    """
    clean = redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, mixed by source.

    Null and empty texts are one end id, a null source is the source "", rows
    that repeat an id are packed each; only the id, source and text are read.
    """
    return pack_mixture(docs, tokenizer_path(), cache_parts=CACHE_PARTS, keep_encoder=False)


STAGES = [
    ("quality classifier", good_documents),
    ("near-duplicates", one_of_each_group),
    ("decontamination", uncontaminated),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: The classifier, the chosen paths and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
