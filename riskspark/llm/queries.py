"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import centroids, decontaminate, vector_codes
from .byte_bpe import round_trip
from .centroids import cluster_vectors
from .common import table
from .decontaminate import contamination
from .html_text import extract_pages
from .language import identify_language
from .licenses import scan_licenses
from .near_duplicates import near_duplicates
from .packing import pack_mixture
from .quality_classifier import score_quality
from .quality_rules import judge_quality
from .secrets import find_secrets
from .token_file import read_token_segments, write_token_segments
from .vector_codes import compress_vectors


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_mixture(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"))


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_segments(write_token_segments(table(spark, sf_dir, "documents"), tokenizer_path()))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents")).drop("found")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(table(spark, sf_dir, "embeddings"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_quality_rules": op2_quality_rules,
    "op3_token_file": op3_token_file,
    "op4_secrets": op4_secrets,
    "op5_language": op5_language,
    "op6_html_text": op6_html_text,
    "op7_decontamination": op7_decontamination,
    "op8_licenses": op8_licenses,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_vector_codes": op11_vector_codes,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_byte_bpe": op13_byte_bpe,
}
ORACLES: dict[str, str] = {"op7_decontamination": decontaminate.ORACLE, "op11_vector_codes": vector_codes.ORACLE, "op12_centroid_clusters": centroids.ORACLE}
