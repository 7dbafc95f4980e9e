"""Profiles of a table: nulls, levels, balance, hours, presence, claims."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import written
from ..functions.ranges import exact_quantiles

#: Parts of a column's levels that are ranked apart.
PARTS = 512


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows, columns), a count each."""
    out = None
    for name, df in tables.items():
        own = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"))
        out = own if out is None else out.unionByName(own)
    return out


def class_balance(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """One row: negatives, positives, rate, ratio."""
    row = df.agg(F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives"))
    return row.select("*", F.try_divide("positives", F.col("positives") + F.col("negatives")).alias("rate"), F.try_divide("negatives", "positives").alias("ratio"))


def null_rates(df: DataFrame, columns: Sequence[str], families: Mapping[str, str] | None = None) -> DataFrame:
    """(column, family, null_rate) in one aggregate; a family is the first pattern that a name matches."""
    row = df.agg(*[F.try_divide(F.count_if(F.col(c).isNull()), F.count("*")).alias(f"r{i}") for i, c in enumerate(columns)])
    parts = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("null_rate")) for i, c in enumerate(columns)])).alias("x")).select("x.*")
    family = F.coalesce(*[F.when(F.col("column").rlike(p), F.lit(n)) for n, p in (families or {}).items()], F.lit("other"))
    return parts.select("column", family.alias("family"), "null_rate")


def null_profile(df: DataFrame, columns: Sequence[str], families: Mapping[str, str]) -> DataFrame:
    """(family, columns, min, median, max) of null rates."""
    return null_rates(df, columns, families).groupBy("family").agg(F.count("*").alias("columns"), F.min("null_rate").alias("min_rate"), F.percentile("null_rate", 0.5).alias("median_rate"), F.max("null_rate").alias("max_rate"))


def null_blocks(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """(columns, nulls): columns whose nulls lie in the same rows.

    A column's mask is an order-free fingerprint of the keys of its null rows;
    keys must be unique. One aggregate for all columns.
    """
    row = df.agg(*[f for i, c in enumerate(columns) for f in (F.bit_xor(F.when(F.col(c).isNull(), F.xxhash64(key))).alias(f"x{i}"), F.count_if(F.col(c).isNull()).alias(f"n{i}"))])
    parts = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"x{i}").alias("mask"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(columns)])).alias("x")).select("x.*")
    return parts.groupBy("mask", "nulls").agg(F.array_join(F.array_sort(F.collect_list("column")), ",").alias("columns")).select("columns", "nulls")


def hourly_profile(df: DataFrame, hour: str = "event_hour", label: str = "is_fraud") -> DataFrame:
    """One row: the busiest and quietest hour, and those of the highest and lowest fraud rate; ties by the hour."""
    hours = df.groupBy(hour).agg(F.count("*").alias("n"), F.avg(F.col(label).cast("double")).alias("rate"))
    by = lambda c: F.struct(F.col(c), -F.col(hour))
    least = lambda c: F.struct(F.col(c), F.col(hour))
    return hours.agg(F.max_by(hour, by("n")).alias("peak_hour"), F.min_by(hour, least("n")).alias("trough_hour"), F.max_by(hour, by("rate")).alias("highest_rate_hour"), F.min_by(hour, least("rate")).alias("lowest_rate_hour"), F.max("rate").alias("highest_rate"), F.min("rate").alias("lowest_rate"))


def presence_lift(df: DataFrame, other: DataFrame, key: str, label: str = "is_fraud") -> DataFrame:
    """One row: fraud rate with and without a match in the other table, and their ratio."""
    joined = df.join(other.select(key).distinct().withColumn("__has", F.lit(True)), key, "left")
    has = F.col("__has").isNotNull()
    y = F.col(label).cast("double")
    row = joined.agg(F.count_if(has).alias("with_rows"), F.count_if(~has).alias("without_rows"), F.avg(F.when(has, y)).alias("with_rate"), F.avg(F.when(~has, y)).alias("without_rate"))
    return row.withColumn("lift", F.try_divide("with_rate", "without_rate"))


def verdicts(measured: DataFrame, claims: DataFrame, tolerance: float = 0.10) -> DataFrame:
    """(name, measured, claimed, verdict): CONFIRMED within the tolerance, else REFUTED; UNMEASURED without a figure."""
    close = F.abs(F.col("measured") - F.col("claimed")) <= tolerance * F.abs("claimed")
    return claims.join(measured, "name", "left").select("name", "measured", "claimed", F.when(F.col("measured").isNull(), "UNMEASURED").when(close, "CONFIRMED").otherwise("REFUTED").alias("verdict"))


def cardinality_profile(df: DataFrame, columns: Sequence[str], k: int = 20) -> DataFrame:
    """(column, levels, null_rate, top_value, top_share, top_coverage) of text-like columns; ties by value."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select("x.*")
    counts = written(long.groupBy("column", "value").agg(F.count("*").alias("n")), "level-counts")
    there = F.col("value").isNotNull()
    whole = counts.groupBy("column").agg(F.count_if(there).alias("levels"), F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(~there, F.col("n"))), F.lit(0)).alias("nulls"))
    # The k best of each of many parts first, so that the levels of a column don't meet in one task.
    part = F.pmod(F.xxhash64("value"), F.lit(PARTS))
    best = lambda *keys: F.row_number().over(Window.partitionBy("column", *keys).orderBy(F.desc("n"), "value"))
    some = counts.filter(there).withColumn("part", part).withColumn("r", best("part")).filter(F.col("r") <= k)
    top = some.withColumn("r", best()).filter(F.col("r") <= k).groupBy("column").agg(F.min_by("value", "r").alias("top_value"), F.max("n").alias("top_n"), F.sum("n").alias("covered"))
    out = whole.join(top, "column", "left")
    return out.select("column", "levels", F.try_divide("nulls", "rows").alias("null_rate"), "top_value", F.try_divide("top_n", "rows").alias("top_share"), F.try_divide("covered", "rows").alias("top_coverage"))


def describe_compare(train: DataFrame, test: DataFrame, numeric: str, category: str, ts: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(numeric summary by side, category shares by side, time gap in seconds) of two tables."""
    both = train.select(F.lit("train").alias("side"), numeric, category, ts).unionByName(test.select(F.lit("test").alias("side"), numeric, category, ts))
    summary = both.groupBy("side").agg(F.count(numeric).alias("n"), F.avg(numeric).alias("mean"), F.stddev(numeric).alias("std"), F.min(numeric).alias("low"), F.max(numeric).alias("high"))
    median = exact_quantiles(both, "side", numeric, [0.5]).select("side", F.get("quantiles", F.lit(0)).alias("median"))
    summary = summary.join(median, "side", "left").select("side", "n", "mean", "std", "low", "median", "high")
    shares = both.groupBy("side", category).agg(F.count("*").alias("n")).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("side"))).drop("n")
    at = lambda s, f: f(F.when(F.col("side") == s, F.unix_timestamp(F.col(ts).cast("timestamp"))))
    gap = both.agg((at("test", F.min) - at("train", F.max)).alias("gap_seconds"))
    return summary, shares, gap
