"""Row gates and table checks.

Rules are three-valued: a rule that is null counts as not broken, and nulls have
rules of their own, so that clean and rejected rows add up to all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Products of the wide table.
PRODUCTS = ("W", "H", "C", "S", "R")


def wide_reject_rules(key: str = "transaction_id", amount: str = "transaction_amt", offset: str = "transaction_dt", label: str = "is_fraud", product: str = "product_cd", products: Sequence[str] = PRODUCTS) -> dict[str, Column]:
    """The hard rules of the wide table."""
    return {
        "NULL_TRANSACTION_ID": F.col(key).isNull(),
        "NULL_AMOUNT": F.col(amount).isNull(),
        "NON_POSITIVE_AMOUNT": F.col(amount) <= 0,
        "NULL_TRANSACTION_DT": F.col(offset).isNull(),
        "NEGATIVE_TRANSACTION_DT": F.col(offset) < 0,
        "NULL_LABEL": F.col(label).isNull(),
        "INVALID_PRODUCT_CD": F.col(product).isNull() | ~F.col(product).isin(*products),
    }


def with_reasons(df: DataFrame, rules: Mapping[str, Column], output: str) -> DataFrame:
    return df.withColumn(output, F.concat_ws("; ", *[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()]))


def reject_rows(df: DataFrame, rules: Mapping[str, Column], gate: str = "bronze_to_silver", at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected); rejected rows carry _rejection_reason, _quarantined_at and _gate."""
    judged = with_reasons(df, rules, "_rejection_reason")
    rejected = judged.filter("_rejection_reason <> ''").withColumns({"_quarantined_at": F.current_timestamp() if at is None else at, "_gate": F.lit(gate)})
    return judged.filter("_rejection_reason = ''").drop("_rejection_reason"), rejected


def flag_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add _quality_flags; no row is dropped."""
    return with_reasons(df, rules, "_quality_flags")


def gate_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """total_rows, clean_rows, rejected_rows and rejection_rate, in one scan."""
    judged = with_reasons(df, rules, "_rejection_reason")
    bad = F.col("_rejection_reason") != ""
    return judged.agg(F.count("*").alias("total_rows"), F.count_if(~bad).alias("clean_rows"), F.count_if(bad).alias("rejected_rows")).withColumn("rejection_rate", F.coalesce(F.try_divide("rejected_rows", "total_rows"), F.lit(0.0)))


@dataclass(frozen=True)
class Check:
    """A ratio of rows and the values of it that pass."""

    name: str
    level: str
    ratio: Column
    passes: Callable[[Column], Column]


def satisfies(name: str, condition: Column, low: float = 1.0, high: float = 1.0, level: str = "Error") -> Check:
    """The share of rows for which the condition holds lies within the bounds; null doesn't hold. No rows: 1."""
    ratio = F.coalesce(F.try_divide(F.count_if(condition), F.count("*")), F.lit(1.0))
    return Check(name, level, ratio, lambda x: (x >= low) & (x <= max(high, low)))


def is_complete(c: str, level: str = "Error") -> Check:
    return satisfies(f"complete({c})", F.col(c).isNotNull(), level=level)


def has_completeness(c: str, low: float, level: str = "Warning") -> Check:
    return satisfies(f"completeness({c})", F.col(c).isNotNull(), low, level=level)


def is_non_negative(c: str, level: str = "Error") -> Check:
    return satisfies(f"non_negative({c})", F.col(c).isNull() | (F.col(c) >= 0), level=level)


def is_contained_in(c: str, values: Sequence, low: float = 1.0, level: str = "Error") -> Check:
    return satisfies(f"contained({c})", F.col(c).isNull() | F.col(c).isin(*values), low, level=level)


def uniqueness(df: DataFrame, c: str, level: str = "Error") -> DataFrame:
    """One row for the check that no value of ``c`` repeats; value is the share of values that don't."""
    counts = df.filter(F.col(c).isNotNull()).groupBy(c).count()
    value = F.coalesce(F.try_divide(F.count_if(F.col("count") == 1), F.count("*")), F.lit(1.0))
    return counts.agg(value.alias("value")).select(F.lit(f"unique({c})").alias("check"), F.lit(level).alias("level"), "value", (F.col("value") == 1.0).alias("passed"))


def run_checks(df: DataFrame, checks: Sequence[Check], unique: Sequence[str] = ()) -> DataFrame:
    """(check, level, value, passed): all ratio checks in one aggregate, uniqueness apart."""
    row = df.agg(*[c.ratio.alias(f"r{i}") for i, c in enumerate(checks)])
    results = [F.struct(F.lit(c.name).alias("check"), F.lit(c.level).alias("level"), F.col(f"r{i}").alias("value"), c.passes(F.col(f"r{i}")).alias("passed")) for i, c in enumerate(checks)]
    out = row.select(F.explode(F.array(*results)).alias("x")).select("x.*")
    for c in unique:
        out = out.unionByName(uniqueness(df, c))
    return out


def wide_error_checks() -> list[Check]:
    return [
        is_complete("transaction_id"), is_non_negative("transaction_amt"), satisfies("amount_positive", F.col("transaction_amt") > 0, 0.999),
        is_contained_in("product_cd", PRODUCTS), is_contained_in("is_fraud", (0, 1)),
    ]


def silver_checks(fraud_bounds: tuple[float, float] = (0.0, 1.0)) -> list[Check]:
    """Checks after cleaning; prevalence is a warning, as it differs by source."""
    complete = [is_complete(c) for c in ("transaction_id", "event_date", "product_cd", "card4", "card6", "log_amount")]
    return [*complete, is_non_negative("log_amount"), is_contained_in("is_fraud", (0, 1)), satisfies("fraud_prevalence", F.col("is_fraud") == 1, *fraud_bounds, level="Warning")]


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, size, completeness, distinct, mean, deviation, low, high) in one aggregate; the last four of numbers only."""
    numeric = {c for c, t in df.dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint") or t.startswith("decimal")}
    sums = []
    for i, c in enumerate(columns):
        x, none = F.col(c), F.lit(None).cast("double")
        sums += [F.count(x).alias(f"n{i}"), F.count_distinct(x).alias(f"d{i}")]
        sums += [(f(x).cast("double") if c in numeric else F.max(none)).alias(f"{k}{i}") for k, f in (("m", F.avg), ("s", F.stddev), ("l", F.min), ("h", F.max))]
    row = df.agg(F.count("*").alias("size"), *sums)
    parts = [
        F.struct(F.lit(c).alias("column"), F.col("size"), F.try_divide(f"n{i}", "size").alias("completeness"), F.col(f"d{i}").alias("distinct"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("deviation"), F.col(f"l{i}").alias("low"), F.col(f"h{i}").alias("high"))
        for i, c in enumerate(columns)
    ]
    return row.select(F.explode(F.array(*parts)).alias("x")).select("x.*")


def validate_silver(df: DataFrame, key: str = "transaction_id", label: str = "is_fraud", bounds: tuple[float, float] = (0.0001, 0.10)) -> DataFrame:
    """One row: rows, distinct keys, fraud rate, and whether each passes; the rate only warns."""
    row = df.agg(F.count("*").alias("rows"), F.count_distinct(key).alias("keys"), F.avg(F.col(label).cast("double")).alias("fraud_rate"))
    return row.select("*", (F.col("rows") > 0).alias("not_empty"), (F.col("rows") == F.col("keys")).alias("unique_key"), F.coalesce(F.col("fraud_rate").between(*bounds), F.lit(False)).alias("rate_in_band"))


def layer_checks(layers: Mapping[str, DataFrame], label: str = "is_fraud") -> DataFrame:
    """(layer, rows, fraud_rate, passed) of each layer's table; a layer passes if it has rows."""
    out = None
    for name, df in layers.items():
        rate = F.avg(F.col(label).cast("double")) if label in df.columns else F.lit(None).cast("double")
        own = df.agg(F.count("*").alias("rows"), F.max(F.lit(None).cast("double")).alias("x") if label not in df.columns else rate.alias("x")).select(F.lit(name).alias("layer"), "rows", F.col("x").alias("fraud_rate"), (F.col("rows") > 0).alias("passed"))
        out = own if out is None else out.unionByName(own)
    return out


def duplicate_audit(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """rows, distinct keys and duplicates; null keys count as one value."""
    keyed = df.groupBy(key).agg(F.count("*").alias("n"))
    return keyed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("keys")).withColumn("duplicates", F.col("rows") - F.col("keys"))
