"""Column expressions and row-wise feature projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.clean import CHANNELS, PAYMENT_METHODS

EARTH_KM = 6371.0
PII_FIELDS = ("ip_address", "device_id")
#: Default decision thresholds.
THRESHOLDS = {"approve_max": 0.10, "step_up_max": 0.60, "block_min": 0.90}


def encode_enum(c: Column, values: Sequence[str]) -> Column:
    """Place of the value in the list, from 1; 0 if it is none of them."""
    return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in values]), F.lower(F.trim(c))), F.lit(0)).cast("int")


def amount_bucket(c: Column) -> Column:
    """micro, small, medium, large, high_value; a null amount is high_value, to be looked at."""
    return F.when(c < 10, "micro").when(c < 100, "small").when(c < 500, "medium").when(c < 2000, "large").otherwise("high_value")


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("||", *parts), 256)


def stateless_features(df: DataFrame) -> DataFrame:
    """The features of one event alone: log amount, time, mismatch, bucket, pair and enum indexes."""
    time = F.col("event_time_ts")
    hour, weekday = F.hour(time), F.dayofweek(time)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return df.withColumns(
        {
            "feature_log_amount": F.log1p("amount"),
            "feature_hour_of_day": hour,
            "feature_day_of_week": weekday,
            "feature_is_weekend": flag(weekday.isin(1, 7)),
            "feature_is_night": flag(hour.between(0, 5)),
            "feature_billing_shipping_mismatch": flag(F.col("billing_country") != F.col("shipping_country")),
            "feature_amount_bucket": amount_bucket(F.col("amount")),
            "feature_card_merchant_pair": hashed(F.col("card_id").cast("string"), F.col("merchant_id").cast("string")),
            "feature_payment_method_idx": encode_enum(F.col("payment_method"), PAYMENT_METHODS),
            "feature_channel_idx": encode_enum(F.col("channel"), CHANNELS),
        }
    )


def amount_zscore(amount: Column, mean: Column, deviation: Column) -> Column:
    """Distance from the baseline in deviations; null without a spread."""
    return F.when(deviation > 0, (amount - mean) / deviation)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; null if a coordinate is."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def hash_pii(df: DataFrame, salt: str, fields: Sequence[str] = PII_FIELDS) -> DataFrame:
    """Salted SHA-256 of the fields; null stays null. An empty salt is refused."""
    if not salt:
        raise ValueError("a salt is needed")
    return df.withColumns({c: F.when(F.col(c).isNotNull(), hashed(F.col(c).cast("string"), F.lit(salt))) for c in fields if c in df.columns})


def assert_pii_hashed(df: DataFrame, fraction: float = 0.01, fields: Sequence[str] = PII_FIELDS, seed: int = 42) -> None:
    """Raise if a sampled value isn't a lower-case SHA-256."""
    present = [c for c in fields if c in df.columns]
    raw = [F.count_if(F.col(c).isNotNull() & ~F.col(c).rlike("^[0-9a-f]{64}$")).alias(c) for c in present]
    if present:
        found = (df if fraction >= 1 else df.sample(fraction=fraction, seed=seed)).agg(*raw).first().asDict()
        if any(found.values()):
            raise ValueError(f"values that aren't hashed: { {k: v for k, v in found.items() if v} }")


def mask_ip(c: Column) -> Column:
    return F.concat(F.regexp_extract(c, r"^(\d+\.\d+)", 1), F.lit(".xxx.xxx"))


def mask_device(c: Column) -> Column:
    return F.concat(F.substring(c, 1, 4), F.lit("****"))


def mask_email(c: Column) -> Column:
    return F.concat(F.substring(c, 1, 2), F.lit("***@"), F.regexp_extract(c, "@(.+)$", 1))


MASKS = {"ip_address": mask_ip, "device_id": mask_device, "email": mask_email}


def masked_view(df: DataFrame, privileged: bool = False, masks: Mapping = MASKS) -> DataFrame:
    """The table as a role sees it: raw for privileged ones, else with masked columns."""
    return df if privileged else df.withColumns({c: f(F.col(c).cast("string")) for c, f in masks.items() if c in df.columns})


def classify_decision(p: Column, approve_max: float | Column = 0.10, step_up_max: float | Column = 0.60, block_min: float | Column = 0.90) -> Column:
    """approve below the first bound, step_up below the second, block above the third, else manual_review."""
    p = F.when(p.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))
    return F.when(p < approve_max, "approve").when(p < step_up_max, "step_up").when(p <= block_min, "manual_review").when(p > block_min, "block")


def decide(df: DataFrame, thresholds: DataFrame | None = None, p: str = "fraud_probability") -> DataFrame:
    """Add decision_action and status; thresholds may come from a one-row table."""
    if thresholds is None:
        thresholds = df.sparkSession.createDataFrame([tuple(THRESHOLDS.values())], ", ".join(f"{k} double" for k in THRESHOLDS))
    joined = df.crossJoin(F.broadcast(thresholds.select(*[F.col(k).alias(f"__{k}") for k in THRESHOLDS]).limit(1)))
    action = classify_decision(F.col(p), *[F.col(f"__{k}") for k in THRESHOLDS])
    status = F.when(action.isin("approve", "block"), "COMPLETED").when(action.isNotNull(), "PENDING_ASYNC")
    return joined.withColumns({"decision_action": action, "status": status}).drop(*[f"__{k}" for k in THRESHOLDS])


DECISION_FIELDS = ("transaction_id", "customer_id", "card_id", "amount", "fraud_probability")


def decision_input_check(df: DataFrame) -> DataFrame:
    """Add ``error``: missing or unreadable fields; such rows are decided ``approve_fallback``."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in DECISION_FIELDS]))
    unread = F.array_compact(F.array(*[F.when(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("double").isNull(), F.lit(c)) for c in ("amount", "fraud_probability")]))
    error = F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ","))).when(F.size(unread) > 0, F.concat(F.lit("unreadable: "), F.array_join(unread, ",")))
    p = F.col("fraud_probability").cast("string").try_cast("double")
    return df.withColumns({"error": error, "decision_action": F.when(error.isNotNull(), "approve_fallback").otherwise(classify_decision(p))})


def fallback_score(amount: Column) -> Column:
    """The score by rules alone; an unreadable amount counts as 0."""
    return F.when(amount > 5000, 0.85).when(amount > 1000, 0.40).when(amount > 500, 0.20).otherwise(0.05)


def finite(c: Column) -> Column:
    """The value, and 0 for null, NaN and infinities."""
    c = c.cast("double")
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), 0.0).otherwise(c)


def feature_columns(df: DataFrame, prefix: str = "feature_", drop: Sequence[str] = ("feature_timestamp",)) -> list[str]:
    """The numeric columns of a prefix, in one fixed order, without raw timestamps."""
    return sorted(c for c, t in df.dtypes if c.startswith(prefix) and c not in drop and t not in ("timestamp", "timestamp_ntz", "date", "string"))


def feature_vector(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """An ML vector of the columns, with 0 for what isn't finite."""
    from pyspark.ml.functions import array_to_vector

    return df.withColumn(output, array_to_vector(F.array(*[finite(F.col(c)) for c in columns])))


def risk_tier(rate: Column) -> Column:
    return F.when(rate > 0.05, "high").when(rate > 0.02, "medium").otherwise("low")


def map_category(df: DataFrame, lookup: DataFrame, column: str = "merchant_category") -> DataFrame:
    """``<c>_standard`` by a (raw, standard) table; unmapped values stay. One row a raw value is used."""
    table = lookup.groupBy("raw").agg(F.min("standard").alias("__standard")).withColumnRenamed("raw", "__raw")
    joined = df.join(table, F.lower(F.trim(F.col(column))) == F.col("__raw"), "left")
    return joined.withColumn(f"{column}_standard", F.coalesce("__standard", column)).drop("__raw", "__standard")


def age_days(c: Column, as_of: Column) -> Column:
    """Whole days from a moment to another."""
    return F.datediff(as_of, c)
