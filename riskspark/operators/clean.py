"""Cleaning of the wide batch table and the canonical event.

Each function adds or replaces its columns in one projection; columns that a
table lacks are skipped.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"
#: Batch times are seconds after this moment (UTC).
ANCHOR_SECONDS = 1735689600
#: Fixed values of the event contract.
SCHEMA_VERSIONS = ("1.0",)
PAYMENT_METHODS = ("credit_card", "debit_card", "prepaid", "wallet", "upi", "bank_transfer")
CHANNELS = ("web", "mobile_app", "pos", "atm", "moto", "recurring")
REQUIRED = ("transaction_id", "schema_version", "event_time", "customer_id", "card_id", "amount", "merchant_id", "payment_method", "channel", "source")


def _snake(name: str) -> str:
    if name.startswith("_"):
        return name
    if name[:2] in ("P_", "R_"):
        return name.lower()
    # A run of capitals at the end (an acronym such as ID or CD) is one word.
    words = re.findall(r"[A-Z]{2,}$|[A-Z]?[^A-Z]+|[A-Z]", name)
    return re.sub(r"_+", "_", "_".join(words)).lower() if words else name


def to_snake_case(df: DataFrame) -> DataFrame:
    """Column names in snake case; names that start with ``_`` stay."""
    return df.toDF(*[_snake(c) for c in df.columns])


def normalise_id_columns(df: DataFrame) -> DataFrame:
    """``id-NN`` becomes ``id_NN``."""
    return df.toDF(*[re.sub(r"^id-(\d+)$", r"id_\1", c) for c in df.columns])


def synthesize_timestamps(df: DataFrame, offset: str = "transaction_dt", anchor: int = ANCHOR_SECONDS) -> DataFrame:
    """event_time, event_date, event_hour and event_day_of_week (0 is the anchor's weekday) from an offset in seconds."""
    seconds, day = F.col(offset), 86400
    time = F.timestamp_seconds(F.lit(anchor) + seconds)
    return df.withColumns(
        {
            "event_time": time,
            "event_date": time.cast("date"),
            "event_hour": F.floor(F.pmod(seconds, F.lit(day)) / 3600).cast("int"),
            "event_day_of_week": F.pmod(F.floor(seconds / day), F.lit(7)).cast("int"),
        }
    )


def fill_categoricals(df: DataFrame, columns: Iterable[str], sentinel: str = UNKNOWN) -> DataFrame:
    """Lower case, trimmed, nulls as the sentinel."""
    return df.withColumns({c: F.coalesce(F.lower(F.trim(F.col(c).cast("string"))), F.lit(sentinel)) for c in columns if c in df.columns})


def null_flags(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``<c>_is_null``, 0 or 1; the values stay as they are."""
    return df.withColumns({f"{c}_is_null": F.col(c).isNull().cast("int") for c in columns if c in df.columns})


def split_email_domain(df: DataFrame, column: str) -> DataFrame:
    """The domain's first part as provider and its last as tld."""
    if column not in df.columns:
        return df
    domain = F.lower(F.trim(F.col(column)))
    parts = F.split(domain, r"\.")
    return df.withColumns({column: domain, f"{column}_provider": F.coalesce(F.element_at(parts, 1), F.lit(UNKNOWN)), f"{column}_tld": F.coalesce(F.element_at(parts, -1), F.lit(UNKNOWN))})


def standardise_card(df: DataFrame, columns: Iterable[str] = ("card4", "card6")) -> DataFrame:
    return df.withColumns({c: F.lower(F.trim(F.col(c))) for c in columns if c in df.columns})


def binarise_match(df: DataFrame) -> DataFrame:
    """M1..M9 (either case): T to 1, F to 0, else null."""
    names = [c for c in df.columns if re.fullmatch(r"[mM][1-9]", c)]
    return df.withColumns({c: F.when(F.col(c) == "T", 1).when(F.col(c) == "F", 0) for c in names})


def amount_features(df: DataFrame, amount: str = "transaction_amt") -> DataFrame:
    """log_amount, amount_cents (cut, not rounded: 19.99 has 98 or 99 as its double has) and is_round_amount."""
    value = F.col(amount)
    return df.withColumns(
        {
            "log_amount": F.log1p(value),
            "amount_cents": (value * 100).cast("long") % 100,
            "is_round_amount": F.coalesce((value == F.floor(value)).cast("int"), F.lit(0)),
        }
    )


def cast_ids(df: DataFrame, columns: Iterable[str] = ("transaction_id", "card1", "card2", "card3", "card5")) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns if c in df.columns})


#: Levels up to which a table of them is broadcast.
MOST_BROADCAST = 100_000


def bucket_rare_levels(df: DataFrame, column: str, k: int, sentinel: str = "rare") -> DataFrame:
    """``<c>_bucket``: the k most frequent levels (ties by level), the rest as the sentinel, null as null.

    The k levels are the only rows broadcast, and only up to ``MOST_BROADCAST``.
    """
    top = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("__n")).orderBy(F.desc("__n"), column).limit(k)
    kept = top.select(F.col(column).alias("__level"))
    joined = df.join(F.broadcast(kept) if k <= MOST_BROADCAST else kept, F.col(column) == F.col("__level"), "left")
    return joined.withColumn(f"{column}_bucket", F.when(F.col(column).isNotNull(), F.coalesce(F.col("__level").cast("string"), F.lit(sentinel)))).drop("__level")


def _within(c: Column, low: float, high: float) -> Column:
    return F.when(c.between(low, high), c)


def conform_event(df: DataFrame) -> DataFrame:
    """The event stream's silver projection; the same for batch and stream.

    Times that don't parse are null; a null or negative amount drops the row;
    places out of range are null; categories are in lower case; a null shipping
    country is the billing country.
    """
    has = set(df.columns)
    out: dict[str, Column] = {}
    if "event_time" in has and "event_time_ts" not in has:
        out["event_time_ts"] = F.try_to_timestamp(F.col("event_time"))
    for c in ("payment_method", "channel", "merchant_category", "currency"):
        if c in has:
            out[c] = F.lower(F.trim(F.col(c)))
    if "device_id" in has:
        out["device_id"] = F.coalesce(F.col("device_id").cast("string"), F.lit(UNKNOWN))
    if "shipping_country" in has:
        out["shipping_country"] = F.coalesce("shipping_country", "billing_country")
    for c, bound in (("latitude", 90.0), ("longitude", 180.0)):
        if c in has:
            out[c] = _within(F.col(c), -bound, bound)
    df = df.withColumns(out).filter("amount >= 0")
    time = F.col("event_time_ts")
    return df.withColumns({"event_date": time.cast("date"), "event_hour": F.hour(time), "event_day": F.dayofweek(time)})


def validate_event(df: DataFrame) -> DataFrame:
    """Add ``reasons``: the contract's rules that the row breaks, an empty array if none."""
    has = set(df.columns)

    def rule(name: str, broken: Column) -> Column:
        return F.when(F.coalesce(broken, F.lit(False)), F.lit(name))

    rules = [rule(f"MISSING_{c.upper()}", F.col(c).isNull() if c in has else F.lit(True)) for c in REQUIRED]
    rules += [rule(f"INVALID_{c.upper()}", ~F.col(c).isin(*allowed)) for c, allowed in (("schema_version", SCHEMA_VERSIONS), ("payment_method", PAYMENT_METHODS), ("channel", CHANNELS)) if c in has]
    rules += [rule("NEGATIVE_AMOUNT", F.col("amount") < 0)] if "amount" in has else []
    rules += [rule(f"{c.upper()}_OUT_OF_RANGE", ~F.col(c).between(-b, b)) for c, b in (("latitude", 90.0), ("longitude", 180.0)) if c in has]
    if "event_time" in has:
        rules.append(rule("BAD_EVENT_TIME", F.col("event_time").isNotNull() & F.try_to_timestamp(F.col("event_time").cast("string")).isNull()))
    return df.withColumn("reasons", F.array_compact(F.array(*rules)))


def derived_batch_flags(df: DataFrame) -> DataFrame:
    """is_weekend (day 5 or 6), is_night (hours 0 to 5), has_identity (a device type is known)."""
    return df.withColumns(
        {
            "is_weekend": F.coalesce(F.col("event_day_of_week").isin(5, 6), F.lit(False)).cast("int"),
            "is_night": F.coalesce(F.col("event_hour").between(0, 5), F.lit(False)).cast("int"),
            "has_identity": F.col("device_type").isNotNull().cast("int"),
        }
    )


def impute_constants(df: DataFrame, numeric: Iterable[str] = (), match: Iterable[str] = (), flags: Iterable[str] = ()) -> DataFrame:
    """Nulls as -999 in numeric columns, -1 in match columns and 0 in flags."""
    values = {c: -999 for c in numeric} | {c: -1 for c in match} | {c: 0 for c in flags}
    return df.fillna({c: v for c, v in values.items() if c in df.columns})
