"""Grouped measures (gold tables, baselines, monitoring figures)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import SKETCH_LG_K


def _median(c: Column, exact: bool) -> Column:
    return F.percentile(c, 0.5) if exact else F.percentile_approx(c, 0.5)


def daily_fraud_summary(df: DataFrame, amount: str = "amount", exact: bool = False) -> DataFrame:
    """Thirteen measures a day: volumes, fraud rate, amounts by class, reach."""
    fraud, value = F.col("is_fraud") == 1, F.col(amount)
    return (
        df.groupBy("event_date")
        .agg(
            F.count("*").alias("total_transactions"),
            F.count_if(fraud).alias("fraud_transactions"),
            F.sum(value).alias("total_amount"),
            F.sum(F.when(fraud, value)).alias("fraud_amount"),
            F.avg(value).alias("avg_amount"),
            F.avg(F.when(fraud, value)).alias("avg_fraud_amount"),
            F.avg(F.when(~fraud, value)).alias("avg_legit_amount"),
            F.max(value).alias("max_amount"),
            F.max(F.when(fraud, value)).alias("max_fraud_amount"),
            _median(value, exact).alias("median_amount"),
            F.count_distinct("card_id").alias("unique_cards"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
        .withColumn("fraud_rate", F.try_divide("fraud_transactions", "total_transactions"))
    )


def hourly_stats(df: DataFrame, amount: str = "amount", hour: str = "event_hour") -> DataFrame:
    """Counts, fraud, amounts by date and hour."""
    fraud, value = F.col("is_fraud") == 1, F.col(amount)
    out = df.groupBy("event_date", hour).agg(F.count("*").alias("txn_count"), F.count_if(fraud).alias("fraud_count"), F.sum(value).alias("total_amount"), F.avg(value).alias("avg_amount"))
    return out.withColumn("fraud_rate", F.try_divide("fraud_count", "txn_count"))


def risk_by(df: DataFrame, *groups: str, amount: str = "transaction_amt") -> DataFrame:
    """Counts, fraud rate, amounts of any grouping (product, card network and type), with a risk tier."""
    from ..functions.scalars import risk_tier

    fraud, value = F.col("is_fraud") == 1, F.col(amount)
    out = df.groupBy(*groups).agg(F.count("*").alias("total_transactions"), F.count_if(fraud).alias("fraud_transactions"), F.avg(value).alias("avg_amount"), F.sum(F.when(fraud, value)).alias("fraud_amount"))
    out = out.withColumn("fraud_rate", F.try_divide("fraud_transactions", "total_transactions"))
    return out.withColumn("risk_tier", risk_tier(F.col("fraud_rate")))


def rollup_by_time(df: DataFrame, amount: str = "amount", hour: str = "event_hour") -> DataFrame:
    """Hour, day and grand totals in one pass; ``level`` is 0 for hours, 1 for days, 3 for the total."""
    return df.rollup("event_date", hour).agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("txn_count"), F.sum(amount).alias("total_amount"))


def customer_baselines(df: DataFrame, as_of: Column, days: int = 90, key: str = "customer_id", amount: str = "amount", ts: str = "event_time_ts", exact: bool = False) -> DataFrame:
    """Amount statistics and tenure of each customer over the days before ``as_of``, for that day's snapshot."""
    recent = df.filter((F.col(ts) >= as_of - F.make_dt_interval(days=F.lit(days))) & (F.col(ts) <= as_of))
    value = F.col(amount)
    return recent.groupBy(key).agg(
        F.avg(value).alias("avg_amount"), F.coalesce(F.stddev(value), F.lit(0.0)).alias("std_amount"), F.count("*").alias("txn_count"), _median(value, exact).alias("median_amount"),
        F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.datediff(F.max(ts), F.min(ts)).alias("tenure_days"), F.max(as_of.cast("date")).alias("snapshot_date"),
    )


def merchant_risk(df: DataFrame, as_of: Column, days: int = 30, key: str = "merchant_id", amount: str = "amount", ts: str = "event_time_ts") -> DataFrame:
    """Ticket, volume and fraud ratio of each merchant over the days before ``as_of``."""
    recent = df.filter((F.col(ts) >= as_of - F.make_dt_interval(days=F.lit(days))) & (F.col(ts) <= as_of))
    out = recent.groupBy(key).agg(F.avg(amount).alias("avg_ticket"), F.count("*").alias("txn_count"), F.count_if(F.col("is_fraud") == 1).alias("fraud_count"), F.max(as_of.cast("date")).alias("snapshot_date"))
    return out.withColumn("fraud_ratio", F.coalesce(F.try_divide("fraud_count", "txn_count"), F.lit(0.0)))


def lateness_distribution(df: DataFrame, arrived: Column, happened: Column, exact: bool = False) -> DataFrame:
    """Seconds from event to arrival: count, mean, deviation, extremes, quantiles."""
    late = F.unix_timestamp(arrived.cast("timestamp")) - F.unix_timestamp(happened.cast("timestamp"))
    points = [0.5, 0.9, 0.95, 0.99]
    quantiles = [F.percentile("late", p) if exact else F.percentile_approx("late", p) for p in points]
    return df.select(late.alias("late")).agg(
        F.count("late").alias("events"), F.avg("late").alias("mean_late"), F.stddev("late").alias("std_late"), F.min("late").alias("min_late"), F.max("late").alias("max_late"),
        *[q.alias(f"p{round(100 * p)}_late") for p, q in zip(points, quantiles, strict=True)],
    )


def partition_skew(df: DataFrame, partition: Column) -> DataFrame:
    """Rows by partition, then their mean, deviation, extremes and the ratio of those."""
    counts = df.groupBy(partition.alias("p")).agg(F.count("*").alias("n"))
    out = counts.agg(F.avg("n").alias("avg_rows"), F.stddev("n").alias("std_rows"), F.max("n").alias("max_rows"), F.min("n").alias("min_rows"))
    return out.withColumn("skew_ratio", F.try_divide("max_rows", "min_rows"))


def model_kpis(df: DataFrame, *groups: str, score: str = "fraud_probability", label: str = "is_fraud_reconciled", cut: float = 0.5, exact: bool = False) -> DataFrame:
    """Confusion counts at the cut, score statistics, precision, recall and false-positive rate."""
    above, fraud, legit = F.col(score) >= cut, F.col(label) == 1, F.col(label) == 0
    quantile = F.percentile if exact else F.percentile_approx
    out = df.groupBy(*groups).agg(
        F.count("*").alias("total_scored_labeled"), F.count_if(fraud).alias("actual_fraud_count"), F.count_if(above & fraud).alias("true_positives"), F.count_if(above & legit).alias("false_positives"),
        F.count_if(~above & fraud).alias("false_negatives"), F.count_if(~above & legit).alias("true_negatives"), F.avg(score).alias("avg_fraud_score"),
        quantile(F.col(score), 0.5).alias("median_fraud_score"), quantile(F.col(score), 0.95).alias("p95_fraud_score"),
    )
    tp, fp, fn, tn = (F.col(x) for x in ("true_positives", "false_positives", "false_negatives", "true_negatives"))
    return out.withColumns({"precision": F.try_divide(tp, tp + fp), "recall": F.try_divide(tp, tp + fn), "false_positive_rate": F.try_divide(fp, fp + tn)})


def production_telemetry(kpis: DataFrame, as_of: Column, recent_days: int = 2, baseline_days: int = 14, day: str = "kpi_date") -> DataFrame:
    """Rates of the last days against the days before them (no day is in both), in one scan."""
    start = F.date_sub(as_of, recent_days)
    recent = (F.col(day) > start) & (F.col(day) <= as_of)
    before = (F.col(day) > F.date_sub(as_of, recent_days + baseline_days)) & (F.col(day) <= start)
    sums = []
    for name, window in (("recent", recent), ("baseline", before)):
        total = lambda c: F.sum(F.when(window, F.col(c)))  # noqa: B023, E731
        sums += [
            F.try_divide(total("false_positives"), total("false_positives") + total("true_negatives")).alias(f"{name}_fpr"),
            F.try_divide(total("true_positives"), total("true_positives") + total("false_negatives")).alias(f"{name}_recall"),
            F.avg(F.when(window, F.col("avg_fraud_score"))).alias(f"{name}_avg_score"),
        ]
    return kpis.agg(*sums)


def freshness(df: DataFrame, as_of: Column, ts: str = "event_time_ts") -> DataFrame:
    """Newest event and its age in minutes."""
    newest = F.max(ts)
    age = (F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp(newest.cast("timestamp"))) / 60
    return df.agg(newest.alias("newest_event"), age.alias("age_minutes"))


def late_drops(quarantine: DataFrame, as_of: Column, hours: int = 24, reason: str = "LATE_WATERMARK_DROP") -> DataFrame:
    """Rows quarantined for lateness in the hours before ``as_of``."""
    recent = (F.col("_quarantined_at") > as_of - F.make_dt_interval(hours=F.lit(hours))) & (F.col("_quarantined_at") <= as_of)
    return quarantine.agg(F.count_if(recent & (F.col("_rejection_reason") == reason)).alias("late_drops"))


def shadow_delta_summary(df: DataFrame, champion: str = "champion", challenger: str = "challenger") -> DataFrame:
    """Differences of two models' scores; a negative score is an error and left out."""
    valid = (F.col(champion) >= 0) & (F.col(challenger) >= 0)
    delta = F.when(valid, F.col(challenger) - F.col(champion))
    return df.agg(F.count_if(valid).alias("valid"), F.count_if(~valid).alias("errors"), F.avg(delta).alias("mean_delta"), F.stddev(delta).alias("std_delta"), F.max(F.abs(delta)).alias("max_abs_delta"))


def label_source_counts(labels: DataFrame) -> DataFrame:
    return labels.groupBy("label_source").agg(F.count("*").alias("labels"), F.count("is_fraud_reconciled").alias("settled"))


def distinct_counts(df: DataFrame, *columns: str, exact: bool = True) -> DataFrame:
    """One row: distinct values of each column, exactly or by sketch."""
    count = F.count_distinct if exact else F.approx_count_distinct
    return df.agg(*[count(c).alias(f"distinct_{c}") for c in columns])


def distinct_sketches(df: DataFrame, columns: Sequence[str], *groups: str, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """(groups..., rows, <column>_sketch...): a day's distinct values as sketches, to be stored a day and united later.

    ``groups`` name the day and whatever else is asked for, such as a customer. A
    column without values has a null sketch.
    """
    return df.groupBy(*groups).agg(F.count("*").alias("rows"), *[F.hll_sketch_agg(F.col(c), lg_k).alias(f"{c}_sketch") for c in columns])


def united_distinct(sketches: DataFrame, columns: Sequence[str], *groups: str) -> DataFrame:
    """(groups..., rows, distinct_<column>...) of stored sketches: counts over any days, none of whose rows is read again.

    The relative error is about 1.04 / sqrt(2^lg_k) of the sketches, whatever number
    of them is united; small counts are exact.
    """
    return sketches.groupBy(*groups).agg(F.sum("rows").alias("rows"), *[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")), F.lit(0)).alias(f"distinct_{c}") for c in columns])


def distinct_as_of(sketches: DataFrame, columns: Sequence[str], as_of: Column, days: int, *groups: str, day: str = "event_date") -> DataFrame:
    """``united_distinct`` of the ``days`` whole days before ``as_of``."""
    last = as_of.cast("date")
    return united_distinct(sketches.filter((F.col(day) < last) & (F.col(day) >= F.date_sub(last, days))), columns, *groups)


def event_type_daily_counts(df: DataFrame, kind: str = "event_type", ts: str = "created_at") -> DataFrame:
    return df.groupBy(kind, F.col(ts).cast("date").alias("day")).agg(F.count("*").alias("events"))
