"""Labels from chargebacks, analysts and time; training sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATURE_DAYS = 30


def reconcile_labels(txn: DataFrame, chargebacks: DataFrame, analyst: DataFrame, as_of: Column, mature_days: int = MATURE_DAYS) -> DataFrame:
    """The label of each transaction as of a day.

    A chargeback is fraud, for sure; then an analyst's word, where a legitimate
    one counts only once the transaction is mature; then maturity alone; else the
    label is open. Of several chargebacks one counts, of several analyst
    decisions the latest.
    """
    charged = chargebacks.select("transaction_id").distinct().withColumn("charged", F.lit(True))
    said = analyst.groupBy("transaction_id").agg(F.max_by("decision_result", F.struct("decided_at", "decision_result")).alias("said"))
    mature = F.datediff(as_of, F.col("event_date")) >= mature_days
    charged_, said_ = F.col("charged").isNotNull(), F.col("said")
    label = F.when(charged_ | (said_ == "CONFIRMED_FRAUD"), 1).when((said_ == "CONFIRMED_LEGIT") & mature, 0).when(said_.isNull() & mature, 0)
    source = (
        F.when(charged_, "CHARGEBACK").when(said_ == "CONFIRMED_FRAUD", "ANALYST_CONFIRMED_FRAUD").when(said_ == "CONFIRMED_LEGIT", "ANALYST_CONFIRMED_LEGIT").when(mature, "AUTO_MATURED_LEGIT").otherwise("MATURING")
    )
    sure = F.when(charged_, 1.0).when(said_.isNotNull(), 0.9).when(mature, 0.7).otherwise(0.0)
    joined = txn.join(charged, "transaction_id", "left").join(said, "transaction_id", "left")
    return joined.withColumns({"is_fraud_reconciled": label, "label_source": source, "label_confidence": sure}).drop("charged", "said")


def training_set_guards(labels: DataFrame, least: int = 1000, rates: tuple[float, float] = (0.001, 0.30), sure: float = 0.7) -> DataFrame:
    """One row: usable labels, fraud rate, and whether both allow training."""
    usable = F.col("is_fraud_reconciled").isNotNull() & (F.col("label_confidence") >= sure)
    row = labels.agg(F.count_if(usable).alias("labels"), F.avg(F.when(usable, F.col("is_fraud_reconciled").cast("double"))).alias("fraud_rate"))
    enough, plausible = F.col("labels") >= least, F.coalesce(F.col("fraud_rate").between(*rates), F.lit(False))
    return row.select("*", enough.alias("enough"), plausible.alias("plausible"), (enough & plausible).alias("can_train"))


def class_weights(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    """Weight positives by negatives / positives, negatives by 1; broadcasts one number."""
    ratio = df.agg(F.coalesce(F.try_divide(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)), F.lit(1.0)).alias("__ratio"))
    return df.crossJoin(F.broadcast(ratio)).withColumn(output, F.when(F.col(label) == 1, F.col("__ratio")).otherwise(1.0)).drop("__ratio")


def training_snapshot(df: DataFrame, columns: list[str], path: str, fraction: float = 1.0, seed: int = 42) -> None:
    """Write the reference table that drift is measured against."""
    taken = df.select(*columns)
    (taken if fraction >= 1 else taken.sample(fraction=fraction, seed=seed)).write.mode("overwrite").parquet(path)
