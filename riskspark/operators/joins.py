"""Joins: identity, as-of features, window families, labels, coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LINEAGE = ("_ingested_at", "_source_file", "_batch_id", "load_date")


def join_identity(txn: DataFrame, identity: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Left join one to one; the right side's lineage columns are dropped."""
    return txn.join(identity.drop(*LINEAGE), key, "left")


def asof_join(
    observations: DataFrame,
    features: DataFrame,
    key: str,
    lookback_seconds: int | None = 86400,
    obs_time: str = "event_time_ts",
    feat_time: str = "feature_timestamp",
    tie: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    bucketed: bool = False,
) -> DataFrame:
    """Each observation row with the newest feature row of its key at or before it.

    A feature older than the lookback doesn't count, both bounds are inclusive,
    and without a match the feature columns are null. ``tie`` orders features of
    equal time, the last one wins. Null keys match nothing; rows are kept each,
    repeated ones too.

    Both sides are merged by key and time and the last feature is carried
    forward: one shuffle, no pair of rows is ever formed. With ``bucketed``
    features are also dealt by time, each to its own and the next stretch of one
    lookback, so that a hot key spreads over tasks.
    """
    taken = list(columns) if columns is not None else [c for c in features.columns if c not in (key, feat_time)]
    payload = F.struct(F.col(feat_time).alias("__t"), *[F.col(c) for c in taken])
    none = F.lit(None)
    ties = [F.col(c) for c in tie]
    obs = observations.select(F.col(key).alias("__k"), F.col(obs_time).alias("__at"), F.lit(1).alias("__side"), F.struct(*observations.columns).alias("__o"))
    feat = features.filter(F.col(key).isNotNull() & F.col(feat_time).isNotNull()).select(
        F.col(key).alias("__k"), F.col(feat_time).alias("__at"), F.lit(0).alias("__side"), payload.alias("__f"), *[c.alias(f"__tie{i}") for i, c in enumerate(ties)]
    )
    keys = ["__k"]
    if bucketed and lookback_seconds:
        at = F.floor(F.unix_timestamp(F.col("__at").cast("timestamp")) / lookback_seconds)
        obs = obs.withColumn("__b", at)
        feat = feat.withColumn("__b", F.explode(F.array(at, at + 1)))
        keys.append("__b")
    both = obs.unionByName(feat, allowMissingColumns=True)
    # Rows without a key can't match, so they are spread instead of meeting in one task.
    spread = F.when(F.col("__k").isNull(), F.xxhash64("__o"))
    order = Window.partitionBy(*keys, spread).orderBy("__at", "__side", *[f"__tie{i}" for i in range(len(ties))]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.col("__f"), ignorenulls=True).over(order)
    found = both.withColumn("__last", last).filter("__side = 1")
    fresh = F.col("__k").isNotNull()
    if lookback_seconds is not None:
        fresh &= F.col("__last.__t") >= F.col("__o")[obs_time] - F.make_dt_interval(secs=F.lit(lookback_seconds))
    return found.select("__o.*", *[F.when(fresh, F.col(f"__last.`{c}`")).otherwise(none).alias(c) for c in taken], F.when(fresh, F.col("__last.__t")).alias(feat_time))


def multi_asof_join(observations: DataFrame, specs: Sequence[tuple], obs_time: str = "event_time_ts", feat_time: str = "feature_timestamp") -> DataFrame:
    """As-of joins in turn; a spec is (features, key) with a day's lookback, or (features, key, seconds).

    Feature times are left out, as the families would clash.
    """
    out = observations
    for spec in specs:
        features, key, lookback = (*spec, 86400)[:3]
        out = asof_join(out, features, key, lookback, obs_time, feat_time).drop(feat_time)
    return out


def merge_families(families: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of window families on entity and time."""
    out = families[0]
    for other in families[1:]:
        out = out.join(other, list(keys), "outer")
    return out


def latest_per_key(df: DataFrame, key: str, order: str, tie: str | None = None) -> DataFrame:
    """One row a key, the latest; ties by ``tie``."""
    by = [F.col(order).desc_nulls_last()] + ([F.col(tie).desc_nulls_last()] if tie else [])
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*by))).filter("__n = 1").drop("__n")


def decisions_with_labels(decisions: DataFrame, labels: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Inner join; labels that are still open (null) are left out."""
    return decisions.join(labels.filter(F.col("is_fraud_reconciled").isNotNull()), key)


def new_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks, one a key. Null keys count as new."""
    return source.dropDuplicates(list(keys)).join(target.select(*keys).distinct(), list(keys), "left_anti")


def key_coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: matched left keys, left only, right only, repeated keys on each side, and coverage."""
    one = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("l"))
    two = right.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("r"))
    both = one.join(two, key, "outer")
    there = F.col("l").isNotNull()
    counts = both.agg(
        F.count_if(there & F.col("r").isNotNull()).alias("matched"), F.count_if(there & F.col("r").isNull()).alias("left_only"), F.count_if(~there).alias("orphans"),
        F.count_if(F.col("l") > 1).alias("left_repeated"), F.count_if(F.col("r") > 1).alias("right_repeated"),
    )
    return counts.withColumn("coverage", F.try_divide("matched", F.col("matched") + F.col("left_only")))


def graph_features(metrics: DataFrame, kind: str = "customer", key: str = "customer_id") -> DataFrame:
    """The metrics of one vertex type, under the entity's own key and as of the end of their day."""
    own = F.col("id").startswith(f"{kind}:")
    ends = F.date_add("snapshot_date", 1).cast("timestamp_ntz")
    return metrics.filter(own).select(F.expr(f"substr(id, {len(kind) + 2})").alias(key), ends.alias("feature_timestamp"), *[c for c in metrics.columns if c not in ("id", "snapshot_date")])


def pagerank_degree_community(rank: DataFrame, degree: DataFrame, component: DataFrame) -> DataFrame:
    """Left joins by vertex."""
    return rank.join(degree, "id", "left").join(component, "id", "left")


def cases_with_decisions(decisions: DataFrame, cases: DataFrame) -> DataFrame:
    """Analyst decisions with their case's transaction."""
    return decisions.join(cases.select("case_id", "transaction_id"), "case_id")


def within_seconds(later: Column, earlier: Column, seconds: int) -> Column:
    """Whether ``earlier`` lies at most so long before ``later``."""
    return (earlier <= later) & (earlier >= later - F.make_dt_interval(secs=F.lit(seconds)))
