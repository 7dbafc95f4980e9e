"""Keyed maintenance of Parquet tables.

Plain Parquet has no MERGE. An insert appends what an anti join leaves; an
upsert of partitioned snapshots overwrites the partitions it touches; an upsert
of single rows writes a new version of the table beside the old one and then
publishes a pointer to it, so that readers never see half of it. ``keyed`` has
tables that rewrite only the files an upsert touches.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.store import Refused, Store
from .joins import new_rows

#: Partition values that may reach the driver as a filter.
FEW_PARTITIONS = 1000


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after inserting source rows of new keys, one a key."""
    return target.unionByName(new_rows(source, target, keys), allowMissingColumns=True)


def append_new(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Append source rows of new keys to the table at ``path``, which may not exist yet. Twice is as once."""
    fresh = source.dropDuplicates(list(keys))
    if exists(spark, path):
        fresh = new_rows(source, spark.read.parquet(path), keys)
    fresh.write.mode("append").partitionBy(*partition_by).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder has files of a table, in any store that Spark reads."""
    return any(not n.startswith(("_", ".")) for n in Store(spark, path).names(path))


def assert_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key repeats: which row wins would be left to chance."""
    if not source.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"source rows repeat a key of {list(keys)}")


def upsert_all(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after updating all columns of known keys and inserting the rest."""
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def overwrite_partitions(source: DataFrame, path: str, keys: Sequence[str], partition: str = "snapshot_date") -> None:
    """Upsert whole rows where the partition column is part of the key: touched partitions are rewritten.

    Known keys that the source lacks stay, so rows of those partitions are read
    back first, and of no other while the source touches at most ``FEW_PARTITIONS``;
    beyond that a join picks them.
    """
    if partition not in keys:
        raise ValueError("the partition column must be part of the key")
    assert_unique(source, keys)
    spark = source.sparkSession
    if exists(spark, path):
        from ..functions.lineage import written

        touched, table = source.select(partition).distinct(), spark.read.parquet(path)
        few = [r[0] for r in touched.limit(FEW_PARTITIONS + 1).collect()]
        mine = table.filter(F.col(partition).isin(few)) if len(few) <= FEW_PARTITIONS else table.join(touched, partition, "left_semi")
        source = written(upsert_all(mine, source, keys), "merged")
    source.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def upsert_if(target: DataFrame, source: DataFrame, keys: Sequence[str], condition: Column) -> DataFrame:
    """The table after updating known keys where ``condition`` holds, and inserting the rest.

    The condition reads the columns ``t.<c>`` and ``s.<c>``; null is false.
    """
    columns = target.columns
    t, s = (df.select(*keys, F.struct(*columns).alias(name)) for df, name in ((target, "t"), (source, "s")))
    both = t.join(s, list(keys), "outer")
    take = F.col("t").isNull() | (F.col("s").isNotNull() & F.coalesce(condition, F.lit(False)))
    return both.select(F.when(take, F.col("s")).otherwise(F.col("t")).alias("x")).select("x.*")


def labels_condition() -> Column:
    """A label is replaced by a surer one, or filled in by an equally sure one once it is settled."""
    surer = F.col("s.label_confidence") > F.col("t.label_confidence")
    filled = F.col("t.is_fraud_reconciled").isNull() & F.col("s.is_fraud_reconciled").isNotNull() & (F.col("s.label_confidence") == F.col("t.label_confidence"))
    return surer | filled


def upsert_set(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The table after setting the named columns of known keys and inserting the rest."""
    names = target.columns
    t, s = (df.select(*keys, F.struct(*names).alias(name)) for df, name in ((target, "t"), (source, "s")))
    both = t.join(s, list(keys), "outer")
    return both.select(*[F.when(F.col("t").isNull() | (F.col("s").isNotNull() & F.lit(c in columns)), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in names])


def write_version(df: DataFrame, root: str, version: int) -> str:
    """Write a new version of a table and point to it; ``Refused`` if another writer took that number."""
    name, store = f"v{version}-{uuid.uuid4().hex}", Store(df.sparkSession, root)
    df.write.parquet(f"{root}/{name}")
    store.fs.mkdirs(store.path(f"{root}/pointer"))
    try:
        store.publish(f"{root}/pointer/{version:020d}", name)
    except Refused:
        store.delete(f"{root}/{name}")
        raise
    return f"{root}/{name}"


def read_version(spark: SparkSession, root: str) -> DataFrame:
    """The table's newest version."""
    store = Store(spark, root)
    newest = [n for n in store.names(f"{root}/pointer") if not n.startswith(".")][-1]
    return spark.read.parquet(f"{root}/{store.read(f'{root}/pointer/{newest}')}")


CASE_SET = ("fraud_probability", "scoring_mode", "decision_action", "model_version", "updated_at")


def upsert_cases(cases: DataFrame, decisions: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
    """(cases, events) after a batch of decisions.

    A case is one transaction's; a known one takes the decision's score, mode,
    action and version, a new one opens. Of several decisions of a transaction in
    the batch the surest counts. Each gives one event.
    """
    rank = F.struct("fraud_probability", "decision_action")
    columns = [c for c in decisions.columns if c != "transaction_id"]
    fresh = decisions.filter(F.col("transaction_id").isNotNull()).groupBy("transaction_id").agg(F.max_by(F.struct(*columns), rank).alias("d")).select("transaction_id", "d.*")
    known = cases.select("transaction_id", F.lit(True).alias("known"))
    judged = fresh.join(known, "transaction_id", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    body = F.to_json(F.struct("decision_action", "fraud_probability", "scoring_mode"))
    case_id = F.sha2(F.concat(F.lit("case:"), F.col("transaction_id").cast("string")), 256)
    events = judged.select(case_id.alias("case_id"), F.when(F.col("known"), "MODEL_SCORE_UPDATED").otherwise("CASE_CREATED").alias("event_type"), body.alias("event_data"), F.lit("SYSTEM").alias("created_by"), at.alias("created_at"))
    opened = fresh.select("*", case_id.alias("case_id"), F.lit("OPEN").alias("case_status"), at.alias("created_at"), at.alias("updated_at"))
    return upsert_set(cases, opened.select(*cases.columns), ["transaction_id"], [c for c in CASE_SET if c in cases.columns]), events


def update_case_status(cases: DataFrame, updates: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
    """(cases, events) after status updates (case_id, new_status, updated_by, notes); unknown cases are left out."""
    joined = cases.join(updates, "case_id", "left")
    changed = F.col("new_status").isNotNull()
    after = joined.select(*[{"case_status": F.coalesce("new_status", "case_status"), "updated_at": F.when(changed, at).otherwise(F.col("updated_at"))}.get(c, F.col(c)).alias(c) for c in cases.columns])
    body = F.to_json(F.struct(F.col("case_status").alias("old_status"), "new_status", "notes"))
    events = joined.filter(changed).select("case_id", F.lit("STATUS_CHANGED").alias("event_type"), body.alias("event_data"), F.col("updated_by").alias("created_by"), at.alias("created_at"))
    return after, events


def case_state_from_events(events: DataFrame, tie: str = "event_data") -> DataFrame:
    """(case_id, status, since) from the newest event that sets a status."""
    created = F.when(F.col("event_type") == "CASE_CREATED", F.lit("OPEN"))
    status = F.coalesce(F.get_json_object("event_data", "$.new_status"), created)
    return events.withColumn("status", status).filter("status is not null").groupBy("case_id").agg(F.max_by("status", F.struct("created_at", tie)).alias("status"), F.max("created_at").alias("since"))
