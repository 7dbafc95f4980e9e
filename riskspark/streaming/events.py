"""The event stream: parse, quarantine, conform, upsert, route, time out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lineage import written
from ..functions.ranges import first_rows
from ..functions.scalars import classify_decision
from ..operators.clean import REQUIRED
from ..operators.graph import build_entity_graph
from ..operators.keyed import insert_keyed
from .batches import commit_batch, newest_before, stream_id

EVENT = T.StructType(
    [
        *[T.StructField(c, T.StringType(), True) for c in ("transaction_id", "schema_version", "event_time", "ingestion_time", "customer_id", "card_id")],
        T.StructField("amount", T.DoubleType(), True),
        *[T.StructField(c, T.StringType(), True) for c in ("currency", "merchant_id", "merchant_category", "payment_method", "device_id", "ip_address")],
        T.StructField("latitude", T.DoubleType(), True), T.StructField("longitude", T.DoubleType(), True),
        *[T.StructField(c, T.StringType(), True) for c in ("billing_country", "shipping_country", "channel")],
        T.StructField("is_recurring", T.BooleanType(), True), T.StructField("session_id", T.StringType(), True), T.StructField("is_fraud", T.BooleanType(), True), T.StructField("is_synthetic", T.BooleanType(), True), T.StructField("source", T.StringType(), True),
    ]
)
WATERMARK = "10 minutes"


def read_event_stream(spark: SparkSession, servers: str, topic: str, group: str | None = None, most: int = 10_000, **options) -> DataFrame:
    """The broker's messages from the earliest on, so many a trigger. Needs the Kafka connector."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", most).options(**options)
    return (reader.option("kafka.group.id", group) if group else reader).load()


def read_table_stream(spark: SparkSession, path: str, schema: T.StructType | str, most_files: int | None = None) -> DataFrame:
    """A stream of a Parquet table's files; files that are rewritten are not read again."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", most_files) if most_files else reader).parquet(path)


def parse_events(raw: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    """The event's fields next to the message's body, time, offset and partition, and ``parse_failed``.

    A permissive parse gives a struct of nulls for text that isn't JSON, so
    failure is an empty body or no required field at all.
    """
    body = F.col("value").cast("string")
    extras = [c for c in ("timestamp", "offset", "partition") if c in raw.columns]
    parsed = raw.select(body.alias("_raw"), *[F.col(c).alias(f"_{c}") for c in extras], F.from_json(body, schema).alias("e"))
    failed = F.col("_raw").isNull() | ~F.greatest(*[F.col(f"e.{c}").isNotNull() for c in REQUIRED if c in schema.names])
    return parsed.select("e.*", "_raw", *[f"_{c}" for c in extras], F.coalesce(failed, F.lit(True)).alias("parse_failed"))


def split_parse_failures(parsed: DataFrame, at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(events, failures); a failure keeps its body and gets a reason, a time and a gate."""
    bad = parsed.filter("parse_failed").select("_raw", F.lit("JSON_PARSE_FAILURE").alias("_rejection_reason"), (F.current_timestamp() if at is None else at).alias("_quarantined_at"), F.lit("stream_to_bronze").alias("_gate"))
    return parsed.filter("not parse_failed").drop("parse_failed"), bad


def bronze_writer(raw: DataFrame, bronze: str, quarantine: str, checkpoint: str, trigger: dict | None = None):
    """One query for both outputs: each batch is parsed once, kept, and written to bronze by date and to quarantine.

    Each output has a folder a batch, so a batch that comes again after a crash, at
    whatever point, leaves both as they are.
    """

    def both(batch: DataFrame, batch_id: int) -> None:
        parsed, own = parse_events(batch).persist(), stream_id(batch)
        good, bad = split_parse_failures(parsed)
        commit_batch(good.withColumn("event_date", F.try_to_timestamp("event_time").cast("date")), bronze, own, batch_id, ["event_date"])
        commit_batch(bad, quarantine, own, batch_id)
        parsed.unpersist()

    return raw.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def upsert_writer(stream: DataFrame, path: str, keys: list[str], checkpoint: str, partition_by: tuple[str, ...] = (), trigger: dict | None = None, buckets: int = 64):
    """Insert rows of new keys only, each batch once, into a table dealt by key; a batch reads the buckets that it touches."""

    def insert(batch: DataFrame, batch_id: int) -> None:
        insert_keyed(batch, path, keys, stream_id(batch), batch_id, buckets, partition_by)

    return stream.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def edges_writer(stream: DataFrame, vertices: str, edges: str, checkpoint: str, trigger: dict | None = None, buckets: int = 64):
    """Vertices, then edges, of each batch, each inserted once; nothing is collected."""

    def insert(batch: DataFrame, batch_id: int) -> None:
        v, e = build_entity_graph(batch)
        insert_keyed(v, vertices, ["id"], stream_id(batch), batch_id, buckets)
        insert_keyed(e, edges, ["src", "dst", "relationship"], stream_id(batch), batch_id, buckets)

    return stream.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 minutes"})).start()


def with_watermark(df: DataFrame, ts: str = "event_time_ts", delay: str = WATERMARK) -> DataFrame:
    """A watermark on the event time, which must be a zoned timestamp."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def deduplicated(df: DataFrame, key: str = "transaction_id", ts: str = "event_time_ts", delay: str = WATERMARK) -> DataFrame:
    """One row a key within the watermark, for sources that deliver at least once."""
    stream = with_watermark(df, ts, delay)
    return stream.dropDuplicatesWithinWatermark([key]) if df.isStreaming else stream.dropDuplicates([key])


def split_late_events(batch: DataFrame, newest, delay: str = WATERMARK, ts: str = "event_time_ts", at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(on time, late) rows against the newest event time seen before this batch; null rows count as on time."""
    late = F.coalesce(F.col(ts) < F.lit(newest) - F.expr(f"INTERVAL {delay}"), F.lit(False)) if newest is not None else F.lit(False)
    stamp = F.current_timestamp() if at is None else at
    return batch.filter(~late), batch.filter(late).withColumns({"_rejection_reason": F.lit("LATE_WATERMARK_DROP"), "_quarantined_at": stamp, "_gate": F.lit("watermark")})


def late_writer(stream: DataFrame, path: str, quarantine: str, checkpoint: str, ts: str = "event_time_ts", delay: str = WATERMARK, trigger: dict | None = None, marks: str | None = None):
    """Write rows on time to ``path`` and late ones to quarantine, each batch once.

    A row is late against the newest time of the batches before its own, of which
    each leaves a mark in ``marks`` (beside the table if not given); the table itself
    is never read.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        kept, own = batch.persist(), stream_id(batch)
        newest = newest_before(kept, marks or f"{path.rstrip('/')}-marks", own, batch_id, ts)
        good, late = split_late_events(kept, newest, delay, ts)
        commit_batch(good, path, own, batch_id)
        commit_batch(late, quarantine, own, batch_id)
        kept.unpersist()

    return stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def route_decisions(batch: DataFrame, p: str = "fraud_probability") -> dict[str, DataFrame]:
    """The outputs of decided rows: cases and audit get all but approvals, step_up its own."""
    decided = batch.withColumn("decision_action", classify_decision(F.col(p)))
    watched = decided.filter("decision_action <> 'approve'")
    return {"cases": watched, "audit": watched, "step_up": watched.filter("decision_action = 'step_up'")}


def route_writer(stream: DataFrame, root: str, checkpoint: str, trigger: dict | None = None, p: str = "fraud_probability", buckets: int = 64):
    """One query that writes every output of each batch, deciding once; one row a transaction, each batch once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept, own = batch.persist(), stream_id(batch)
        for name, df in route_decisions(kept, p).items():
            insert_keyed(df, f"{root}/{name}", ["transaction_id"], own, batch_id, buckets)
        kept.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def step_up_timeouts(requests: DataFrame, answers: DataFrame, as_of: Column, minutes: int = 5, key: str = "case_id") -> DataFrame:
    """(case_id, status, at) of requests by a moment: VERIFIED or FAILED by an answer in time, ESCALATED without one, else PENDING."""
    limit = F.make_dt_interval(mins=F.lit(minutes))
    told = requests.select(key, "requested_at").join(answers.select(key, "status", "answered_at"), key, "left")
    timely = (F.col("answered_at") >= F.col("requested_at")) & (F.col("answered_at") <= F.col("requested_at") + limit) & (F.col("answered_at") <= as_of)
    first = told.groupBy(key, "requested_at").agg(F.min(F.when(timely, F.struct("answered_at", "status"))).alias("x"))
    due = F.col("requested_at") + limit
    status = F.coalesce(F.col("x.status"), F.when(due <= as_of, F.lit("ESCALATED")).otherwise("PENDING"))
    return first.select(key, status.alias("status"), F.coalesce(F.col("x.answered_at"), F.when(due <= as_of, due)).alias("at"))


def step_up_stream(events: DataFrame, minutes: int = 5, delay: str = WATERMARK) -> DataFrame:
    """The same as a stream of (case_id, kind, at) with kind REQUESTED, VERIFIED or FAILED: (case_id, status, at).

    A request sets an event-time timer; an answer clears it; a timer that fires
    escalates. Needs the RocksDB state store.
    """
    from pyspark.sql.streaming import StatefulProcessor

    class StepUp(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.asked = handle.getValueState("asked", "at timestamp")

        def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
            import pandas as pd

            out = []
            for part in rows:
                for row in part.sort_values(["at", "kind"]).itertuples():
                    if row.kind == "REQUESTED":
                        if not self.asked.exists():
                            self.asked.update((row.at.to_pydatetime(),))
                            self.handle.registerTimer(int(row.at.timestamp() * 1000) + minutes * 60_000)
                    elif self.asked.exists():
                        asked = pd.Timestamp(self.asked.get()[0])
                        if row.at <= asked + pd.Timedelta(minutes=minutes):
                            self._clear()
                            out.append((key[0], row.kind, row.at))
            yield pd.DataFrame(out, columns=["case_id", "status", "at"])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
            import pandas as pd

            self._clear()
            yield pd.DataFrame({"case_id": [key[0]], "status": ["ESCALATED"], "at": [pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")]})

        def _clear(self) -> None:
            self.asked.clear()
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)

        def close(self) -> None:
            pass

    stream = with_watermark(events, "at", delay)
    return stream.groupBy("case_id").transformWithStateInPandas(StepUp(), outputStructType="case_id string, status string, at timestamp", outputMode="append", timeMode="eventTime")


def replay_capture(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType | str = "value string") -> DataFrame:
    """The messages of a captured archive, to be parsed again (avro needs its package)."""
    return spark.read.format(fmt).schema(schema).load(path)


def replay_quarantine(quarantine: DataFrame, n: int, parser: Callable[[DataFrame], DataFrame] = parse_events) -> tuple[DataFrame, DataFrame]:
    """(events, still failing) of the n oldest dead letters; a replayed message is marked by its id ``replay_<hash>``.

    The letters are written to the shared folder, so that both outputs are of the same ones.
    """
    oldest = written(first_rows(quarantine, ["_quarantined_at", "_raw"], n), "letters")
    good, bad = split_parse_failures(parser(oldest.select(F.col("_raw").alias("value"))))
    return good.withColumn("replay_id", F.concat(F.lit("replay_"), F.sha2("_raw", 256))), bad
