"""What streams report of each batch, kept as a table: rows dropped behind the watermark, the watermark, the lag."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.store import Refused, Store

PROGRESS = "stream_id string, run_id string, name string, batch_id long, reported_at timestamp, input_rows long, dropped_rows long, state_rows long, watermark timestamp, newest_event timestamp"


class ProgressTable(StreamingQueryListener):
    """Writes each batch's progress as a small JSON file, named by the run and the batch, so that a report counts once.

    ``spark.streams.addListener(ProgressTable(spark, path))`` starts it. Dropped
    rows are those that stateful operators ignored as older than the watermark; a
    stream without such an operator reports none.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.path, self.store = path, Store(spark, path)
        self.store.fs.mkdirs(self.store.path(path))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        times = dict(p.eventTime or {})
        row = {
            "stream_id": str(p.id), "run_id": str(p.runId), "name": p.name, "batch_id": p.batchId, "reported_at": p.timestamp, "input_rows": p.numInputRows,
            "dropped_rows": sum(s.numRowsDroppedByWatermark for s in p.stateOperators), "state_rows": sum(s.numRowsTotal for s in p.stateOperators), "watermark": times.get("watermark"), "newest_event": times.get("max"),
        }
        try:
            self.store.publish(f"{self.path}/{p.runId}-{p.batchId}.json", json.dumps(row))
        except Refused:  # an idle stream reports its last batch again
            pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """All reports; a run that repeats a batch after a crash has a report of its own."""
    return spark.read.schema(PROGRESS).json(path)


def reported(spark: SparkSession, milliseconds: int = 60_000) -> None:
    """Wait until listeners have been told of everything so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(milliseconds)


def last_reports(progress: DataFrame) -> DataFrame:
    """One report a stream and batch, the last: what a batch dropped counts once, however often it ran."""
    return progress.groupBy("stream_id", "batch_id").agg(F.max_by(F.struct(*[c for c in progress.columns if c not in ("stream_id", "batch_id")]), F.struct("reported_at", "run_id")).alias("x")).select("stream_id", "batch_id", "x.*")


def watermark_drops(progress: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """(name, batches, input_rows, dropped_rows, dropped_share, watermark, newest_event, lag_minutes) of each stream over the hours before ``as_of``.

    The lag is from the newest event seen to ``as_of``. Batches without events have
    no newest one; the watermark is the highest reported.
    """
    at = F.col("reported_at")
    recent = last_reports(progress).filter((at > as_of.cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))) & (at <= as_of.cast("timestamp")))
    sums = recent.groupBy("name").agg(F.count("*").alias("batches"), F.sum("input_rows").alias("input_rows"), F.sum("dropped_rows").alias("dropped_rows"), F.max("watermark").alias("watermark"), F.max("newest_event").alias("newest_event"))
    lag = (F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp("newest_event")) / 60
    return sums.select("name", "batches", "input_rows", "dropped_rows", F.try_divide("dropped_rows", "input_rows").alias("dropped_share"), "watermark", "newest_event", lag.alias("lag_minutes"))
