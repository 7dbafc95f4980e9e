"""Writing each batch of a stream once: by its own folder, named by the stream and the batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.store import Store


def stream_id(batch: DataFrame) -> str:
    """The id of the stream that this batch belongs to; it stays the same over restarts from one checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def batch_folder(path: str, stream: str, batch_id: int) -> str:
    return f"{path}/stream_id={stream}/batch_id={batch_id}"


def committed(spark: SparkSession, folder: str) -> bool:
    return Store(spark, folder).exists(f"{folder}/_SUCCESS")


def commit_batch(batch: DataFrame, path: str, stream: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write a batch to its own folder of the table at ``path``, unless a run before has finished that.

    A folder that an ended run left half written is replaced. Files of a finished
    batch are never written anew, so streams that read the table see each row once.
    """
    folder = batch_folder(path, stream, batch_id)
    if not committed(batch.sparkSession, folder):
        batch.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)


MARKS = "before timestamp_ntz, after timestamp_ntz"


def newest_before(batch: DataFrame, marks: str, stream: str, batch_id: int, ts: str) -> Column:
    """The newest event time of all batches before this one, null for the first, as a literal.

    Each batch leaves a mark of one row, the newest time before and after it; a batch
    reads the mark of the one before it. A batch that comes again finds its own mark
    and so the same time. The first batch of a stream takes the newest of all marks
    that other streams have left, a row a batch.
    """
    spark = batch.sparkSession
    read = lambda folder: spark.read.schema(MARKS).parquet(folder).agg(F.max("before").alias("before"), F.max("after").alias("after")).first()
    own, last = (batch_folder(marks, stream, n) for n in (batch_id, batch_id - 1))
    if committed(spark, own):
        before = read(own)["before"]
    elif committed(spark, last):
        before = read(last)["after"]
    else:
        before = read(marks)["after"] if Store(spark, marks).exists(marks) else None
    known = F.lit(before).cast("timestamp_ntz")
    mark = batch.agg(F.max(F.col(ts).cast("timestamp_ntz")).alias("t")).select(known.alias("before"), F.greatest("t", known).alias("after"))
    commit_batch(mark.coalesce(1), marks, stream, batch_id)
    return known
