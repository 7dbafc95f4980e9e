"""Cutting lineage with tables in the folder that driver and executors share."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it.

    Only a local session without the setting gets a temporary folder; on a
    cluster the missing setting is an error, because a folder of one machine
    would not be seen by the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = f"file://{tempfile.mkdtemp(prefix='spark-')}"
    spark.conf.set("spark.checkpoint.dir", own)
    return own


#: Rows of a file, about, where their number is known to be small.
ROWS_A_FILE = 20_000


def written(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of it.

    ``most`` is a bound of its rows, if one is known; few rows go to few files.
    Cuts the lineage: an executor lost later costs a re-read, not a re-run.
    The folder is deleted when the session ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df if most is None else df.coalesce(max(1, math.ceil(most / ROWS_A_FILE)))).write.parquet(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)
