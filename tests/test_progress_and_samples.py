import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from riskspark.operators import windows
from riskspark.sources import files
from riskspark.streaming import events, progress

T0 = dt.datetime(2026, 1, 15, 12)


def test_dropped_rows_are_reported(spark, tmp_path):
    path, source = str(tmp_path / "progress"), str(tmp_path / "in")
    listener = progress.ProgressTable(spark, path)
    spark.streams.addListener(listener)
    try:
        for batch in ([0, 10, 4000], [100, 3500, 3900], [200, 9000], [8000, 8500]):
            rows = [(f"{batch[0]}-{i}", T0 + dt.timedelta(seconds=x)) for i, x in enumerate(batch)]
            spark.createDataFrame(rows, "transaction_id string, event_time_ts timestamp_ntz").coalesce(1).write.mode("append").parquet(source)
            stream = events.deduplicated(events.read_table_stream(spark, source, "transaction_id string, event_time_ts timestamp_ntz"))
            query = stream.writeStream.format("parquet").queryName("known_drops").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
            query.awaitTermination()
        progress.reported(spark)
    finally:
        spark.streams.removeListener(listener)
    reports = progress.read_progress(spark, path)
    now = F.current_timestamp() + F.expr("INTERVAL 1 MINUTE")
    row = progress.watermark_drops(reports, now).filter("name = 'known_drops'").first()
    # 100 lies behind 4000 less ten minutes, 200 too, 8000 behind 9000 less ten minutes
    assert (row.input_rows, row.dropped_rows) == (10, 3) and row.watermark == T0 + dt.timedelta(seconds=9000 - 600)
    assert row.newest_event == T0 + dt.timedelta(seconds=9000) and row.dropped_share == pytest.approx(0.3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7
    again = reports.withColumn("run_id", F.lit("later")).withColumn("reported_at", F.col("reported_at") + F.expr("INTERVAL 1 SECOND"))
    assert progress.watermark_drops(reports.unionByName(again), now).filter("name = 'known_drops'").first().dropped_rows == 3
    assert progress.watermark_drops(reports, F.expr("TIMESTAMP '2020-01-01'")).count() == 0


def direct(rows, n, seed, strata=True):
    out, groups = [], {}
    for r in rows:
        groups.setdefault(r[1] if strata else None, []).append(r)
    for own in groups.values():
        own.sort(key=lambda r: (hashlib.md5(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), str(r)))
        out += own[: n(len(own))]
    return sorted(out, key=str)


def test_samples_of_exact_size(spark):
    r = random.Random(3)
    rows = [(i if i % 50 else None, r.choice(["a"] * 30 + ["b", None]), r.randrange(5)) for i in range(4000)]
    df = spark.createDataFrame(rows, "key long, kind string, v int")
    as_rows = lambda x: sorted((tuple(y) for y in x.collect()), key=str)
    for n in (0, 1, 50, 10_000):
        got = as_rows(windows.exact_sample(df, "key", ["kind"], n=n, seed=4))
        want = direct(rows, lambda size: min(n, size), 4)
        assert len(got) == len(want) and [x[:2] for x in got] == [x[:2] for x in want]
    one = as_rows(windows.exact_sample(df.filter("key is not null"), "key", share=0.1, seed=9))
    assert one == direct([x for x in rows if x[0] is not None], lambda size: round(0.1 * size), 9, False)
    assert as_rows(windows.exact_sample(df.filter("key is not null").repartition(9), "key", share=0.1, seed=9)) == one
    small = as_rows(windows.exact_sample(df.filter("key is not null"), "key", n=20, seed=9))
    assert len(small) == 20 and set(small) <= set(one)
    assert windows.exact_sample(df.limit(0), "key", ["kind"], n=5).count() == 0
    with pytest.raises(ValueError):
        windows.exact_sample(df, "key")


def test_database_rows_of_a_skewed_key(spark, tmp_path):
    """90 % of the rows in 1 % of the key's range."""
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    r = random.Random(2)
    keys = [500_000 + r.randrange(10_000) for _ in range(4500)] + [r.randrange(1_000_000) for _ in range(500)] + [None] * 7
    spark.createDataFrame([(k,) for k in keys], "k long").coalesce(2).write.format("jdbc").option("url", url).option("dbtable", "t").save()
    df = files.read_jdbc_dealt(spark, url, 'SELECT "k" FROM t', '"k"', 8)
    sizes = [x["count"] for x in df.groupBy(F.spark_partition_id().alias("p"), F.col("k").isNull().alias("none")).count().filter("not none").collect()]
    assert df.count() == len(keys) and sum(sizes) == 5000 and len(sizes) == 8 and max(sizes) <= 2 * min(sizes)
    assert sorted(x.k for x in df.filter("k is not null").collect()) == sorted(k for k in keys if k is not None)
    none = files.read_jdbc_dealt(spark, url, 'SELECT "k" FROM t WHERE "k" < 0', '"k"', 8)
    assert none.count() == 0
    one = files.read_jdbc_dealt(spark, url, 'SELECT 5 AS "k" FROM t', '"k"', 4)
    assert one.count() == len(keys)
