"""Keyed tables and batch folders: replays, crashes, two writers, and what a batch reads."""

import datetime as dt
import json
import shutil

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from riskspark.functions.store import Store
from riskspark.operators import keyed, merge
from riskspark.sources import files
from riskspark.streaming import batches, events

T0 = dt.datetime(2026, 1, 15, 12)
NOW = {"availableNow": True}


def pairs(spark, rows):
    return spark.createDataFrame(rows, "k int, v int")


def as_dict(df):
    found = [(r.k, r.v) for r in df.collect()]
    assert len(found) == len(dict(found))
    return dict(found)


def forget_last_commit(checkpoint):
    """As if the process had died after the batch's writes and before Spark noted its end."""
    commits = checkpoint / "commits"
    last = max((f for f in commits.iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
    last.unlink()
    (commits / f".{last.name}.crc").unlink(missing_ok=True)


def test_insert_takes_new_keys_once(spark, tmp_path):
    root = str(tmp_path / "t")
    keyed.insert_keyed(pairs(spark, [(1, 1), (1, 1), (2, 2)]), root, ["k"], buckets=4)
    keyed.insert_keyed(pairs(spark, [(2, 9), (3, 3)]), root, ["k"])
    assert as_dict(keyed.read_keyed(spark, root)) == {1: 1, 2: 2, 3: 3} == as_dict(spark.read.parquet(root))
    with pytest.raises(ValueError, match="key"):
        keyed.insert_keyed(pairs(spark, [(1, 1)]), root, ["v"])
    wide = spark.createDataFrame([(5, None, "x")], "k long, v string, more string")
    keyed.insert_keyed(wide, root, ["k"])  # cast to the table's columns, so a key finds its bucket
    keyed.insert_keyed(pairs(spark, [(5, 7)]), root, ["k"])
    assert as_dict(keyed.read_keyed(spark, root))[5] is None


def test_null_keys_and_empty_batches(spark, tmp_path):
    root = str(tmp_path / "t")
    keyed.insert_keyed(pairs(spark, []), root, ["k"], "s", 0, buckets=4)
    assert keyed.read_keyed(spark, root).count() == 0
    for batch in (1, 1, 2):
        keyed.insert_keyed(pairs(spark, [(None, batch)]), root, ["k"], "s", batch)
    assert sorted(r.v for r in keyed.read_keyed(spark, root).collect()) == [1, 2]


def test_a_batch_of_one_key_reads_few_files_however_large_the_table(spark, tmp_path, monkeypatch):
    """Files opened for one key while the table grows from 16 files to many batches of them."""
    root, opened = str(tmp_path / "t"), []
    real = keyed._read
    monkeypatch.setattr(keyed, "_read", lambda spark, root, version, names: opened.append(len(names)) or real(spark, root, version, names))
    most = []
    for i in range(12):
        keyed.insert_keyed(spark.range(i * 200, i * 200 + 200).selectExpr("cast(id as int) AS k", "1 AS v"), root, ["k"], buckets=16)
        opened.clear()
        keyed.insert_keyed(pairs(spark, [(7, 0)]), root, ["k"])
        most.append(max(opened))
    assert max(most) <= keyed.MOST_FILES and spark.read.parquet(root).count() == 2400
    per_bucket = {}
    for name in keyed.newest(spark, root).files:
        per_bucket[name.split("/")[0]] = per_bucket.get(name.split("/")[0], 0) + 1
    assert len(per_bucket) == 16 and max(per_bucket.values()) <= keyed.MOST_FILES
    keyed.compacted(spark, root)
    assert len(keyed.newest(spark, root).files) == 16 and spark.read.parquet(root).count() == 2400


def test_upsert_rewrites_only_files_that_hold_a_key(spark, tmp_path):
    root = str(tmp_path / "t")
    keyed.insert_keyed(spark.range(100).selectExpr("cast(id as int) AS k", "0 AS v"), root, ["k"], buckets=8)
    keyed.insert_keyed(spark.range(100, 200).selectExpr("cast(id as int) AS k", "0 AS v"), root, ["k"])
    before = set(keyed.newest(spark, root).files)
    after = keyed.upsert_keyed(pairs(spark, [(3, 1), (150, 1), (999, 1)]), root, ["k"])
    assert len(before - set(after.files)) == 2 and len(set(after.files) - before) <= 3
    want = dict.fromkeys(range(200), 0) | {3: 1, 150: 1, 999: 1}
    assert as_dict(keyed.read_keyed(spark, root)) == want == as_dict(spark.read.parquet(root))
    keyed.upsert_keyed(pairs(spark, [(3, 5), (4, 6), (1000, 2)]), root, ["k"], F.col("s.v") % 2 == 0)
    want |= {4: 6, 1000: 2}
    assert as_dict(keyed.read_keyed(spark, root)) == want
    keyed.upsert_keyed(pairs(spark, [(3, 8)]), root, ["k"], merge=lambda old, new: merge.upsert_set(old, new, ["k"], ["v"]))
    assert as_dict(keyed.read_keyed(spark, root)) == want | {3: 8}
    with pytest.raises(ValueError, match="repeat"):
        keyed.upsert_keyed(pairs(spark, [(3, 8), (3, 9)]), root, ["k"])


def test_of_two_writers_from_one_version_the_second_is_refused(spark, tmp_path):
    root = str(tmp_path / "t")
    base = keyed.insert_keyed(pairs(spark, [(1, 1)]), root, ["k"], buckets=2)
    keyed.upsert_keyed(pairs(spark, [(1, 2)]), root, ["k"], base=base)
    with pytest.raises(keyed.Refused):
        keyed.upsert_keyed(pairs(spark, [(1, 3)]), root, ["k"], base=base)
    with pytest.raises(keyed.Refused):
        keyed.create_keyed(spark, root, base and pairs(spark, []).schema, ["k"])
    assert as_dict(spark.read.parquet(root)) == {1: 2}
    versions = str(tmp_path / "v")
    merge.write_version(pairs(spark, [(1, 1)]), versions, 1)
    with pytest.raises(keyed.Refused):
        merge.write_version(pairs(spark, [(1, 2)]), versions, 1)
    assert as_dict(merge.read_version(spark, versions)) == {1: 1}


@pytest.mark.parametrize("fails", ["write", "publish", "settle", "move"])
def test_a_crash_at_any_point_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, fails):
    root = str(tmp_path / "t")
    keyed.insert_keyed(spark.range(50).selectExpr("cast(id as int) AS k", "0 AS v"), root, ["k"], buckets=4)

    def crash(*a, **b):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        if fails == "write":
            m.setattr(Store, "files", crash)
        elif fails == "publish":
            m.setattr(Store, "publish", crash)
        elif fails == "settle":
            m.setattr(keyed, "_settle", lambda store, root, version: crash() if version.number == 2 else None)
        else:
            real, moves = Store.move, []
            m.setattr(Store, "move", lambda self, *a: crash() if moves else moves.append(real(self, *a)) or None)
        with pytest.raises(KeyboardInterrupt):
            keyed.upsert_keyed(spark.range(40, 60).selectExpr("cast(id as int) AS k", "1 AS v"), root, ["k"], stream="s", batch=4)
    old = dict.fromkeys(range(50), 0)
    new = old | dict.fromkeys(range(40, 60), 1)
    assert as_dict(keyed.read_keyed(spark, root)) == (old if fails in ("write", "publish") else new)
    keyed.upsert_keyed(spark.range(40, 60).selectExpr("cast(id as int) AS k", "1 AS v"), root, ["k"], stream="s", batch=4)
    assert as_dict(keyed.read_keyed(spark, root)) == new == as_dict(spark.read.parquet(root))
    keyed.drop_staged(spark, root)
    assert as_dict(keyed.read_keyed(spark, root)) == new and keyed.newest(spark, root).streams == {"s": 4}


def test_few_manifests_are_kept(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "KEPT", 2)
    root = str(tmp_path / "t")
    for i in range(4):
        keyed.insert_keyed(pairs(spark, [(i, i)]), root, ["k"], buckets=2)
    assert len(Store(spark, root).names(f"{root}/_manifest")) <= 2 and len(as_dict(keyed.read_keyed(spark, root))) == 4


def test_publish_and_move(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.publish(f"{tmp_path}/a", "é")
    with pytest.raises(keyed.Refused):
        store.publish(f"{tmp_path}/a", "other")
    assert store.read(f"{tmp_path}/a") == "é" and [n for n in store.names(str(tmp_path)) if "crc" not in n] == ["a"]
    store.move(f"{tmp_path}/a", f"{tmp_path}/b/c")
    store.move(f"{tmp_path}/a", f"{tmp_path}/b/c")
    assert store.exists(f"{tmp_path}/b/c") and not store.exists(f"{tmp_path}/a") and store.names(f"{tmp_path}/none") == []
    with pytest.raises((Py4JJavaError, FileNotFoundError)):
        store.read(f"{tmp_path}/none")


def event(key):
    return json.dumps(dict(transaction_id=key, schema_version="1.0", event_time="2026-01-01T00:00:00Z", customer_id="c", card_id="k", amount=1.0, merchant_id="m", payment_method="upi", channel="web", source="s"))


def listed(folder):
    return sorted(str(f.relative_to(folder)) for f in folder.rglob("*.parquet"))


@pytest.mark.parametrize("crash", ["between the writes", "before the commit"])
def test_bronze_after_a_crash(spark, tmp_path, monkeypatch, crash):
    landing, bronze, dead, ck = (tmp_path / x for x in ("in", "bronze", "dead", "ck"))

    def run():
        stream = events.read_table_stream(spark, str(landing), "value string")
        events.bronze_writer(stream, str(bronze), str(dead), str(ck), NOW).awaitTermination()

    for day in range(2):
        spark.createDataFrame([(event(f"t{day}"),), (f"junk {day}",)], "value string").coalesce(1).write.mode("append").parquet(str(landing))
        if crash == "between the writes" and day == 1:
            real = events.commit_batch
            with monkeypatch.context() as m:
                m.setattr(events, "commit_batch", lambda df, path, *a: (_ for _ in ()).throw(OSError("lost")) if path == str(dead) else real(df, path, *a))
                with pytest.raises(StreamingQueryException):
                    run()
            had = listed(bronze)
            run()
            assert listed(bronze) == had
        else:
            run()
    before = listed(bronze), listed(dead)
    forget_last_commit(ck)
    run()
    assert (listed(bronze), listed(dead)) == before
    assert sorted(r.transaction_id for r in spark.read.parquet(str(bronze)).collect()) == ["t0", "t1"] and spark.read.parquet(str(dead)).count() == 2
    assert spark.read.parquet(str(bronze)).select("stream_id").distinct().count() == 1 and "stream_id=None" not in str(before)


def test_a_second_stream_adds_to_the_table(spark, tmp_path):
    landing = str(tmp_path / "in")
    spark.createDataFrame([(event("t"),)], "value string").write.parquet(landing)
    for i in range(2):
        events.bronze_writer(events.read_table_stream(spark, landing, "value string"), str(tmp_path / "b"), str(tmp_path / "d"), str(tmp_path / f"ck{i}"), NOW).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "b")).count() == 2


def test_a_half_written_batch_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    batches.commit_batch(pairs(spark, [(1, 1)]), path, "s", 0)
    (tmp_path / "t/stream_id=s/batch_id=0/_SUCCESS").unlink()
    batches.commit_batch(pairs(spark, [(2, 2)]), path, "s", 0)
    batches.commit_batch(pairs(spark, [(3, 3)]), path, "s", 0)
    assert as_dict(spark.read.parquet(path)) == {2: 2}


def test_late_rows_after_a_replay(spark, tmp_path):
    make = lambda *s: spark.createDataFrame([(i, T0 + dt.timedelta(seconds=x)) for i, x in enumerate(s)], "id int, event_time_ts timestamp_ntz")
    source, out, dead, ck = (tmp_path / x for x in ("in", "out", "dead", "ck"))

    def run(name="ck"):
        stream = events.read_table_stream(spark, str(source), make(0).schema)
        events.late_writer(stream, str(out), str(dead), str(tmp_path / name), trigger=NOW).awaitTermination()

    for seconds in ((4000,), (0, 3500, 9000), (8300, 8500)):
        make(*seconds).coalesce(1).write.mode("append").parquet(str(source))
        run()
    got = lambda folder: sorted(r.event_time_ts for r in spark.read.parquet(str(folder)).collect())
    at = lambda *s: [T0 + dt.timedelta(seconds=x) for x in s]
    assert got(out) == at(3500, 4000, 8500, 9000) and got(dead) == at(0, 8300)
    for _ in range(2):  # the batch that held the newest row so far: its own rows don't make it late
        forget_last_commit(ck)
        run()
    shutil.rmtree(ck / "commits")
    (ck / "commits").mkdir()
    run()
    assert got(out) == at(3500, 4000, 8500, 9000) and got(dead) == at(0, 8300)
    run("other")  # another stream begins from the newest time that the first has left
    assert got(dead) == sorted(at(0, 8300) + at(0, 3500, 4000, 8300))


def test_replayed_routes_edges_and_upserts(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.05), ("b", 0.3), ("c", 0.95)], "transaction_id string, fraud_probability double")
    df.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        events.route_writer(events.read_table_stream(spark, str(tmp_path / "in"), df.schema), str(tmp_path / "out"), str(tmp_path / "ck"), NOW).awaitTermination()
        forget_last_commit(tmp_path / "ck")
    assert [spark.read.parquet(str(tmp_path / "out" / n)).count() for n in ("cases", "audit", "step_up")] == [2, 2, 1]
    assert list(keyed.newest(spark, str(tmp_path / "out/cases")).streams.values()) == [0]
    rows = spark.createDataFrame([(1, 2, 3), (4, 2, None)], "customer_id int, card_id int, device_id int")
    rows.write.parquet(str(tmp_path / "rows"))
    for _ in range(2):
        events.edges_writer(events.read_table_stream(spark, str(tmp_path / "rows"), rows.schema), str(tmp_path / "v"), str(tmp_path / "e"), str(tmp_path / "cke"), NOW).awaitTermination()
        forget_last_commit(tmp_path / "cke")
    assert spark.read.parquet(str(tmp_path / "v")).count() == 4 and spark.read.parquet(str(tmp_path / "e")).count() == 3


def test_partitions_below_buckets(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2026, 1, 1)), (2, None)], "k int, day date")
    keyed.insert_keyed(df, str(tmp_path / "t"), ["k"], buckets=2, partition_by=["day"])
    keyed.insert_keyed(df, str(tmp_path / "t"), ["k"])
    assert sorted(map(tuple, keyed.read_keyed(spark, str(tmp_path / "t")).collect())) == [(1, dt.date(2026, 1, 1)), (2, None)]


def test_audit_looks_only_into_the_days_it_touches(spark, tmp_path):
    make = lambda *rows: spark.createDataFrame([(m, "t", d) for m, d in rows], "message_id string, transaction_id string, decided_at string")
    path = str(tmp_path / "audit")
    files.write_audit_records(make(("a", "2026-01-02T03:04:05Z"), ("b", "2026-01-03T03:04:05Z"), ("c", None)), path)
    shutil.copytree(tmp_path / "audit/year=2026/month=1/day=3", tmp_path / "kept")
    (next((tmp_path / "audit/year=2026/month=1/day=3").glob("*.json"))).write_text("not json")
    files.write_audit_records(make(("a", "2026-01-02T03:04:05Z"), ("d", "2026-01-02T03:04:05Z"), ("c", "junk")), path)
    found = [r.message_id for r in spark.read.schema("message_id string").option("basePath", path).json([f"{path}/year=2026/month=1/day=2", f"{path}/year=__HIVE_DEFAULT_PARTITION__"]).collect()]
    assert sorted(found) == ["a", "c", "d"]


def test_snapshots_leave_other_partitions_unread(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(k, f"2026-01-0{d}", d) for k in range(3) for d in range(1, 5)], "k int, snapshot_date string, v int")
    path = str(tmp_path / "t")
    merge.overwrite_partitions(df, path, ["k", "snapshot_date"])
    with monkeypatch.context() as m:  # more than a filter takes: the same rows by a join
        m.setattr(merge, "FEW_PARTITIONS", 1)
        merge.overwrite_partitions(df.filter("v < 3"), path, ["k", "snapshot_date"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == sorted((k, d) for k in range(3) for d in range(1, 5))
    for f in (tmp_path / "t/snapshot_date=2026-01-04").glob("*.parquet"):
        f.write_bytes(b"PAR1 broken")
    merge.overwrite_partitions(df.filter("k = 1 and v = 2").withColumn("v", F.lit(9)), path, ["k", "snapshot_date"])
    got = spark.read.schema("k int, v int, snapshot_date string").parquet(path).filter("snapshot_date < '2026-01-04'")
    assert sorted((r.k, r.v) for r in got.collect()) == sorted([(k, d) for k in range(3) for d in (1, 2, 3) if (k, d) != (1, 2)] + [(1, 9)])
