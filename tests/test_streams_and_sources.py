import datetime as dt
import json

from pyspark.sql import functions as F

from riskspark.operators import windows
from riskspark.sources import files
from riskspark.streaming import events

T0 = dt.datetime(2026, 1, 15, 12)
NOW = {"availableNow": True}


def event(**changes):
    return json.dumps(dict(transaction_id="t", schema_version="1.0", event_time="2026-01-01T00:00:00Z", customer_id="c", card_id="k", amount=1.0, merchant_id="m", payment_method="upi", channel="web", source="s") | changes)


def test_parse_and_quarantine(spark):
    raw = spark.createDataFrame([(event(),), ("not json",), (None,), ("{}",), (event(transaction_id="u"),)], "value string")
    good, bad = events.split_parse_failures(events.parse_events(raw))
    assert sorted(r.transaction_id for r in good.collect()) == ["t", "u"]
    assert bad.count() == 3 and {r._rejection_reason for r in bad.collect()} == {"JSON_PARSE_FAILURE"}
    again, still = events.replay_quarantine(bad.unionByName(bad.limit(1).withColumn("_raw", F.lit(event(transaction_id="w")))), 10)
    assert [r.transaction_id for r in again.collect()] == ["w"] and still.count() == 3


def test_replayed_dead_letters_pass_no_single_task(spark):
    letters = [(T0 + dt.timedelta(hours=i // 40), "junk" if i % 3 else event(transaction_id=f"t{i:03}")) for i in range(100)]
    dead = spark.createDataFrame(letters, "_quarantined_at timestamp_ntz, _raw string").repartition(4)
    for n in (0, 1, 25, 40, 50, 70, 100, 3_000_000_000):
        good, bad = events.replay_quarantine(dead, n)
        want = [raw for _, raw in sorted(letters)[:n]]
        assert sorted(r._raw for r in good.collect()) == sorted(x for x in want if x != "junk") and bad.count() == want.count("junk")
        assert "TakeOrdered" not in good._jdf.queryExecution().executedPlan().toString()


def test_bronze_stream_and_replay(spark, tmp_path):
    landing, bronze, dead = (str(tmp_path / x) for x in ("in", "bronze", "dead"))
    spark.createDataFrame([(event(),), ("junk",), (event(transaction_id="u"),)], "value string").write.parquet(landing)
    stream = events.read_table_stream(spark, landing, "value string")
    events.bronze_writer(stream, bronze, dead, str(tmp_path / "ck"), NOW).awaitTermination()
    assert spark.read.parquet(bronze).count() == 2 and spark.read.parquet(dead).count() == 1
    schema = spark.read.parquet(bronze).schema
    for i in range(2):  # the same input twice leaves the table as it was
        events.upsert_writer(events.read_table_stream(spark, bronze, schema), str(tmp_path / "silver"), ["transaction_id"], str(tmp_path / f"ck{i}"), trigger=NOW).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 2


def test_velocity_stream_equals_batch(spark, tmp_path):
    rows = [(f"c{i % 3}", float(i), T0 + dt.timedelta(seconds=20 * i)) for i in range(120)]
    df = spark.createDataFrame(rows, "card_id string, amount double, event_time_ts timestamp_ntz")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = windows.card_velocity_1h(events.read_table_stream(spark, str(tmp_path / "in"), df.schema), watermark="1 minute")
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.card_id, r.feature_timestamp): (r.card_1h_count, r.card_1h_sum) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(r.card_id, r.feature_timestamp): (r.card_1h_count, r.card_1h_sum) for r in windows.card_velocity_1h(df).collect()}
    closed = max(r[2] for r in rows) - dt.timedelta(minutes=1)
    assert got and got == {k: v for k, v in want.items() if k[1] <= closed}


def test_late_rows_are_kept(spark, tmp_path):
    make = lambda *s: spark.createDataFrame([(i, T0 + dt.timedelta(seconds=x)) for i, x in enumerate(s)], "id int, event_time_ts timestamp_ntz")
    good, late = events.split_late_events(make(0, 4000), T0 + dt.timedelta(seconds=3600))
    assert good.count() == 1 and [r._rejection_reason for r in late.collect()] == ["LATE_WATERMARK_DROP"]
    assert events.split_late_events(make(0), None)[0].count() == 1
    make(4000).write.parquet(str(tmp_path / "in"))
    for i in range(2):
        stream = events.read_table_stream(spark, str(tmp_path / "in"), make(0).schema)
        events.late_writer(stream, str(tmp_path / "out"), str(tmp_path / "dead"), str(tmp_path / "ck"), trigger=NOW).awaitTermination()
        make(0).write.mode("append").parquet(str(tmp_path / "in"))
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 1


def test_routing(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.05), ("b", 0.3), ("c", 0.95)], "transaction_id string, fraud_probability double")
    out = {k: sorted(r.transaction_id for r in v.collect()) for k, v in events.route_decisions(df).items()}
    assert out == {"cases": ["b", "c"], "audit": ["b", "c"], "step_up": ["b"]}
    df.write.parquet(str(tmp_path / "in"))
    events.route_writer(events.read_table_stream(spark, str(tmp_path / "in"), df.schema), str(tmp_path / "out"), str(tmp_path / "ck"), NOW).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/step_up")).count() == 1


def test_edges_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3), (1, 2, 3), (4, 2, None)], "customer_id int, card_id int, device_id int")
    df.write.parquet(str(tmp_path / "in"))
    for i in range(2):
        events.edges_writer(events.read_table_stream(spark, str(tmp_path / "in"), df.schema), str(tmp_path / "v"), str(tmp_path / "e"), str(tmp_path / f"ck{i}"), NOW).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "v")).count() == 4 and spark.read.parquet(str(tmp_path / "e")).count() == 3


def test_step_up_batch(spark):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    asked = spark.createDataFrame([("a", at(0)), ("b", at(0)), ("c", at(0)), ("d", at(8))], "case_id string, requested_at timestamp_ntz")
    told = spark.createDataFrame([("a", "VERIFIED", at(3)), ("b", "VERIFIED", at(6)), ("a", "FAILED", at(4))], "case_id string, status string, answered_at timestamp_ntz")
    out = {r.case_id: r.status for r in events.step_up_timeouts(asked, told, F.expr("TIMESTAMP_NTZ '2026-01-15 12:10:00'")).collect()}
    assert out == {"a": "VERIFIED", "b": "ESCALATED", "c": "ESCALATED", "d": "PENDING"}


def test_step_up_stream(spark, tmp_path):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    path = str(tmp_path / "in")
    schema = "case_id string, kind string, at timestamp_ntz"
    batches = [[("a", "REQUESTED", at(0)), ("b", "REQUESTED", at(0))], [("a", "VERIFIED", at(3))], [("z", "REQUESTED", at(60))], [("z", "FAILED", at(61))]]
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
        stream = events.step_up_stream(events.read_table_stream(spark, path, schema))
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    out = {r.case_id: r.status for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert out == {"a": "VERIFIED", "b": "ESCALATED", "z": "FAILED"}


def test_csv_stream_with_hints_and_lineage(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text('id,amount,note\n1,2.5,"say ""hi"""\nx,3,\n')
    schema = files.schema_with_hints(spark, str(folder), {"id": "int", "amount": "double"})
    assert [f.dataType.simpleString() for f in schema] == ["int", "double", "string"]
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    good_rows, bad_rows = files.split_bad_records(files.with_lineage(files.read_csv_incremental(spark, str(folder), schema, "*.csv"), "b1"))
    for _ in range(2):
        files.append_available(good_rows, out, str(tmp_path / "ck"))
        files.append_available(bad_rows, bad, str(tmp_path / "ckb"))
    row = spark.read.parquet(out).first()
    assert spark.read.parquet(out).count() == 1 and row.note == 'say "hi"' and row._batch_id == "b1" and row._source_file.endswith("a.csv")
    assert spark.read.parquet(bad).count() == 1
    checked = files.landing_check(spark, str(folder), {"a.csv": (2, 3), "b.csv": (1, 1)}).collect()
    assert {r.file: r.passed for r in checked} == {"a.csv": True, "b.csv": False}


def test_tables(spark, tmp_path):
    one, two = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2, "x")], "a int, b string")
    path = str(tmp_path / "t")
    one.write.parquet(path)
    files.evolve_schema(two, one).write.mode("append").parquet(path)
    assert sorted(map(str, files.read_evolved(spark, path).collect())) == ["Row(a=1, b=None)", "Row(a=2, b='x')"]
    files.overwrite_table(two, path)
    assert spark.read.parquet(path).count() == 1
    files.create_table(spark, "typed_labels", "id string, n int, day date", ["day"])
    files.create_table(spark, "typed_labels", "id string")
    assert files.scan_table(spark, "typed_labels", "v").columns == ["id", "n", "day"] and spark.sql("select count(*) from v").first()[0] == 0


def test_audit_records(spark, tmp_path):
    rows = [("m1", "t1", "block", 0.95, "full", "v1", "2026-01-02T03:04:05Z"), ("m1", "t1", "block", 0.95, "full", "v1", "2026-01-02T03:04:05Z"), ("m2", None, "block", 0.95, "full", "v1", "junk")]
    df = spark.createDataFrame(rows, "message_id string, transaction_id string, decision_action string, fraud_probability double, scoring_mode string, model_version string, decided_at string")
    path = str(tmp_path / "audit")
    for _ in range(2):
        files.write_audit_records(df, path)
    out = files.read_audit_json(spark, path).collect()
    assert [(r.transaction_id, r.score, r.decided_at.day) for r in out] == [("t1", 0.95, 2)]
    assert files.quarantine_summary(df, "scoring_mode").first().rows == 3


def test_jdbc(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    spark.createDataFrame([(1, "a"), (2, "b")], "case_id int, result string").write.format("jdbc").option("url", url).option("dbtable", "decisions").save()
    assert files.read_jdbc(spark, url, 'SELECT "case_id" FROM decisions WHERE "case_id" > 1', ("case_id", 1, 3, 2)).count() == 1
