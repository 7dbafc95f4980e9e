"""Registered queries that write tables in the shared folder and read them back, and those of fitted forms with given numbers."""

from __future__ import annotations

import uuid
from types import SimpleNamespace

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..functions.lineage import shared_dir, written
from ..functions.store import Store
from ..operators import calibration, clean, drift, keyed, labels, merge, model
from ..sources import files
from ..streaming import events, progress
from .catalogue import _BODY, _EDGES, _REPORT, ORACLES, _halves, _messages, _reconciled, as_of, query, rounded
from .fixtures import load


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Cleaning -------------------------------------------------------------------


@query("SELECT transaction_id AS id_01, card_id AS id_38, amount AS id_x FROM txn", "txn")
def p2_id_columns(spark, sf_dir):
    df = load(spark, sf_dir, "txn").select(F.col("transaction_id").alias("id-01"), F.col("card_id").alias("id-38"), F.col("amount").alias("id_x"))
    return clean.normalise_id_columns(df)


@query("SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(card_id AS VARCHAR) AS card1, customer_id FROM txn", "txn")
def p10_cast_ids(spark, sf_dir):
    return clean.cast_ids(load(spark, sf_dir, "txn").withColumnRenamed("card_id", "card1")).select("transaction_id", "card1", "customer_id")


@query("SELECT transaction_id, sha256(CAST(card_id AS VARCHAR) || '||' || 'salt') AS card_id FROM txn", "txn")
def p24_checked_hashes(spark, sf_dir):
    """Hashed card ids, after the check that all of them are hashed."""
    out = scalars.hash_pii(load(spark, sf_dir, "txn"), "salt", ["card_id"]).select("transaction_id", "card_id")
    scalars.assert_pii_hashed(out, 1.0, ["card_id"])
    return out


@query(
    "SELECT transaction_id, regexp_extract(ip_address, '^([0-9]+\\.[0-9]+)', 1) || '.xxx.xxx' AS ip_address, substr(CAST(device_id AS VARCHAR), 1, 4) || '****' AS device_id, substr('user' || card_id || '@mail.example', 1, 2) || '***@mail.example' AS email FROM txn_ip",
    "txn_ip",
)
def p26_masked_view(spark, sf_dir):
    email = F.concat(F.lit("user"), F.col("card_id").cast("string"), F.lit("@mail.example"))
    return scalars.masked_view(load(spark, sf_dir, "txn_ip").withColumn("email", email)).select("transaction_id", "ip_address", "device_id", "email")


@query("SELECT transaction_id, coalesce(amount, -999) AS amount, coalesce(latitude, -1) AS latitude, coalesce(device_id, 0) AS device_id FROM txn", "txn")
def p33_imputed(spark, sf_dir):
    return clean.impute_constants(load(spark, sf_dir, "txn"), ["amount"], ["latitude"], ["device_id"]).select("transaction_id", "amount", "latitude", "device_id")


# Sources and sinks ------------------------------------------------------------


@query("SELECT o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice, 'b1' AS _batch_id, true AS named FROM (SELECT o_orderkey, CAST(floor(o_totalprice * 100) AS BIGINT) AS o_totalprice FROM orders)")
def s6_landed_orders(spark, sf_dir):
    """Orders as CSV files, read as a stream with hinted types and lineage, appended once though the query runs twice."""
    raw, table, checkpoint = (_folder(spark, x) for x in ("raw", "bronze", "progress"))
    load(spark, sf_dir, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") * 100).alias("o_totalprice")).write.option("header", True).csv(raw)
    schema = files.schema_with_hints(spark, raw, {"o_orderkey": "bigint", "o_totalprice": "string"})
    for _ in range(2):
        stream = files.with_lineage(files.read_csv_incremental(spark, raw, schema, "*.csv"), "b1", F.expr("TIMESTAMP '2024-02-05 00:00:00'"))
        files.append_available(stream, table, checkpoint)
    return spark.read.parquet(table).select("o_orderkey", "o_totalprice", "_batch_id", F.col("_source_file").endswith(".csv").alias("named"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS priority, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS status FROM orders")
def s3_evolved_table(spark, sf_dir):
    """A table that gains a column and lacks another in its second file."""
    folder, orders = _folder(spark, "evolving"), load(spark, sf_dir, "orders")
    orders.filter("o_orderkey % 2 = 0").select("o_orderkey", F.col("o_orderpriority").alias("priority")).write.parquet(folder)
    more = orders.filter("o_orderkey % 2 = 1").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    files.evolve_schema(more, spark.read.parquet(folder)).write.mode("append").parquet(folder)
    return files.read_evolved(spark, folder).select("o_orderkey", "priority", "status")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'bad' ELSE 'good' END AS side FROM orders")
def s4_bad_records(spark, sf_dir):
    """Orders as CSV text, a word for a number in some lines."""
    folder = _folder(spark, "text")
    price = F.when(F.col("o_orderkey") % 11 == 0, "none").otherwise(F.col("o_totalprice").cast("string"))
    load(spark, sf_dir, "orders").select("o_orderkey", price.alias("price")).write.csv(folder)
    schema = f"o_orderkey bigint, price double, {files.CORRUPT} string"
    read = written(spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", files.CORRUPT).csv(folder), "parsed")
    good, bad = files.split_bad_records(read)
    return good.select("o_orderkey", F.lit("good").alias("side")).unionByName(bad.select("o_orderkey", F.lit("bad").alias("side")))


_AUDITED = "FROM (SELECT *, CASE WHEN transaction_id % 13 = 0 THEN NULL ELSE CAST(transaction_id AS VARCHAR) END AS tid FROM scores) WHERE tid IS NOT NULL"


@query(f"SELECT 'm' || transaction_id AS message_id, tid AS transaction_id, champion AS score, CASE WHEN transaction_id % 17 <> 0 THEN CAST(event_date AS VARCHAR) || ' 10:00:00' END AS decided_at, 0.1 AS approve_max {_AUDITED}", "scores")
def s16_audit_records(spark, sf_dir):
    """Decisions written as audit records by date, twice, and read back flat; those without a transaction are left out."""
    key = F.col("transaction_id")
    at = F.when(key % 17 == 0, "never").otherwise(F.concat(F.col("event_date").cast("string"), F.lit(" 10:00:00")))
    names = {f.name: F.lit(None).cast(f.dataType) for f in files.AUDIT.fields}
    given = {"message_id": F.concat(F.lit("m"), key.cast("string")), "transaction_id": F.when(key % 13 != 0, key.cast("string")), "fraud_probability": F.col("champion"), "decided_at": at, "thresholds": F.struct(F.lit(0.1).alias("approve_max"), F.lit(0.6).alias("step_up_max"), F.lit(0.9).alias("block_min"))}
    records, folder = load(spark, sf_dir, "scores").select(*[c.alias(n) for n, c in (names | given).items()]), _folder(spark, "audit")
    for _ in range(2):
        files.write_audit_records(records, folder)
    out = files.read_audit_json(spark, folder)
    return out.select("message_id", "transaction_id", "score", F.date_format("decided_at", "yyyy-MM-dd HH:mm:ss").alias("decided_at"), "approve_max")


@query("SELECT o_orderstatus, o_orderkey FROM orders")
def s17_overwritten_table(spark, sf_dir):
    folder, orders = _folder(spark, "table"), load(spark, sf_dir, "orders")
    files.overwrite_table(orders.select("o_custkey"), folder)
    files.overwrite_table(orders.select("o_orderstatus", "o_orderkey"), folder, ["o_orderstatus"])
    return spark.read.parquet(folder).select("o_orderstatus", "o_orderkey")


@query("SELECT o_orderkey, o_custkey FROM orders")
def s22_scanned_view(spark, sf_dir):
    name = f"orders_{uuid.uuid4().hex}"
    load(spark, sf_dir, "orders").createOrReplaceTempView(name)
    return files.scan_table(spark, name, f"{name}_too").select("o_orderkey", "o_custkey")


# Streams ------------------------------------------------------------------------


@query(f"SELECT CAST(event_id AS VARCHAR) AS transaction_id FROM events WHERE {_BODY} = 'ok'")
def s19_replayed_capture(spark, sf_dir):
    folder = _folder(spark, "capture")
    _messages(spark, sf_dir).write.json(folder)
    good, _ = events.split_parse_failures(events.parse_events(events.replay_capture(spark, folder)))
    return good.select("transaction_id")


@query(f"SELECT {_BODY} = 'ok' AS good, count(*) AS rows FROM (SELECT event_id FROM events WHERE event_id % 37 <> 0 OR event_id % 31 = 0) GROUP BY 1")
def s20_replayed_quarantine(spark, sf_dir):
    """All messages with a body as dead letters, sent through the parser again."""
    dead = _messages(spark, sf_dir).filter("value is not null").select(F.col("value").alias("_raw"), as_of().alias("_quarantined_at"))
    good, bad = events.replay_quarantine(dead, dead.count())
    return good.select(F.lit(True).alias("good")).unionByName(bad.select(F.lit(False).alias("good"))).groupBy("good").agg(F.count("*").alias("rows"))


@query(f"SELECT CAST(event_id AS VARCHAR) AS transaction_id, 'bronze' AS side FROM events WHERE {_BODY} = 'ok' UNION ALL SELECT NULL, 'quarantine' FROM events WHERE coalesce({_BODY}, '') <> 'ok'")
def s11_bronze_stream(spark, sf_dir):
    raw, bronze, quarantine, checkpoint = (_folder(spark, x) for x in ("messages", "bronze", "quarantine", "progress"))
    _messages(spark, sf_dir).write.parquet(raw)
    stream = events.read_table_stream(spark, raw, "value string")
    events.bronze_writer(stream, bronze, quarantine, checkpoint, {"availableNow": True}).awaitTermination()
    good, bad = spark.read.parquet(bronze), spark.read.parquet(quarantine)
    return good.select("transaction_id", F.lit("bronze").alias("side")).unionByName(bad.select(F.lit(None).cast("string").alias("transaction_id"), F.lit("quarantine").alias("side")))


@query(f"SELECT CAST(event_id AS VARCHAR) AS transaction_id, 'bronze' AS side FROM events WHERE {_BODY} = 'ok' UNION ALL SELECT NULL, 'quarantine' FROM events WHERE coalesce({_BODY}, '') <> 'ok'")
def s11_replayed_batch(spark, sf_dir):
    """The bronze stream again, whose last batch comes a second time because its end was never noted."""
    raw, bronze, quarantine, checkpoint = (_folder(spark, x) for x in ("messages", "bronze", "quarantine", "progress"))
    _messages(spark, sf_dir).write.parquet(raw)
    stream, store = events.read_table_stream(spark, raw, "value string", 2), Store(spark, checkpoint)
    for _ in range(2):
        events.bronze_writer(stream, bronze, quarantine, checkpoint, {"availableNow": True}).awaitTermination()
        store.delete(f"{checkpoint}/commits/{max(map(int, filter(str.isdigit, store.names(f'{checkpoint}/commits'))))}")
    good, bad = spark.read.parquet(bronze), spark.read.parquet(quarantine)
    return good.select("transaction_id", F.lit("bronze").alias("side")).unionByName(bad.select(F.lit(None).cast("string").alias("transaction_id"), F.lit("quarantine").alias("side")))


_LATE = """WITH b AS (SELECT transaction_id, event_time_ts, transaction_id % 3 AS batch FROM txn), m AS (SELECT batch, max(event_time_ts) AS t FROM b GROUP BY batch), n AS (SELECT b1.batch, max(m.t) AS newest FROM m AS b1 LEFT JOIN m ON m.batch < b1.batch GROUP BY b1.batch)
    SELECT transaction_id, coalesce(event_time_ts < newest - INTERVAL 10 MINUTE, false) AS late FROM b JOIN n USING (batch)"""


@query(_LATE, "txn")
def t8_late_rows(spark, sf_dir):
    """All rows in three batches; a row is late against the newest time of the batches before its own."""
    raw, table, dead, checkpoint = (_folder(spark, x) for x in ("rows", "on_time", "late", "progress"))
    rows = load(spark, sf_dir, "txn").select("transaction_id", "event_time_ts")
    for i in range(3):
        rows.filter(F.col("transaction_id") % 3 == i).write.mode("append").parquet(raw)
        events.late_writer(events.read_table_stream(spark, raw, rows.schema), table, dead, checkpoint, trigger={"availableNow": True}).awaitTermination()
    read = lambda folder, late: spark.read.parquet(folder).select("transaction_id", F.lit(late).alias("late"))
    return read(table, False).unionByName(read(dead, True))


@query("SELECT 'cases' AS output, transaction_id FROM scores WHERE champion >= 0.1 UNION ALL SELECT 'audit', transaction_id FROM scores WHERE champion >= 0.1 UNION ALL SELECT 'step_up', transaction_id FROM scores WHERE champion >= 0.1 AND champion < 0.6", "scores")
def t10_routed_stream(spark, sf_dir):
    """Decisions as a stream, each sent twice, into the three keyed outputs."""
    raw, root, checkpoint = (_folder(spark, x) for x in ("rows", "routed", "progress"))
    rows = load(spark, sf_dir, "scores").select("transaction_id", "champion")
    rows.unionByName(rows).write.parquet(raw)
    events.route_writer(events.read_table_stream(spark, raw, rows.schema), root, checkpoint, {"availableNow": True}, "champion", 8).awaitTermination()
    out = [keyed.read_keyed(spark, f"{root}/{name}").select(F.lit(name).alias("output"), "transaction_id") for name in ("cases", "audit", "step_up")]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("SELECT transaction_id, amount FROM txn", "txn")
def s13_upserted_stream(spark, sf_dir):
    """Every row sent twice, kept once."""
    raw, table, checkpoint = (_folder(spark, x) for x in ("rows", "silver", "progress"))
    rows = load(spark, sf_dir, "txn").select("transaction_id", "amount")
    rows.unionByName(rows).write.parquet(raw)
    events.upsert_writer(events.read_table_stream(spark, raw, rows.schema, 1), table, ["transaction_id"], checkpoint, trigger={"availableNow": True}).awaitTermination()
    return keyed.read_keyed(spark, table)


@query(f"WITH {_EDGES} SELECT src, dst, relationship FROM e", "txn")
def r8_edge_stream(spark, sf_dir):
    raw, vertices, edges, checkpoint = (_folder(spark, x) for x in ("rows", "vertices", "edges", "progress"))
    rows = load(spark, sf_dir, "txn").select("customer_id", "card_id", "device_id")
    rows.write.parquet(raw)
    events.edges_writer(events.read_table_stream(spark, raw, rows.schema), vertices, edges, checkpoint, {"availableNow": True}).awaitTermination()
    return keyed.read_keyed(spark, edges)


@query(
    """WITH b AS (SELECT event_time_ts, transaction_id % 3 AS batch FROM txn), m AS (SELECT batch, date_trunc('milliseconds', max(event_time_ts)) AS t FROM b GROUP BY batch), n AS (SELECT b1.batch, max(m.t) - INTERVAL 10 MINUTE AS mark FROM m AS b1 LEFT JOIN m ON m.batch < b1.batch GROUP BY b1.batch)
    SELECT (SELECT count(*) FROM txn) AS input_rows, count_if(event_time_ts <= mark) AS dropped_rows, (SELECT max(t) - INTERVAL 10 MINUTE FROM m) AS watermark FROM b JOIN n USING (batch)""",
    "txn",
)
def t1_watermark_drops(spark, sf_dir):
    """A stream without repeated rows over all rows in three batches, and what its recorded progress says was dropped."""
    raw, table, checkpoint, reports = (_folder(spark, x) for x in ("rows", "seen", "checkpoint", "progress"))
    rows, name, listener = load(spark, sf_dir, "txn").select("transaction_id", "event_time_ts"), f"drops_{uuid.uuid4().hex}", progress.ProgressTable(spark, reports)
    spark.streams.addListener(listener)
    try:
        for i in range(3):
            rows.filter(F.col("transaction_id") % 3 == i).write.mode("append").parquet(raw)
            stream = events.deduplicated(events.read_table_stream(spark, raw, rows.schema))
            stream.writeStream.format("parquet").queryName(name).option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        progress.reported(spark)
    finally:
        spark.streams.removeListener(listener)
    found = progress.watermark_drops(progress.read_progress(spark, reports), F.current_timestamp() + F.expr("INTERVAL 1 MINUTE"))
    return found.filter(F.col("name") == name).select("input_rows", "dropped_rows", F.col("watermark").cast("timestamp_ntz").alias("watermark"))


@query("SELECT o_orderkey, o_custkey FROM orders")
def s14_database_ranges(spark, sf_dir):
    """Orders in a database, a tenth spread over a hundred times the range of the rest, read by ranges of about equal size."""
    folder = _folder(spark, "database").removeprefix("file://")
    url, options = f"jdbc:derby:{folder};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spread = F.when(F.col("o_orderkey") % 10 == 0, 100 * F.col("o_orderkey")).otherwise(F.col("o_orderkey")).cast("long")
    rows = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", spread.alias("spread"))
    rows.coalesce(1).write.format("jdbc").option("url", url).option("dbtable", "orders").options(**options).save()
    return files.read_jdbc_dealt(spark, url, 'SELECT * FROM orders', '"spread"', 4, **options).select("o_orderkey", "o_custkey")


@query("SELECT transaction_id, card_id FROM txn", "txn")
def t9_deduplicated(spark, sf_dir):
    rows = load(spark, sf_dir, "txn").select("transaction_id", "card_id", "event_time_ts")
    return events.deduplicated(rows.unionByName(rows)).select("transaction_id", "card_id")


# Table maintenance --------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 THEN 2 * o_totalprice ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def m4_upsert_set(spark, sf_dir):
    """Prices of known orders are set, their status stays; new orders come whole. Every order takes part."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    source = orders.filter("o_orderkey % 2 = 0 or o_orderkey % 3 = 0").withColumns({"o_totalprice": 2 * F.col("o_totalprice"), "o_orderstatus": F.lit("X")})
    return merge.upsert_set(orders.filter("o_orderkey % 3 <> 0"), source, ["o_orderkey", "o_custkey"], ["o_totalprice"])


@query("SELECT transaction_id, champion, challenger FROM scores", "scores")
def m5_append_new(spark, sf_dir):
    """A half first, then all rows twice, by a composite key."""
    folder = _folder(spark, "scores")
    rows, keys = load(spark, sf_dir, "scores").select("transaction_id", "champion", "challenger"), ["transaction_id", "champion", "challenger"]
    for batch in (rows.filter("transaction_id % 2 = 0"), rows.unionByName(rows), rows):
        merge.append_new(spark, folder, batch, keys)
    return spark.read.parquet(folder)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice FROM orders")
def m2_keyed_upsert(spark, sf_dir):
    """Orders that 3 doesn't divide as a keyed table; then all even ones and multiples of 3, changed, by rewriting the files they are in."""
    root, orders = _folder(spark, "orders"), load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    keyed.insert_keyed(orders.filter("o_orderkey % 3 <> 0"), root, ["o_orderkey"], buckets=8)
    keyed.upsert_keyed(orders.filter("o_orderkey % 2 = 0 or o_orderkey % 3 = 0").withColumn("o_totalprice", -F.col("o_totalprice")), root, ["o_orderkey"])
    return keyed.read_keyed(spark, root)


@query(ORACLES["m3_upsert_if"])
def m3_keyed_labels(spark, sf_dir):
    """Early labels in a keyed table, replaced by later ones where those are surer or settled."""
    root, columns = _folder(spark, "labels"), ["transaction_id", "is_fraud_reconciled", "label_source", "label_confidence"]
    early, late = (_reconciled(spark, sf_dir, day).select(*columns) for day in (F.expr("TIMESTAMP_NTZ '2024-01-31 00:00:00'"), None))
    keyed.insert_keyed(early, root, ["transaction_id"], buckets=8)
    keyed.upsert_keyed(late, root, ["transaction_id"], merge.labels_condition())
    return keyed.read_keyed(spark, root)


# Drift and models -----------------------------------------------------------------


_RETRAIN = f"""WITH {_REPORT}, f AS (SELECT count_if(status = 'CRITICAL_DRIFT') > 0 AS bad FROM rep), l AS (SELECT abs(avg(is_fraud) FILTER (event_date >= DATE '2024-01-16') - avg(is_fraud) FILTER (event_date < DATE '2024-01-16')) / avg(is_fraud) FILTER (event_date < DATE '2024-01-16') >= 0.3 AS bad FROM txn)
    SELECT f.bad OR l.bad AS retrain, concat_ws(',', CASE WHEN f.bad THEN 'FEATURE_DRIFT' END, CASE WHEN l.bad THEN 'LABEL_RATE_DRIFT' END) AS reason FROM f, l"""


@query(_RETRAIN, "txn")
def d9_retrain_reason(spark, sf_dir):
    """The decision on feature and label drift, with a prediction that doesn't drift against itself."""
    reference, current = _halves(spark, sf_dir)
    scores = load(spark, sf_dir, "scores")
    summary = drift.drift_summary(drift.feature_drift_report(reference, current, ["amount", "merchant_id"]))
    return drift.retrain_decision(summary, drift.prediction_drift(scores, scores, "champion"), drift.label_rate_drift(reference, current, "is_fraud")).select("retrain", "reason")


@query("SELECT amount, merchant_id FROM txn", "txn")
def d10_training_snapshot(spark, sf_dir):
    folder = _folder(spark, "snapshot")
    labels.training_snapshot(load(spark, sf_dir, "txn"), ["amount", "merchant_id"], folder)
    return spark.read.parquet(folder)


class _Given:
    """A classifier of given weights, in the form of a fitted one."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias

    def transform(self, df: DataFrame) -> DataFrame:
        odds = F.lit(self.bias)
        for c, w in self.weights.items():
            odds = odds + F.lit(w) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        p = 1 / (1 + F.exp(-odds))
        return df.withColumns({"rawPrediction": array_to_vector(F.array(-odds, odds)), "probability": array_to_vector(F.array(1 - p, p)), "prediction": (p >= 0.5).cast("double")})


_FIRST, _SECOND = _Given({"amount": 0.01}, -2.0), _Given({"amount": 0.005, "merchant_id": 0.02}, -2.0)
_PAIR = "SELECT transaction_id, 1 / (1 + exp(-(-2.0 + 0.01 * coalesce(amount, 0)))) AS a, 1 / (1 + exp(-(-2.0 + 0.005 * coalesce(amount, 0) + 0.02 * merchant_id))) AS b FROM txn"


@query(f"SELECT transaction_id, round(a, 6) AS score FROM ({_PAIR})", "txn")
def d25_batch_score(spark, sf_dir):
    return rounded(model.batch_score(load(spark, sf_dir, "txn"), _FIRST).select("transaction_id", "score"))


@query(f"SELECT transaction_id, round(a, 6) AS champion_score, round(b, 6) AS challenger_score, round(b - a, 6) AS delta, false AS is_error, 'v1' AS champion_version, 'v2' AS challenger_version FROM ({_PAIR})", "txn")
def d16_shadow_scores(spark, sf_dir):
    return rounded(model.shadow_scores(load(spark, sf_dir, "txn"), _FIRST, _SECOND, ("v1", "v2")))


@query("SELECT transaction_id, round(1 / (1 + exp(-(4.0 * champion - 2.0))), 6) AS calibrated FROM scores", "scores")
def d23_calibrated(spark, sf_dir):
    return rounded(model.calibrate(load(spark, sf_dir, "scores"), SimpleNamespace(coefficients=[4.0], intercept=-2.0), "champion").select("transaction_id", "calibrated"))


@query("SELECT transaction_id, round(1 / (1 + exp(-(3.0 * champion + 1.5 * challenger - 2.0))), 6) AS fraud_probability, 'v3' AS model_version FROM scores", "scores")
def d24_stacked(spark, sf_dir):
    return rounded(model.stack_scores(load(spark, sf_dir, "scores"), SimpleNamespace(coefficients=[3.0, 1.5], intercept=-2.0), ["champion", "challenger"], "v3").select("transaction_id", "fraud_probability", "model_version"))


@query(
    """WITH c AS (SELECT champion AS s, count_if(is_fraud = 1) AS pos, count(*) AS n FROM scores GROUP BY champion), p AS (SELECT s, row_number() OVER w AS r, sum(pos) OVER w AS sp, sum(n) OVER w AS sn, pos, n FROM c WINDOW w AS (ORDER BY s)),
    m AS (SELECT j.r AS j, k.r AS k, (k.sp - j.sp + j.pos) / (k.sn - j.sn + j.n) AS a FROM p AS j JOIN p AS k ON k.r >= j.r), l AS (SELECT j, k, min(a) OVER (PARTITION BY j ORDER BY k DESC ROWS UNBOUNDED PRECEDING) AS a FROM m), f AS (SELECT k AS r, max(a) AS v FROM l GROUP BY k)
    SELECT transaction_id, round(v, 6) AS calibrated FROM scores JOIN p ON s = champion JOIN f USING (r)""",
    "scores",
)
def d23_isotonic(spark, sf_dir):
    """Isotonic values of the champion's score, against the greatest of least means."""
    scores = load(spark, sf_dir, "scores")
    blocks = written(calibration.isotonic_blocks(scores, "champion", "is_fraud"), "blocks")
    return rounded(calibration.calibrate_by_blocks(scores, blocks, "champion").select("transaction_id", "calibrated"))


@query(
    """WITH f AS (SELECT avg(amount) AS ma, stddev_samp(amount) AS sa, avg(merchant_id) AS mm, stddev_samp(merchant_id) AS sm, sign(corr(amount, merchant_id)) AS r FROM txn WHERE is_fraud = 0 AND amount IS NOT NULL),
    z AS (SELECT transaction_id, (amount - ma) / sa AS a, (merchant_id - mm) / sm AS m, r FROM txn, f)
    SELECT transaction_id, round(abs(a - r * m) / sqrt(2 * (a * a + m * m)), 5) AS anomaly_score FROM z""",
    "txn",
)
def d22_residuals(spark, sf_dir):
    """What the first component of two features leaves; of two, it is the diagonal along or against their correlation."""
    txn = load(spark, sf_dir, "txn")
    stored = written(calibration.fit_components(txn.filter("is_fraud = 0"), ["amount", "merchant_id"], 1), "components")
    return rounded(calibration.residual_score(txn, stored).select("transaction_id", "anomaly_score"), 5)


@query("SELECT transaction_id, device_id >= 10 AS flagged FROM txn WHERE device_id IS NOT NULL AND event_date >= DATE '2024-01-16'", "txn")
def d21_trained_scores(spark, sf_dir):
    """A classifier trained on the first half of the days, stored, read back and applied to the second; the label follows from one feature, so its flags are known."""
    from pyspark.ml.classification import GBTClassificationModel

    rows = load(spark, sf_dir, "txn").filter("device_id is not null").select("transaction_id", "event_date", (F.col("device_id") >= 10).cast("int").alias("y"), array_to_vector(F.array(F.col("device_id").cast("double"), F.col("merchant_id").cast("double"))).alias("features"))
    early, late = rows.filter("event_date < DATE '2024-01-16'"), rows.filter("event_date >= DATE '2024-01-16'")
    fitted, _, passed = model.train_classifier(early, "y", depths=(2,), trees=3)
    folder = _folder(spark, "classifier")
    fitted.write().save(folder)
    scored = model.batch_score(late, GBTClassificationModel.load(folder))
    return scored.select("transaction_id", (F.lit(bool(passed)) & (F.col("score") >= 0.5)).alias("flagged"))


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def s18_created_table(spark, sf_dir):
    """A typed empty table that is made once, though asked for twice, and takes all orders by its own types."""
    name = f"orders_{uuid.uuid4().hex}"
    for _ in range(2):
        files.create_table(spark, name, "o_orderkey bigint, o_totalprice double, o_orderstatus string", ["o_orderstatus"])
    load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").write.insertInto(name)
    return spark.table(name)
