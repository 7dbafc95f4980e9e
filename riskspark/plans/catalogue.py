"""Registered queries of the risk operators, each with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..functions.lineage import written
from ..operators import aggregates, clean, drift, evaluate, graph, joins, labels, merge, profile, quality, windows
from ..sources import files
from ..streaming import events
from .fixtures import load, with_derived

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The moment that every time window of these queries hangs on.
AS_OF = "2024-02-05 00:00:00"


def as_of():
    return F.expr(f"TIMESTAMP_NTZ '{AS_OF}'")


def query(sql: str | None = None, *derived: str):
    """Register a query under its function's name, with SQL over the derived tables named."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = with_derived(sql, *derived) if derived else sql
        return f

    return keep


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, as sums in another order differ in their last digits."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def hours(df: DataFrame) -> DataFrame:
    return df.withColumn("event_hour", F.hour("event_time_ts"))


# Aggregations ---------------------------------------------------------------


@query(
    """SELECT event_date, count(*) AS total_transactions, count_if(is_fraud = 1) AS fraud_transactions,
    round(sum(amount), 4) AS total_amount, round(sum(CASE WHEN is_fraud = 1 THEN amount END), 4) AS fraud_amount,
    round(avg(amount), 4) AS avg_amount, round(avg(CASE WHEN is_fraud = 1 THEN amount END), 4) AS avg_fraud_amount,
    round(avg(CASE WHEN is_fraud <> 1 THEN amount END), 4) AS avg_legit_amount, round(max(amount), 4) AS max_amount,
    round(max(CASE WHEN is_fraud = 1 THEN amount END), 4) AS max_fraud_amount, round(quantile_cont(amount, 0.5), 4) AS median_amount,
    count(DISTINCT card_id) AS unique_cards, count(DISTINCT customer_id) AS unique_customers,
    round(count_if(is_fraud = 1) / count(*), 4) AS fraud_rate FROM txn GROUP BY event_date""",
    "txn",
)
def a1_daily_fraud_summary(spark, sf_dir):
    return rounded(aggregates.daily_fraud_summary(load(spark, sf_dir, "txn"), exact=True), 4)


@query(
    """SELECT event_date, CAST(hour(event_time_ts) AS INT) AS event_hour, count(*) AS txn_count, count_if(is_fraud = 1) AS fraud_count,
    round(sum(amount), 4) AS total_amount, round(avg(amount), 4) AS avg_amount, round(count_if(is_fraud = 1) / count(*), 4) AS fraud_rate FROM txn GROUP BY 1, 2""",
    "txn",
)
def a2_hourly_stats(spark, sf_dir):
    return rounded(aggregates.hourly_stats(hours(load(spark, sf_dir, "txn"))), 4)


@query(
    """SELECT event_date, CAST(hour(event_time_ts) AS INT) AS event_hour, CAST(grouping(event_date, hour(event_time_ts)) AS INT) AS level, count(*) AS txn_count, round(sum(amount), 4) AS total_amount
    FROM txn GROUP BY ROLLUP (event_date, hour(event_time_ts))""",
    "txn",
)
def a2_rollup_by_time(spark, sf_dir):
    return rounded(aggregates.rollup_by_time(hours(load(spark, sf_dir, "txn"))), 4)


_RISK = """count(*) AS total_transactions, count_if(is_fraud = 1) AS fraud_transactions, round(avg(transaction_amt), 4) AS avg_amount,
    round(sum(CASE WHEN is_fraud = 1 THEN transaction_amt END), 3) AS fraud_amount, round(count_if(is_fraud = 1) / count(*), 6) AS fraud_rate,
    CASE WHEN count_if(is_fraud = 1) / count(*) > 0.05 THEN 'high' WHEN count_if(is_fraud = 1) / count(*) > 0.02 THEN 'medium' ELSE 'low' END AS risk_tier"""


def _risk(df: DataFrame) -> DataFrame:
    return df.withColumns({"avg_amount": F.round("avg_amount", 4), "fraud_amount": F.round("fraud_amount", 3), "fraud_rate": F.round("fraud_rate", 6)})


@query(f"SELECT product_cd, {_RISK} FROM txn_wide GROUP BY product_cd", "txn_wide")
def a3_product_risk(spark, sf_dir):
    return _risk(aggregates.risk_by(load(spark, sf_dir, "txn_wide"), "product_cd"))


@query(f"SELECT card4, card6, {_RISK} FROM txn_wide GROUP BY card4, card6", "txn_wide")
def a4_card_risk(spark, sf_dir):
    return _risk(aggregates.risk_by(load(spark, sf_dir, "txn_wide"), "card4", "card6"))


@query(
    f"""SELECT customer_id, round(avg(amount), 4) AS avg_amount, round(coalesce(stddev(amount), 0), 4) AS std_amount, count(*) AS txn_count, round(quantile_cont(amount, 0.5), 4) AS median_amount,
    min(event_time_ts) AS first_seen, max(event_time_ts) AS last_seen, CAST(date_diff('day', min(event_time_ts), max(event_time_ts)) AS INT) AS tenure_days, DATE '2024-02-05' AS snapshot_date
    FROM txn WHERE event_time_ts BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY AND TIMESTAMP '{AS_OF}' GROUP BY customer_id""",
    "txn",
)
def a5_customer_baselines(spark, sf_dir):
    return rounded(aggregates.customer_baselines(load(spark, sf_dir, "txn"), as_of(), exact=True), 4)


@query(
    f"""SELECT merchant_id, round(avg(amount), 4) AS avg_ticket, count(*) AS txn_count, count_if(is_fraud = 1) AS fraud_count, DATE '2024-02-05' AS snapshot_date, round(count_if(is_fraud = 1) / count(*), 4) AS fraud_ratio
    FROM txn WHERE event_time_ts BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AND TIMESTAMP '{AS_OF}' GROUP BY merchant_id""",
    "txn",
)
def a6_merchant_risk(spark, sf_dir):
    return rounded(aggregates.merchant_risk(load(spark, sf_dir, "txn"), as_of()), 4)


@query(
    """WITH l AS (SELECT (merchant_id * 3 + transaction_id) % 97 AS late FROM txn)
    SELECT count(late) AS events, round(avg(late), 6) AS mean_late, round(stddev(late), 6) AS std_late, CAST(min(late) AS BIGINT) AS min_late, CAST(max(late) AS BIGINT) AS max_late,
    round(quantile_cont(late, 0.5), 6) AS p50_late, round(quantile_cont(late, 0.9), 6) AS p90_late, round(quantile_cont(late, 0.95), 6) AS p95_late, round(quantile_cont(late, 0.99), 6) AS p99_late FROM l""",
    "txn",
)
def a7_lateness(spark, sf_dir):
    happened = F.col("event_time_ts")
    arrived = happened + F.make_dt_interval(secs=((F.col("merchant_id") * 3 + F.col("transaction_id")) % 97).cast("decimal(18,6)"))
    return rounded(aggregates.lateness_distribution(load(spark, sf_dir, "txn"), arrived, happened, exact=True))


@query(
    """WITH c AS (SELECT card_id % 16 AS p, count(*) AS n FROM txn GROUP BY 1)
    SELECT round(avg(n), 6) AS avg_rows, round(stddev(n), 6) AS std_rows, max(n) AS max_rows, min(n) AS min_rows, round(max(n) / min(n), 6) AS skew_ratio FROM c""",
    "txn",
)
def a8_partition_skew(spark, sf_dir):
    return rounded(aggregates.partition_skew(load(spark, sf_dir, "txn"), F.col("card_id") % 16))


_KPIS = """count(*) AS total_scored_labeled, count_if(y = 1) AS actual_fraud_count, count_if(p >= 0.5 AND y = 1) AS true_positives, count_if(p >= 0.5 AND y = 0) AS false_positives,
    count_if(p < 0.5 AND y = 1) AS false_negatives, count_if(p < 0.5 AND y = 0) AS true_negatives, avg(p) AS avg_fraud_score, quantile_cont(p, 0.5) AS median_fraud_score, quantile_cont(p, 0.95) AS p95_fraud_score"""
_RATES = """CASE WHEN true_positives + false_positives > 0 THEN true_positives / (true_positives + false_positives) END AS precision,
    CASE WHEN true_positives + false_negatives > 0 THEN true_positives / (true_positives + false_negatives) END AS recall,
    CASE WHEN false_positives + true_negatives > 0 THEN false_positives / (false_positives + true_negatives) END AS false_positive_rate"""


def _daily_kpis(spark, sf_dir) -> DataFrame:
    scored = load(spark, sf_dir, "scores").select(F.lit("v1").alias("model_version"), F.col("event_date").alias("kpi_date"), F.col("champion").alias("fraud_probability"), F.col("is_fraud").alias("is_fraud_reconciled"))
    return aggregates.model_kpis(scored, "model_version", "kpi_date", exact=True)


_KPI_CTE = f"k AS (SELECT 'v1' AS model_version, event_date AS kpi_date, {_KPIS} FROM (SELECT event_date, champion AS p, is_fraud AS y FROM scores) GROUP BY event_date)"


@query(
    f"""WITH {_KPI_CTE} SELECT model_version, kpi_date, total_scored_labeled, actual_fraud_count, true_positives, false_positives, false_negatives, true_negatives,
    round(avg_fraud_score, 6) AS avg_fraud_score, round(median_fraud_score, 6) AS median_fraud_score, round(p95_fraud_score, 6) AS p95_fraud_score,
    round(precision, 6) AS precision, round(recall, 6) AS recall, round(false_positive_rate, 6) AS false_positive_rate FROM (SELECT *, {_RATES} FROM k)""",
    "scores",
)
def a9_model_kpis(spark, sf_dir):
    return rounded(_daily_kpis(spark, sf_dir))


_TELEMETRY = f"""{_KPI_CTE}, w AS (SELECT *, kpi_date > DATE '2024-01-28' AND kpi_date <= DATE '2024-01-30' AS r, kpi_date > DATE '2024-01-14' AND kpi_date <= DATE '2024-01-28' AS b FROM k),
    t AS (SELECT sum(false_positives) FILTER (r) / sum(false_positives + true_negatives) FILTER (r) AS recent_fpr, sum(true_positives) FILTER (r) / sum(true_positives + false_negatives) FILTER (r) AS recent_recall, avg(avg_fraud_score) FILTER (r) AS recent_avg_score,
    sum(false_positives) FILTER (b) / sum(false_positives + true_negatives) FILTER (b) AS baseline_fpr, sum(true_positives) FILTER (b) / sum(true_positives + false_negatives) FILTER (b) AS baseline_recall, avg(avg_fraud_score) FILTER (b) AS baseline_avg_score FROM w)"""
_TELEMETRY_COLUMNS = ", ".join(f"round({s}_{c}, 6) AS {s}_{c}" for s in ("recent", "baseline") for c in ("fpr", "recall", "avg_score"))


@query(f"WITH {_TELEMETRY} SELECT {_TELEMETRY_COLUMNS} FROM t", "scores")
def a10_production_telemetry(spark, sf_dir):
    return rounded(aggregates.production_telemetry(_daily_kpis(spark, sf_dir), F.lit("2024-01-30").cast("date")))


@query(
    f"WITH {_TELEMETRY} SELECT {_TELEMETRY_COLUMNS}, recent_fpr > 2 * baseline_fpr OR recent_recall < 0.8 * baseline_recall AS rollback, concat_ws(',', CASE WHEN recent_fpr > 2 * baseline_fpr THEN 'FPR' END, CASE WHEN recent_recall < 0.8 * baseline_recall THEN 'RECALL' END) AS reasons FROM t",
    "scores",
)
def d17_rollback_check(spark, sf_dir):
    return rounded(evaluate.rollback_check(aggregates.production_telemetry(_daily_kpis(spark, sf_dir), F.lit("2024-01-30").cast("date"))))


@query(f"SELECT max(event_time_ts) AS newest_event, round((epoch(TIMESTAMP '{AS_OF}') - epoch(date_trunc('second', max(event_time_ts)))) / 60, 6) AS age_minutes FROM txn", "txn")
def a11_freshness(spark, sf_dir):
    return rounded(aggregates.freshness(load(spark, sf_dir, "txn"), as_of()))


@query(
    """WITH d AS (SELECT CASE WHEN transaction_id % 11 = 0 THEN -1.0 ELSE challenger END AS s, champion AS c FROM scores)
    SELECT count_if(s >= 0) AS valid, count_if(s < 0) AS errors, round(avg(s - c) FILTER (s >= 0), 6) AS mean_delta, round(stddev(s - c) FILTER (s >= 0), 6) AS std_delta, round(max(abs(s - c)) FILTER (s >= 0), 6) AS max_abs_delta FROM d""",
    "scores",
)
def a12_shadow_delta(spark, sf_dir):
    failed = load(spark, sf_dir, "scores").withColumn("challenger", F.when(F.col("transaction_id") % 11 == 0, -1.0).otherwise(F.col("challenger")))
    return rounded(aggregates.shadow_delta_summary(failed))


_ANALYST = "SELECT transaction_id, CASE transaction_id % 15 WHEN 0 THEN 'CONFIRMED_FRAUD' WHEN 5 THEN 'CONFIRMED_LEGIT' ELSE 'INCONCLUSIVE' END AS said FROM txn WHERE transaction_id % 5 = 0"
_RECONCILED = f"""analyst AS ({_ANALYST}), j AS (SELECT t.*, (t.is_fraud = 1 AND t.transaction_id % 3 = 0) AS charged, said, date_diff('day', event_date, DATE '2024-02-05') >= 30 AS mature FROM txn t LEFT JOIN analyst USING (transaction_id)),
    r AS (SELECT transaction_id, CASE WHEN charged OR said = 'CONFIRMED_FRAUD' THEN 1 WHEN said = 'CONFIRMED_LEGIT' AND mature THEN 0 WHEN said IS NULL AND mature THEN 0 END AS is_fraud_reconciled,
    CASE WHEN charged THEN 'CHARGEBACK' WHEN said = 'CONFIRMED_FRAUD' THEN 'ANALYST_CONFIRMED_FRAUD' WHEN said = 'CONFIRMED_LEGIT' THEN 'ANALYST_CONFIRMED_LEGIT' WHEN mature THEN 'AUTO_MATURED_LEGIT' ELSE 'MATURING' END AS label_source,
    CASE WHEN charged THEN 1.0E0 WHEN said IS NOT NULL THEN 0.9E0 WHEN mature THEN 0.7E0 ELSE 0.0E0 END AS label_confidence FROM j)"""


def _reconciled(spark, sf_dir, day=None) -> DataFrame:
    txn = load(spark, sf_dir, "txn")
    charged = txn.filter("is_fraud = 1 AND transaction_id % 3 = 0").select("transaction_id")
    result = F.when(F.col("transaction_id") % 15 == 0, "CONFIRMED_FRAUD").when(F.col("transaction_id") % 15 == 5, "CONFIRMED_LEGIT").otherwise("INCONCLUSIVE")
    # An earlier decision of every case is overruled by the later one.
    last = txn.filter("transaction_id % 5 = 0").select("transaction_id", result.alias("decision_result"), F.lit(2).alias("decided_at"))
    said = last.unionByName(last.withColumns({"decision_result": F.lit("INCONCLUSIVE"), "decided_at": F.lit(1)}))
    return labels.reconcile_labels(txn, charged, said, as_of() if day is None else day)


@query(f"WITH {_RECONCILED} SELECT label_source, count(*) AS labels, count(is_fraud_reconciled) AS settled FROM r GROUP BY label_source", "txn")
def a13_label_sources(spark, sf_dir):
    return aggregates.label_source_counts(_reconciled(spark, sf_dir))


@query(
    f"SELECT merchant_id, count(*) AS rows, count(DISTINCT card_id) AS distinct_card_id, true AS near FROM txn WHERE event_date < DATE '{AS_OF[:10]}' AND event_date >= DATE '{AS_OF[:10]}' - 14 GROUP BY merchant_id",
    "txn",
)
def a14_distinct_as_of(spark, sf_dir):
    """Cards of each merchant over two weeks from sketches stored a day, and whether they are within 5 % of the exact count."""
    txn = load(spark, sf_dir, "txn")
    stored = written(aggregates.distinct_sketches(txn, ["card_id"], "event_date", "merchant_id"), "daily")
    found = aggregates.distinct_as_of(stored, ["card_id"], as_of(), 14, "merchant_id").withColumnRenamed("distinct_card_id", "sketched")
    last = as_of().cast("date")
    exact = txn.filter((F.col("event_date") < last) & (F.col("event_date") >= F.date_sub(last, 14))).groupBy("merchant_id").agg(F.count_distinct("card_id").alias("distinct_card_id"))
    return found.join(exact, "merchant_id").select("merchant_id", "rows", "distinct_card_id", (F.abs(F.col("sketched") - F.col("distinct_card_id")) <= 0.05 * F.col("distinct_card_id")).alias("near"))


@query("SELECT count(DISTINCT card_id) AS distinct_card_id, count(DISTINCT merchant_id) AS distinct_merchant_id, count(DISTINCT device_id) AS distinct_device_id FROM txn", "txn")
def a14_distinct_counts(spark, sf_dir):
    return aggregates.distinct_counts(load(spark, sf_dir, "txn"), "card_id", "merchant_id", "device_id")


@query("SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY 1, 2")
def a15_event_type_counts(spark, sf_dir):
    return aggregates.event_type_daily_counts(load(spark, sf_dir, "events"), ts="ts")


# Cleaning and scalar functions ----------------------------------------------


@query(
    """SELECT transaction_id, order_id, CASE WHEN order_id % 7 = 0 THEN 'unknown' ELSE lower(trim(card4)) END AS card4, lower(card6) AS card6, CASE WHEN order_id % 7 = 0 THEN 1 ELSE 0 END AS card4_is_null,
    round(ln(1 + transaction_amt), 6) AS log_amount, CAST(trunc(transaction_amt * 100) AS BIGINT) % 100 AS amount_cents, CASE WHEN transaction_amt = floor(transaction_amt) THEN 1 ELSE 0 END AS is_round_amount FROM txn_wide""",
    "txn_wide",
)
def p4_clean_wide(spark, sf_dir):
    df = load(spark, sf_dir, "txn_wide").withColumn("card4", F.when(F.col("order_id") % 7 != 0, F.col("card4")))
    df = clean.amount_features(clean.standardise_card(clean.fill_categoricals(clean.null_flags(df, ["card4"]), ["card4"])))
    return df.select("transaction_id", "order_id", "card4", "card6", "card4_is_null", F.round("log_amount", 6).alias("log_amount"), "amount_cents", "is_round_amount")


@query("SELECT l_orderkey AS order_key, CAST(l_linenumber AS INT) AS line_number, l_returnflag AS return_flag, m AS m1 FROM (SELECT *, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS m FROM lineitem)")
def p1_snake_case(spark, sf_dir):
    df = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("OrderKey"), F.col("l_linenumber").alias("lineNumber"), F.col("l_returnflag").alias("ReturnFlag"), F.when(F.col("l_returnflag") == "R", "T").when(F.col("l_returnflag") == "A", "F").otherwise("x").alias("M1"))
    return clean.binarise_match(clean.to_snake_case(df))


@query(
    """SELECT event_id, TIMESTAMP '2025-01-01 00:00:00' + to_seconds(d) AS event_time, CAST(TIMESTAMP '2025-01-01 00:00:00' + to_seconds(d) AS DATE) AS event_date, CAST((d % 86400) // 3600 AS INT) AS event_hour, CAST((d // 86400) % 7 AS INT) AS event_day_of_week
    FROM (SELECT event_id, (event_id * 7919) % 15000000 AS d FROM events)"""
)
def p3_synthesize_timestamps(spark, sf_dir):
    df = load(spark, sf_dir, "events").select("event_id", ((F.col("event_id") * 7919) % 15000000).alias("transaction_dt"))
    return clean.synthesize_timestamps(df).withColumn("event_time", F.col("event_time").cast("timestamp_ntz")).drop("transaction_dt")


@query("SELECT c_custkey, d AS email, split_part(d, '.', 1) AS email_provider, CASE WHEN d IS NULL THEN 'unknown' ELSE split_part(d, '.', -1) END AS email_tld FROM (SELECT c_custkey, lower(c_mktsegment || '.Example.com') AS d FROM customer)")
def p6_email_domain(spark, sf_dir):
    df = load(spark, sf_dir, "customer").select("c_custkey", F.concat("c_mktsegment", F.lit(".Example.com ")).alias("email"))
    return clean.split_email_domain(df, "email")


@query(
    """WITH c AS (SELECT channel, count(*) AS n FROM txn WHERE channel IS NOT NULL GROUP BY channel ORDER BY n DESC, channel LIMIT 3)
    SELECT channel_bucket, count(*) AS n FROM (SELECT CASE WHEN t.channel IS NULL THEN NULL ELSE coalesce(c.channel, 'rare') END AS channel_bucket FROM txn t LEFT JOIN c USING (channel)) GROUP BY 1""",
    "txn",
)
def p11_rare_levels(spark, sf_dir):
    return clean.bucket_rare_levels(load(spark, sf_dir, "txn"), "channel", 3).groupBy("channel_bucket").agg(F.count("*").alias("n"))


@query(
    """SELECT transaction_id, lower(channel) AS channel, coalesce(CAST(device_id AS VARCHAR), 'unknown') AS device_id, CASE WHEN latitude BETWEEN -40 AND 40 THEN latitude * 2.25 END AS latitude, longitude, amount, event_date,
    CAST(hour(event_time_ts) AS INT) AS event_hour, CAST(dayofweek(event_time_ts) + 1 AS INT) AS event_day FROM txn WHERE amount >= 0""",
    "txn",
)
def p12_conform_event(spark, sf_dir):
    df = load(spark, sf_dir, "txn").withColumn("latitude", F.col("latitude") * 2.25)
    return clean.conform_event(df).select("transaction_id", "channel", "device_id", "latitude", "longitude", "amount", "event_date", "event_hour", "event_day")


@query(
    """SELECT transaction_id, concat_ws(',', CASE WHEN amount IS NULL THEN 'MISSING_AMOUNT' END, CASE WHEN channel IS NULL THEN 'MISSING_CHANNEL' END, CASE WHEN channel NOT IN ('web', 'mobile_app', 'pos', 'atm', 'moto', 'recurring') THEN 'INVALID_CHANNEL' END,
    CASE WHEN amount < 0 THEN 'NEGATIVE_AMOUNT' END, CASE WHEN latitude * 3 NOT BETWEEN -90 AND 90 THEN 'LATITUDE_OUT_OF_RANGE' END) AS reasons FROM txn""",
    "txn",
)
def p13_validate_event(spark, sf_dir):
    extra = {"schema_version": F.lit("1.0"), "event_time": F.col("event_time_ts").cast("string"), "payment_method": F.lit("upi"), "source": F.lit("s"), "latitude": F.col("latitude") * 3}
    return clean.validate_event(load(spark, sf_dir, "txn").withColumns(extra)).select("transaction_id", F.array_join("reasons", ",").alias("reasons"))


@query(
    """SELECT transaction_id, round(ln(1 + abs(amount)), 6) AS feature_log_amount, CAST(hour(event_time_ts) AS INT) AS feature_hour_of_day, CAST(dayofweek(event_time_ts) + 1 AS INT) AS feature_day_of_week,
    CASE WHEN dayofweek(event_time_ts) IN (0, 6) THEN 1 ELSE 0 END AS feature_is_weekend, CASE WHEN hour(event_time_ts) < 6 THEN 1 ELSE 0 END AS feature_is_night, CASE WHEN card_id % 3 <> 0 THEN 1 ELSE 0 END AS feature_billing_shipping_mismatch,
    CASE WHEN abs(amount) < 10 THEN 'micro' WHEN abs(amount) < 100 THEN 'small' WHEN abs(amount) < 500 THEN 'medium' WHEN abs(amount) < 2000 THEN 'large' ELSE 'high_value' END AS feature_amount_bucket,
    sha256(CAST(card_id AS VARCHAR) || '||' || CAST(merchant_id AS VARCHAR)) AS feature_card_merchant_pair, CASE WHEN card_id % 2 = 0 THEN 4 ELSE 0 END AS feature_payment_method_idx, CASE WHEN merchant_id % 2 = 0 THEN 2 ELSE 0 END AS feature_channel_idx FROM txn""",
    "txn",
)
def p14_stateless_features(spark, sf_dir):
    df = load(spark, sf_dir, "txn").withColumns(
        {
            "amount": F.abs("amount"), "billing_country": F.lit("0"), "shipping_country": (F.col("card_id") % 3).cast("string"),
            "payment_method": F.when(F.col("card_id") % 2 == 0, " Wallet").otherwise("other"), "channel": F.when(F.col("merchant_id") % 2 == 0, "MOBILE_APP"),
        }
    )
    out = scalars.stateless_features(df)
    return rounded(out.select("transaction_id", *[c for c in out.columns if c.startswith("feature_")]))


@query(
    """WITH b AS (SELECT customer_id, avg(amount) AS m, stddev(amount) AS s FROM txn GROUP BY customer_id) SELECT transaction_id, round(CASE WHEN s > 0 THEN (amount - m) / s END, 4) AS z FROM txn JOIN b USING (customer_id)""",
    "txn",
)
def p21_amount_zscore(spark, sf_dir):
    txn = load(spark, sf_dir, "txn")
    base = aggregates.customer_baselines(txn, as_of()).select("customer_id", "avg_amount", "std_amount")
    return txn.join(base, "customer_id").select("transaction_id", F.round(scalars.amount_zscore(F.col("amount"), F.col("avg_amount"), F.col("std_amount")), 4).alias("z"))


@query(
    """SELECT transaction_id, sha256(CAST(device_id AS VARCHAR) || '||pepper') AS device_id, regexp_extract(ip, '^(\\d+\\.\\d+)', 1) || '.xxx.xxx' AS ip_masked, substr(ip, 1, 4) || '****' AS device_masked, substr(mail, 1, 2) || '***@' || regexp_extract(mail, '@(.+)$', 1) AS email_masked
    FROM (SELECT *, '10.' || merchant_id || '.7.9' AS ip, 'user' || card_id || '@mail.example' AS mail FROM txn)""",
    "txn",
)
def p23_hash_and_mask(spark, sf_dir):
    df = scalars.hash_pii(load(spark, sf_dir, "txn"), "pepper")
    scalars.assert_pii_hashed(df, 1.0)
    ip, mail = F.concat(F.lit("10."), F.col("merchant_id").cast("string"), F.lit(".7.9")), F.concat(F.lit("user"), F.col("card_id").cast("string"), F.lit("@mail.example"))
    return df.select("transaction_id", "device_id", scalars.mask_ip(ip).alias("ip_masked"), scalars.mask_device(ip).alias("device_masked"), scalars.mask_email(mail).alias("email_masked"))


@query(
    """SELECT transaction_id, CASE WHEN champion < 0.1 THEN 'approve' WHEN champion < 0.6 THEN 'step_up' WHEN champion <= 0.9 THEN 'manual_review' ELSE 'block' END AS decision_action,
    CASE WHEN champion < 0.1 OR champion > 0.9 THEN 'COMPLETED' ELSE 'PENDING_ASYNC' END AS status, CASE WHEN amount * 20 > 5000 THEN 0.85E0 WHEN amount * 20 > 1000 THEN 0.4E0 WHEN amount * 20 > 500 THEN 0.2E0 ELSE 0.05E0 END AS fallback FROM scores""",
    "scores",
)
def p27_decisions(spark, sf_dir):
    df = scalars.decide(load(spark, sf_dir, "scores").withColumnRenamed("champion", "fraud_probability"))
    return df.select("transaction_id", "decision_action", "status", scalars.fallback_score(F.col("amount") * 20).alias("fallback"))


@query(
    """SELECT transaction_id, CASE WHEN amount IS NULL THEN 'missing: amount' WHEN transaction_id % 13 = 0 THEN 'unreadable: fraud_probability' END AS error,
    CASE WHEN amount IS NULL OR transaction_id % 13 = 0 THEN 'approve_fallback' WHEN champion < 0.1 THEN 'approve' WHEN champion < 0.6 THEN 'step_up' WHEN champion <= 0.9 THEN 'manual_review' ELSE 'block' END AS decision_action
    FROM txn JOIN (SELECT transaction_id, champion FROM scores) USING (transaction_id)""",
    "scores",
)
def p28_decision_input(spark, sf_dir):
    p = F.when(F.col("transaction_id") % 13 == 0, "n/a").otherwise(F.col("champion").cast("string"))
    df = load(spark, sf_dir, "txn").join(load(spark, sf_dir, "scores").select("transaction_id", "champion"), "transaction_id").withColumn("fraud_probability", p)
    return scalars.decision_input_check(df).select("transaction_id", "error", "decision_action")


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'MACHINERY' THEN 'industry' ELSE c_mktsegment END AS c_mktsegment_standard FROM customer")
def p34_map_category(spark, sf_dir):
    lookup = spark.createDataFrame([("building", "construction"), ("machinery", "industry")], "raw string, standard string")
    return scalars.map_category(load(spark, sf_dir, "customer"), lookup, "c_mktsegment").select("c_custkey", "c_mktsegment_standard")


@query(
    """SELECT transaction_id, CASE WHEN dayofweek(event_time_ts) IN (5, 6) THEN 1 ELSE 0 END AS is_weekend, CASE WHEN hour(event_time_ts) < 6 THEN 1 ELSE 0 END AS is_night, CASE WHEN device_id IS NULL THEN 0 ELSE 1 END AS has_identity,
    coalesce(amount, -999) AS amount, round(CASE WHEN amount < 0 THEN 0 ELSE coalesce(amount, 0) END, 6) AS first_feature FROM txn""",
    "txn",
)
def p30_vector_and_flags(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    df = load(spark, sf_dir, "txn").withColumns({"event_hour": F.hour("event_time_ts"), "event_day_of_week": F.dayofweek("event_time_ts") - 1, "device_type": F.col("device_id")})
    df = df.withColumn("feature_amount", F.when(F.col("amount") < 0, float("inf")).otherwise(F.col("amount")))
    out = clean.impute_constants(clean.derived_batch_flags(scalars.feature_vector(df, scalars.feature_columns(df))), numeric=["amount"])
    return out.select("transaction_id", "is_weekend", "is_night", "has_identity", "amount", F.round(vector_to_array("features")[0], 6).alias("first_feature"))


# Quality --------------------------------------------------------------------

_GATED = "SELECT *, CASE WHEN order_id % 9 = 0 THEN NULL WHEN order_id % 10 = 0 THEN 0 ELSE transaction_amt END AS amt, CAST(order_id % 50 AS INT) - 1 AS dt, CASE WHEN order_id % 17 = 0 THEN NULL ELSE product_cd END AS pc FROM txn_wide"
_REASONS = """concat_ws('; ', CASE WHEN amt IS NULL THEN 'NULL_AMOUNT' END, CASE WHEN amt <= 0 THEN 'NON_POSITIVE_AMOUNT' END, CASE WHEN dt < 0 THEN 'NEGATIVE_TRANSACTION_DT' END, CASE WHEN pc IS NULL OR pc NOT IN ('R', 'N') THEN 'INVALID_PRODUCT_CD' END)"""


def _gated(spark, sf_dir):
    key = F.col("order_id")
    amount = F.when(key % 9 == 0, None).when(key % 10 == 0, 0).otherwise(F.col("transaction_amt"))
    df = load(spark, sf_dir, "txn_wide").withColumns({"transaction_amt": amount, "transaction_dt": (key % 50).cast("int") - 1, "product_cd": F.when(key % 17 != 0, F.col("product_cd"))})
    return df, quality.wide_reject_rules(products=("R", "N"))


@query(f"SELECT _rejection_reason, _gate, count(*) AS n FROM (SELECT {_REASONS} AS _rejection_reason, 'bronze_to_silver' AS _gate FROM ({_GATED})) WHERE _rejection_reason <> '' GROUP BY 1, 2", "txn_wide")
def g1_rejected_rows(spark, sf_dir):
    return quality.reject_rows(*_gated(spark, sf_dir))[1].groupBy("_rejection_reason", "_gate").agg(F.count("*").alias("n"))


@query(f"SELECT flags AS _quality_flags, count(*) AS n FROM (SELECT {_REASONS} AS r, concat_ws('; ', CASE WHEN amt >= 50000 THEN 'HIGH_AMOUNT' END, CASE WHEN dt IS NULL THEN 'NO_DT' END) AS flags FROM ({_GATED})) WHERE r = '' GROUP BY 1", "txn_wide")
def g2_flagged_rows(spark, sf_dir):
    good, _ = quality.reject_rows(*_gated(spark, sf_dir))
    return quality.flag_rows(good, {"HIGH_AMOUNT": F.col("transaction_amt") >= 50000, "NO_DT": F.col("transaction_dt").isNull()}).groupBy("_quality_flags").agg(F.count("*").alias("n"))


@query(f"SELECT count(*) AS total_rows, count_if(r = '') AS clean_rows, count_if(r <> '') AS rejected_rows, round(count_if(r <> '') / count(*), 6) AS rejection_rate FROM (SELECT {_REASONS} AS r FROM ({_GATED}))", "txn_wide")
def g3_gate_report(spark, sf_dir):
    return rounded(quality.gate_report(*_gated(spark, sf_dir)))


@query(
    f"""WITH g AS ({_GATED}), u AS (SELECT transaction_id, count(*) AS n FROM g GROUP BY 1)
    SELECT * FROM (SELECT 'complete(transaction_id)' AS "check", 'Error' AS level, round(count(transaction_id) / count(*), 6) AS value, count(transaction_id) = count(*) AS passed FROM g
    UNION ALL SELECT 'non_negative(transaction_amt)', 'Error', round(count_if(amt IS NULL OR amt >= 0) / count(*), 6), count_if(amt < 0) = 0 FROM g
    UNION ALL SELECT 'amount_positive', 'Error', round(count_if(amt > 0) / count(*), 6), count_if(amt > 0) / count(*) >= 0.999 FROM g
    UNION ALL SELECT 'contained(product_cd)', 'Error', round(count_if(pc IS NULL OR pc IN ('W', 'H', 'C', 'S', 'R')) / count(*), 6), count_if(pc NOT IN ('W', 'H', 'C', 'S', 'R')) = 0 FROM g
    UNION ALL SELECT 'contained(is_fraud)', 'Error', 1.0, true UNION ALL SELECT 'completeness(product_cd)', 'Warning', round(count(pc) / count(*), 6), count(pc) / count(*) >= 0.9 FROM g
    UNION ALL SELECT 'unique(transaction_id)', 'Error', round(count_if(n = 1) / count(*), 6), count_if(n > 1) = 0 FROM u)""",
    "txn_wide",
)
def g11_check_suite(spark, sf_dir):
    df, _ = _gated(spark, sf_dir)
    return rounded(quality.run_checks(df, [*quality.wide_error_checks(), quality.has_completeness("product_cd", 0.9)], unique=["transaction_id"]))


@query(
    """SELECT 'amount' AS "column", count(*) AS size, round(count(amount) / count(*), 6) AS completeness, count(DISTINCT amount) AS "distinct", round(avg(amount), 6) AS mean, round(stddev(amount), 6) AS deviation, round(min(amount), 6) AS low, round(max(amount), 6) AS high FROM txn
    UNION ALL SELECT 'channel', count(*), round(count(channel) / count(*), 6), count(DISTINCT channel), NULL, NULL, NULL, NULL FROM txn""",
    "txn",
)
def g10_profile(spark, sf_dir):
    return rounded(quality.profile(load(spark, sf_dir, "txn"), ["amount", "channel"]))


@query("SELECT count(*) AS rows, count(DISTINCT transaction_id) AS keys, round(avg(is_fraud), 6) AS fraud_rate, count(*) > 0 AS not_empty, count(*) = count(DISTINCT transaction_id) AS unique_key, avg(is_fraud) BETWEEN 0.0001 AND 0.10 AS rate_in_band FROM txn_wide", "txn_wide")
def g12_validate_silver(spark, sf_dir):
    return rounded(quality.validate_silver(load(spark, sf_dir, "txn_wide")))


@query("SELECT 'bronze' AS layer, count(*) AS rows, CAST(NULL AS DOUBLE) AS fraud_rate, true AS passed FROM events UNION ALL SELECT 'silver', count(*), round(avg(is_fraud), 6), true FROM txn", "txn")
def g13_layer_checks(spark, sf_dir):
    return rounded(quality.layer_checks({"bronze": load(spark, sf_dir, "events"), "silver": load(spark, sf_dir, "txn")}))


@query("SELECT count(*) AS rows, count(DISTINCT transaction_id) AS keys, count(*) - count(DISTINCT transaction_id) AS duplicates FROM txn_wide", "txn_wide")
def g14_duplicate_audit(spark, sf_dir):
    return quality.duplicate_audit(load(spark, sf_dir, "txn_wide"))


# Joins ----------------------------------------------------------------------


@query("SELECT w.transaction_id, w.order_id, w.transaction_amt, i.device_type FROM txn_wide w LEFT JOIN identity i USING (order_id)", "txn_wide", "identity")
def j1_identity_join(spark, sf_dir):
    return joins.join_identity(load(spark, sf_dir, "txn_wide"), load(spark, sf_dir, "identity"), "order_id").select("transaction_id", "order_id", "transaction_amt", "device_type")


_ASOF = """SELECT t.transaction_id, f.feature_value, f.feature_timestamp FROM txn t LEFT JOIN LATERAL (SELECT * FROM features f WHERE f.card_id = t.card_id AND f.feature_timestamp <= t.event_time_ts
    AND f.feature_timestamp >= t.event_time_ts - INTERVAL {0} SECOND ORDER BY f.feature_timestamp DESC, f.feature_id DESC LIMIT 1) f ON true"""


@query(_ASOF.format(86400), "txn", "features")
def j2_asof_join(spark, sf_dir):
    out = joins.asof_join(load(spark, sf_dir, "txn"), load(spark, sf_dir, "features"), "card_id", 86400, tie=["feature_id"])
    return out.select("transaction_id", "feature_value", "feature_timestamp")


@query(_ASOF.format(3600), "txn", "features")
def j2_asof_join_bucketed(spark, sf_dir):
    out = joins.asof_join(load(spark, sf_dir, "txn"), load(spark, sf_dir, "features"), "card_id", 3600, tie=["feature_id"], bucketed=True)
    return out.select("transaction_id", "feature_value", "feature_timestamp")


@query(
    """SELECT t.transaction_id, a.feature_value AS last_hour, b.feature_value AS last_day FROM txn t
    LEFT JOIN LATERAL (SELECT feature_value FROM features f WHERE f.card_id = t.card_id AND f.feature_timestamp <= t.event_time_ts AND f.feature_timestamp >= t.event_time_ts - INTERVAL 3600 SECOND ORDER BY f.feature_timestamp DESC LIMIT 1) a ON true
    LEFT JOIN LATERAL (SELECT feature_value FROM features f WHERE f.card_id = t.card_id AND f.feature_timestamp <= t.event_time_ts AND f.feature_timestamp >= t.event_time_ts - INTERVAL 86400 SECOND ORDER BY f.feature_timestamp DESC LIMIT 1) b ON true""",
    "txn",
    "features",
)
def j3_multi_asof_join(spark, sf_dir):
    f = load(spark, sf_dir, "features")
    out = joins.multi_asof_join(load(spark, sf_dir, "txn"), [(f.select("card_id", "feature_timestamp", F.col("feature_value").alias("last_hour")), "card_id", 3600), (f.select("card_id", "feature_timestamp", F.col("feature_value").alias("last_day")), "card_id")])
    return out.select("transaction_id", "last_hour", "last_day")


def _window_sql(key: str, length: str, step: int, count: int, measures: str, name: str) -> str:
    """Sliding windows that hold each event: those whose start is one of the last ``count`` steps."""
    return f"""{name} AS (SELECT {key}, s + INTERVAL {length} AS feature_timestamp, {measures} FROM (SELECT *, unnest([to_timestamp((epoch_us(event_time_ts) // {step}000000 - i) * {step})::TIMESTAMP FOR i IN range({count})]) AS s FROM txn) GROUP BY {key}, s)"""


_FIVE = _window_sql("card_id", "'5 minutes'", 60, 5, "count(*) AS card_5m_count, round(avg(amount), 4) AS card_5m_avg, round(coalesce(stddev(amount), 0), 4) AS card_5m_std, round(max(amount), 4) AS card_5m_max, round(sum(amount), 4) AS card_5m_sum", "a")
_HOUR = _window_sql("card_id", "'1 hour'", 300, 12, "count(*) AS card_1h_count, round(sum(amount), 4) AS card_1h_sum", "b")


@query(f"WITH {_FIVE} SELECT * FROM a", "txn")
def t2_card_velocity_5m(spark, sf_dir):
    return rounded(_naive(windows.card_velocity_5m(load(spark, sf_dir, "txn"))), 4)


@query(f"WITH {_HOUR} SELECT * FROM b", "txn")
def t3_card_velocity_1h(spark, sf_dir):
    return rounded(_naive(windows.card_velocity_1h(load(spark, sf_dir, "txn"))), 4)


@query("WITH " + _window_sql("customer_id", "'1 hour'", 300, 12, "count(*) AS customer_1h_count, round(sum(amount), 4) AS customer_1h_sum, round(avg(amount), 4) AS customer_1h_avg, count(DISTINCT merchant_id) AS customer_1h_distinct_merchant_id", "c") + " SELECT * FROM c", "txn")
def t4_customer_velocity_1h(spark, sf_dir):
    return rounded(_naive(windows.customer_velocity_1h(load(spark, sf_dir, "txn"), exact=True)), 4)


@query("WITH " + _window_sql("customer_id", "'1 hour'", 300, 12, "count(*) AS customer_1h_count, round(sum(amount), 4) AS customer_1h_sum, round(avg(amount), 4) AS customer_1h_avg, count(DISTINCT merchant_id) AS customer_1h_distinct_merchant_id", "c") + " SELECT * FROM c", "txn")
def t4_customer_velocity_panes(spark, sf_dir):
    """The same windows put together from panes; counts of few distinct values are exact from sketches too."""
    return rounded(_naive(windows.velocity_by_panes(load(spark, sf_dir, "txn"), "customer_id", "1 hour", "5 minutes", "customer_1h_", distinct="merchant_id")), 4)


@query("WITH " + _window_sql("customer_id", "'24 hours'", 86400, 1, "count(*) AS customer_24h_count, round(sum(amount), 4) AS customer_24h_sum, count(DISTINCT device_id) AS customer_24h_distinct_device_id", "d") + " SELECT * FROM d", "txn")
def t5_customer_velocity_24h(spark, sf_dir):
    return rounded(_naive(windows.customer_velocity_24h(load(spark, sf_dir, "txn"), exact=True)), 4)


@query(f"WITH {_FIVE}, {_HOUR} SELECT card_id, feature_timestamp, card_5m_count, card_5m_sum, card_1h_count, card_1h_sum FROM a FULL JOIN b USING (card_id, feature_timestamp)", "txn")
def j4_merged_families(spark, sf_dir):
    txn = load(spark, sf_dir, "txn")
    merged = joins.merge_families([windows.card_velocity_5m(txn), windows.card_velocity_1h(txn)], ["card_id", "feature_timestamp"])
    return rounded(_naive(merged).select("card_id", "feature_timestamp", "card_5m_count", "card_5m_sum", "card_1h_count", "card_1h_sum"), 4)


def _naive(df: DataFrame) -> DataFrame:
    return df.withColumn("feature_timestamp", F.col("feature_timestamp").cast("timestamp_ntz"))


@query(f"WITH {_RECONCILED} SELECT * FROM r", "txn")
def d1_reconcile_labels(spark, sf_dir):
    return _reconciled(spark, sf_dir).select("transaction_id", "is_fraud_reconciled", "label_source", "label_confidence")


@query(f"WITH {_RECONCILED} SELECT s.transaction_id, s.champion, r.is_fraud_reconciled FROM scores s JOIN r USING (transaction_id) WHERE is_fraud_reconciled IS NOT NULL", "scores")
def j6_decisions_with_labels(spark, sf_dir):
    return joins.decisions_with_labels(load(spark, sf_dir, "scores").select("transaction_id", "champion"), _reconciled(spark, sf_dir).select("transaction_id", "is_fraud_reconciled"))


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def w2_latest_per_key(spark, sf_dir):
    return joins.latest_per_key(load(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_orderkey").select("o_orderkey", "o_custkey", "o_orderdate")


@query("SELECT DISTINCT c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT CAST(o_custkey % 20 AS INT) FROM orders)")
def j9_new_rows(spark, sf_dir):
    target = load(spark, sf_dir, "orders").select((F.col("o_custkey") % 20).cast("int").alias("c_nationkey"))
    return joins.new_rows(load(spark, sf_dir, "customer").select("c_nationkey"), target, ["c_nationkey"])


@query(
    """WITH l AS (SELECT order_id, count(*) AS l FROM txn_wide GROUP BY 1), r AS (SELECT order_id, count(*) AS r FROM identity GROUP BY 1), b AS (SELECT * FROM l FULL JOIN r USING (order_id))
    SELECT count_if(l IS NOT NULL AND r IS NOT NULL) AS matched, count_if(r IS NULL) AS left_only, count_if(l IS NULL) AS orphans, count_if(l > 1) AS left_repeated, count_if(r > 1) AS right_repeated, round(count_if(l IS NOT NULL AND r IS NOT NULL) / count_if(l IS NOT NULL), 6) AS coverage FROM b""",
    "txn_wide",
    "identity",
)
def j10_key_coverage(spark, sf_dir):
    return rounded(joins.key_coverage(load(spark, sf_dir, "txn_wide"), load(spark, sf_dir, "identity"), "order_id"))


# Windows and order ----------------------------------------------------------


@query(
    """WITH o AS (SELECT *, lag(latitude) OVER w AS pla, lag(longitude) OVER w AS plo, lag(event_time_ts) OVER w AS pt FROM txn WINDOW w AS (PARTITION BY card_id ORDER BY event_time_ts, transaction_id)),
    d AS (SELECT transaction_id, CASE WHEN pla IS NOT NULL AND latitude IS NOT NULL THEN 2 * 6371.0 * atan2(sqrt(h), sqrt(1 - h)) ELSE 0 END AS km, CASE WHEN pt IS NULL THEN 0 ELSE (epoch_us(event_time_ts) - epoch_us(pt)) / 3600e6 END AS hrs
    FROM (SELECT *, pow(sin(radians(latitude - pla) / 2), 2) + cos(radians(pla)) * cos(radians(latitude)) * pow(sin(radians(longitude - plo) / 2), 2) AS h FROM o))
    SELECT transaction_id, round(km, 3) AS distance_km, round(hrs, 6) AS time_delta_hours, round(CASE WHEN hrs > 0.001 THEN km / hrs ELSE 0 END, 2) AS velocity_kmh, CASE WHEN hrs > 0.001 AND km / hrs > 900 THEN 1 ELSE 0 END AS is_impossible_travel FROM d""",
    "txn",
)
def w1_geo_velocity(spark, sf_dir):
    out = windows.geo_velocity(load(spark, sf_dir, "txn"))
    return out.select("transaction_id", F.round("distance_km", 3).alias("distance_km"), F.round("time_delta_hours", 6).alias("time_delta_hours"), F.round("velocity_kmh", 2).alias("velocity_kmh"), "is_impossible_travel")


@query(
    """SELECT transaction_id, CASE WHEN r <= CAST(trunc(n * 0.7) AS BIGINT) THEN 'train' WHEN r <= CAST(trunc(n * 0.85) AS BIGINT) THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT transaction_id, row_number() OVER (ORDER BY event_time_ts, transaction_id) AS r, count(*) OVER () AS n FROM txn)""",
    "txn",
)
def w3_chronological_split(spark, sf_dir):
    return windows.chronological_split(load(spark, sf_dir, "txn")).select("transaction_id", "split")


@query(
    """WITH a AS (SELECT epoch_us(event_time_ts) // 1000000 AS e, is_fraud FROM txn), q AS (SELECT quantile_cont(e, 0.8) AS cut FROM a)
    SELECT CASE WHEN e <= cut THEN 'before' ELSE 'after' END AS side, count(*) AS rows, round(avg(is_fraud), 6) AS fraud_rate FROM a, q GROUP BY 1""",
    "txn",
)
def w4_quantile_cutoff(spark, sf_dir):
    return rounded(windows.quantile_cutoff(load(spark, sf_dir, "txn"), F.unix_timestamp(F.col("event_time_ts").cast("timestamp"))))


@query("SELECT transaction_id, event_time_ts FROM txn ORDER BY event_time_ts DESC, transaction_id DESC LIMIT 1", "txn")
def w6_latest_row(spark, sf_dir):
    return windows.latest_row(load(spark, sf_dir, "txn"), "event_time_ts", "transaction_id").select("transaction_id", "event_time_ts")


@query("SELECT transaction_id, channel FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY md5('7:' || transaction_id)) AS r, count(*) OVER (PARTITION BY channel) AS n FROM txn) WHERE r <= round(0.05 * n)", "txn")
def w8_stratified_sample(spark, sf_dir):
    """A twentieth of the rows of each channel, by hash, of exact size."""
    return windows.exact_sample(load(spark, sf_dir, "txn"), "transaction_id", ["channel"], share=0.05, seed=7).select("transaction_id", "channel")


@query("SELECT transaction_id FROM txn ORDER BY md5('3:' || transaction_id) LIMIT 1000", "txn")
def w8_sample_of_size(spark, sf_dir):
    return windows.exact_sample(load(spark, sf_dir, "txn"), "transaction_id", n=1000, seed=3).select("transaction_id")


@query("SELECT merchant_id, count(*) AS rows, round(avg(is_fraud), 6) AS fraud_rate, round(count(*) / (SELECT count(*) FROM txn), 6) AS share FROM txn GROUP BY merchant_id ORDER BY rows DESC, merchant_id LIMIT 10", "txn")
def w7_top_levels(spark, sf_dir):
    return rounded(windows.top_levels(load(spark, sf_dir, "txn"), "merchant_id", 10))


@query(
    """SELECT transaction_id, champion FROM (SELECT transaction_id, champion, event_date FROM scores) WHERE champion >= 0.6 AND champion <= 0.9 ORDER BY event_date DESC, transaction_id DESC LIMIT 50""",
    "scores",
)
def w10_case_queue(spark, sf_dir):
    cases = load(spark, sf_dir, "scores").withColumns({"case_status": F.lit("OPEN"), "decision_action": scalars.classify_decision(F.col("champion"))})
    return windows.case_queue(cases, "OPEN", "manual_review", 50, "event_date", "transaction_id").select("transaction_id", "champion")


# Table maintenance ----------------------------------------------------------


def _half_new(key: str):
    """Even keys as they are, odd ones negated: a batch of all rows, of which half have known keys."""
    return F.when(F.col(key) % 2 == 0, F.col(key)).otherwise(-F.col(key)).alias(key)


_HALF_NEW = "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE -o_orderkey END"


@query(f"WITH b AS (SELECT {_HALF_NEW} AS o_orderkey, -o_totalprice AS o_totalprice FROM orders) SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT * FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def m1_insert_new(spark, sf_dir):
    """All orders take in a batch of all orders, each twice, half of them of known keys."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    batch = orders.select(_half_new("o_orderkey"), (-F.col("o_totalprice")).alias("o_totalprice"))
    return merge.insert_new(orders, batch.unionByName(batch), ["o_orderkey"])


@query(f"WITH b AS (SELECT {_HALF_NEW} AS o_orderkey, -o_totalprice AS o_totalprice FROM orders) SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b) UNION ALL SELECT * FROM b")
def m2_upsert_all(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return merge.upsert_all(orders, orders.select(_half_new("o_orderkey"), (-F.col("o_totalprice")).alias("o_totalprice")), ["o_orderkey"])


_EARLY = _RECONCILED.replace("DATE '2024-02-05'", "DATE '2024-01-31'")


@query(
    f"""WITH {_RECONCILED}, e AS (WITH {_EARLY} SELECT * FROM r) SELECT transaction_id, CASE WHEN take THEN ny ELSE oy END AS is_fraud_reconciled, CASE WHEN take THEN ns ELSE os END AS label_source, CASE WHEN take THEN nc ELSE oc END AS label_confidence FROM (
    SELECT r.transaction_id, r.is_fraud_reconciled AS ny, r.label_source AS ns, r.label_confidence AS nc, e.is_fraud_reconciled AS oy, e.label_source AS os, e.label_confidence AS oc,
    r.label_confidence > e.label_confidence OR (e.is_fraud_reconciled IS NULL AND r.is_fraud_reconciled IS NOT NULL AND r.label_confidence = e.label_confidence) AS take FROM r JOIN e USING (transaction_id))""",
    "txn",
)
def m3_upsert_if(spark, sf_dir):
    columns = ["transaction_id", "is_fraud_reconciled", "label_source", "label_confidence"]
    early, late = (_reconciled(spark, sf_dir, day).select(*columns) for day in (F.expr("TIMESTAMP_NTZ '2024-01-31 00:00:00'"), None))
    return merge.upsert_if(early, late, ["transaction_id"], merge.labels_condition())


_ACTION = "CASE WHEN p < 0.1 THEN 'approve' WHEN p < 0.6 THEN 'step_up' WHEN p <= 0.9 THEN 'manual_review' ELSE 'block' END"
#: d: the batch's decisions, of known transactions where even; c: the cases after it.
_CASES = f"""d AS (SELECT CASE WHEN transaction_id % 2 = 0 THEN transaction_id ELSE -transaction_id END AS transaction_id, champion AS p FROM scores),
    c AS (SELECT s.transaction_id, coalesce(d.p, s.challenger) AS p, 'IN_REVIEW' AS case_status FROM scores s LEFT JOIN d USING (transaction_id)
    UNION ALL SELECT d.transaction_id, d.p, 'OPEN' FROM d ANTI JOIN scores USING (transaction_id))"""


def _cases(spark, sf_dir):
    """A case of each transaction, in review, and a batch of a decision of each, half of them of new transactions."""
    scored = load(spark, sf_dir, "scores")
    shape = lambda key, p: scored.select(key, F.col(p).alias("fraud_probability"), F.lit("full").alias("scoring_mode"), scalars.classify_decision(F.col(p)).alias("decision_action"), F.lit("v1").alias("model_version"))
    at = as_of()
    known = shape("transaction_id", "challenger").select("*", F.sha2(F.concat(F.lit("case:"), F.col("transaction_id").cast("string")), 256).alias("case_id"), F.lit("IN_REVIEW").alias("case_status"), at.alias("created_at"), at.alias("updated_at"))
    return merge.upsert_cases(known, shape(_half_new("transaction_id"), "champion"), at)


@query(f"WITH {_CASES} SELECT transaction_id, p AS fraud_probability, {_ACTION} AS decision_action, case_status FROM c", "scores")
def m6_upsert_cases(spark, sf_dir):
    return _cases(spark, sf_dir)[0].select("transaction_id", "fraud_probability", "decision_action", "case_status")


@query(
    f"WITH {_CASES} SELECT sha256('case:' || transaction_id) AS case_id, CASE WHEN transaction_id IN (SELECT transaction_id FROM scores) THEN 'MODEL_SCORE_UPDATED' ELSE 'CASE_CREATED' END AS event_type, {_ACTION} AS decision_action, 'SYSTEM' AS created_by FROM d",
    "scores",
)
def m6_case_events(spark, sf_dir):
    return _cases(spark, sf_dir)[1].select("case_id", "event_type", F.get_json_object("event_data", "$.decision_action").alias("decision_action"), "created_by")


def _statuses(spark, sf_dir):
    """An update for each case, of which four fifths name a case that doesn't exist."""
    cases = _cases(spark, sf_dir)[0]
    named = F.when(F.col("transaction_id") % 5 == 0, F.col("case_id")).otherwise(F.concat(F.lit("no "), F.col("case_id")))
    updates = cases.select(named.alias("case_id"), F.lit("CLOSED").alias("new_status"), F.lit("ana").alias("updated_by"), F.lit("ok").alias("notes"))
    return merge.update_case_status(cases, updates, as_of())


@query(f"WITH {_CASES} SELECT transaction_id, CASE WHEN transaction_id % 5 = 0 THEN 'CLOSED' ELSE case_status END AS case_status FROM c", "scores")
def m7_update_case_status(spark, sf_dir):
    return _statuses(spark, sf_dir)[0].select("transaction_id", "case_status")


@query(
    f"WITH {_CASES} SELECT sha256('case:' || transaction_id) AS case_id, CASE WHEN transaction_id % 5 = 0 THEN 'CLOSED' ELSE 'OPEN' END AS status FROM c WHERE case_status = 'OPEN' OR transaction_id % 5 = 0",
    "scores",
)
def m8_case_state(spark, sf_dir):
    created, changed = _cases(spark, sf_dir)[1], _statuses(spark, sf_dir)[1].withColumn("created_at", F.expr("TIMESTAMP_NTZ '2024-02-06 00:00:00'"))
    return merge.case_state_from_events(created.unionByName(changed)).select("case_id", "status")


# Graph ----------------------------------------------------------------------

_EDGES = """e AS (SELECT DISTINCT 'customer:' || customer_id AS src, 'card:' || card_id AS dst, 'OWNS_CARD' AS relationship FROM txn UNION ALL SELECT DISTINCT 'customer:' || customer_id, 'device:' || device_id, 'USED_DEVICE' FROM txn WHERE device_id IS NOT NULL),
    v AS (SELECT DISTINCT src AS id FROM e UNION SELECT DISTINCT dst FROM e)"""


def _graph(spark, sf_dir):
    """The graph of all transactions."""
    return graph.build_entity_graph(load(spark, sf_dir, "txn"))


def also_whole(f):
    """Register the query under its name with ``_whole`` too, which it had while another read fewer rows."""
    QUERIES[f"{f.__name__}_whole"], ORACLES[f"{f.__name__}_whole"] = f, ORACLES[f.__name__]
    return f


@also_whole
@query(f"WITH {_EDGES} SELECT src, dst, relationship FROM e", "txn")
def r1_entity_edges(spark, sf_dir):
    return _graph(spark, sf_dir)[1]


@also_whole
@query(f"WITH {_EDGES} SELECT id, split_part(id, ':', 1) AS type FROM v", "txn")
def r1_entity_vertices(spark, sf_dir):
    return _graph(spark, sf_dir)[0]


def _rank_ctes() -> str:
    steps = ["o AS (SELECT src, count(*) AS n FROM e GROUP BY src)", "r0 AS (SELECT id, 1.0E0 AS rank FROM v)"]
    for i in range(1, 6):
        steps.append(f"r{i} AS (SELECT v.id, 0.15E0 + 0.85E0 * coalesce(sum(r.rank / o.n), 0) AS rank FROM v LEFT JOIN e ON e.dst = v.id LEFT JOIN r{i - 1} r ON r.id = e.src LEFT JOIN o ON o.src = e.src GROUP BY v.id)")
    return ", ".join([*steps, "pr AS (SELECT id, round(rank * (SELECT count(*) FROM r5) / (SELECT sum(rank) FROM r5), 6) AS rank FROM r5)"])


_DEGREES = "d AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) GROUP BY id)"
_COMPONENTS = f"WITH RECURSIVE {_EDGES}, b AS (SELECT src AS x, dst AS y FROM e UNION SELECT dst, src FROM e), reach AS (SELECT id AS a, id AS z FROM v UNION SELECT reach.a, b.y FROM reach JOIN b ON b.x = reach.z), c AS (SELECT a AS id, min(z) AS component FROM reach GROUP BY a)"


@also_whole
@query(f"WITH {_EDGES}, {_rank_ctes()} SELECT id, rank FROM pr", "txn")
def r2_pagerank(spark, sf_dir):
    return rounded(graph.pagerank(*_graph(spark, sf_dir)))


@also_whole
@query(f"WITH {_EDGES}, {_DEGREES} SELECT id, degree FROM d", "txn")
def r3_degrees(spark, sf_dir):
    return graph.degrees(_graph(spark, sf_dir)[1])


@also_whole
@query(f"{_COMPONENTS} SELECT id, component FROM c", "txn")
def r4_connected_components(spark, sf_dir):
    return graph.connected_components(_graph(spark, sf_dir)[1])


@also_whole
@query(f"{_COMPONENTS}, {_DEGREES}, {_rank_ctes()} SELECT id, rank, degree, component, DATE '2024-02-05' AS snapshot_date FROM v JOIN c USING (id) JOIN d USING (id) JOIN pr USING (id)", "txn")
def r5_entity_metrics(spark, sf_dir):
    return rounded(graph.entity_metrics(*_graph(spark, sf_dir), "2024-02-05"))


def _sharing_sql(entity: str, member: str, hours: int) -> str:
    return f"SELECT t.transaction_id, t.{entity}, t.event_time_ts, count(DISTINCT o.{member}) AS sharing_count FROM txn t JOIN txn o ON o.{entity} = t.{entity} AND epoch_us(o.event_time_ts) // 1000000 BETWEEN epoch_us(t.event_time_ts) // 1000000 - {hours * 3600} AND epoch_us(t.event_time_ts) // 1000000 GROUP BY 1, 2, 3"


@query(_sharing_sql("device_id", "customer_id", 24), "txn")
def r6_device_sharing(spark, sf_dir):
    return graph.sharing_count(load(spark, sf_dir, "txn"), "device_id", "customer_id", 24)


@query(_sharing_sql("ip_address", "card_id", 1).replace("txn", "txn_ip"), "txn_ip")
def r7_ip_sharing(spark, sf_dir):
    return graph.sharing_count(load(spark, sf_dir, "txn_ip"), "ip_address", "card_id", 1)


# Drift and model quality ------------------------------------------------------

_SIDES = """x AS (SELECT 'amount' AS feature, event_date < DATE '2024-01-16' AS ref, amount AS v FROM txn WHERE amount IS NOT NULL UNION ALL SELECT 'merchant_id', event_date < DATE '2024-01-16', CAST(merchant_id AS DOUBLE) FROM txn),
    nn AS (SELECT feature, count(*) FILTER (ref) AS rn, count(*) FILTER (NOT ref) AS cn FROM x GROUP BY feature)"""
_PSI = """q AS (SELECT feature, quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM x WHERE ref GROUP BY feature),
    pb AS (SELECT x.feature, len(list_filter(e, lambda y: y <= v)) AS b, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM x JOIN q ON x.feature = q.feature GROUP BY 1, 2),
    pe AS (SELECT nn.feature, b, coalesce(r, 0) / rn + 1e-6 AS e, coalesce(c, 0) / cn + 1e-6 AS a FROM nn CROSS JOIN range(10) t(b) LEFT JOIN pb USING (feature, b)),
    psi AS (SELECT feature, sum((a - e) * ln(a / e)) AS psi FROM pe GROUP BY feature)"""
_JSD = """sp AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM x GROUP BY feature),
    jb AS (SELECT x.feature, CAST(least(49, floor((v - lo) / ((hi - lo) / 50))) AS INT) AS b, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM x JOIN sp USING (feature) GROUP BY 1, 2),
    jd AS (SELECT feature, coalesce(r, 0) / (rn * (hi - lo) / 50) + 1e-10 AS p, coalesce(c, 0) / (cn * (hi - lo) / 50) + 1e-10 AS q FROM nn JOIN sp USING (feature) CROSS JOIN range(50) t(b) LEFT JOIN jb USING (feature, b)),
    js AS (SELECT feature, p / sum(p) OVER (PARTITION BY feature) AS p, q / sum(q) OVER (PARTITION BY feature) AS q FROM jd),
    jsd AS (SELECT feature, greatest(0, sum(p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))) / 2) AS jsd FROM js GROUP BY feature)"""
_KS = """kc AS (SELECT feature, v, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM x GROUP BY 1, 2),
    kw AS (SELECT feature, sum(r) OVER w AS r, sum(c) OVER w AS c FROM kc WINDOW w AS (PARTITION BY feature ORDER BY v)),
    kd AS (SELECT feature, max(abs(r / rn - c / cn)) AS d, max(rn * cn / (rn + cn)) AS en FROM kw JOIN nn USING (feature) GROUP BY feature),
    ks AS (SELECT feature, d AS ks_stat, CASE WHEN d = 0 THEN 1 ELSE greatest(0, least(1, list_sum([2 * pow(-1, k - 1) * exp(-2 * k * k * d * d * en) FOR k IN range(1, 101)]))) END AS ks_p_value FROM kd)"""
_REPORT = f"""{_SIDES}, {_PSI}, {_JSD}, {_KS}, rep AS (SELECT feature, round(psi, 4) AS psi, round(ks_stat, 4) AS ks_stat, round(ks_p_value, 6) AS ks_p_value, round(jsd, 4) AS jsd, rn AS ref_n, cn AS cur_n,
    CASE WHEN psi >= 0.25 OR (ks_stat >= 0.1 AND ks_p_value < 0.001) OR jsd >= 0.15 THEN 'CRITICAL_DRIFT' WHEN psi >= 0.1 OR (ks_stat >= 0.05 AND ks_p_value < 0.01) OR jsd >= 0.05 THEN 'WARNING' ELSE 'STABLE' END AS status
    FROM psi JOIN ks USING (feature) JOIN jsd USING (feature) JOIN nn USING (feature))"""


def _halves(spark, sf_dir, name: str = "txn"):
    df = load(spark, sf_dir, name)
    return df.filter("event_date < DATE '2024-01-16'"), df.filter("event_date >= DATE '2024-01-16'")


def _long(spark, sf_dir):
    return drift.long_form(*_halves(spark, sf_dir), ["amount", "merchant_id"])


@query(f"WITH {_SIDES}, {_PSI} SELECT feature, round(psi, 6) AS psi FROM psi", "txn")
def d2_psi(spark, sf_dir):
    return rounded(drift.psi(_long(spark, sf_dir)))


@query(f"WITH {_SIDES}, {_JSD} SELECT feature, round(jsd, 6) AS jsd FROM jsd", "txn")
def d3_jsd(spark, sf_dir):
    return rounded(drift.jsd(_long(spark, sf_dir)))


@query(f"WITH {_SIDES}, {_KS} SELECT feature, round(ks_stat, 6) AS ks_stat, round(ks_p_value, 6) AS ks_p_value FROM ks", "txn")
def d4_ks(spark, sf_dir):
    return rounded(drift.ks_2samp(_long(spark, sf_dir)))


@query(f"WITH {_REPORT} SELECT feature, psi, ks_stat, jsd, ref_n, cur_n, status, true AS near FROM rep", "txn")
def d5_sketched_report(spark, sf_dir):
    """The exact report, and whether that of quantile sketches is within their error of it."""
    exact = drift.feature_drift_report(*_halves(spark, sf_dir), ["amount", "merchant_id"]).alias("e")
    found = drift.feature_drift_report(*_halves(spark, sf_dir), ["amount", "merchant_id"], sketch=1024).alias("s")
    off = 3 * drift.rank_error(1024) + 0.002
    near = (F.abs(F.col("s.ks_stat") - F.col("e.ks_stat")) <= off) & (F.abs(F.col("s.psi") - F.col("e.psi")) <= 0.03) & (F.abs(F.col("s.jsd") - F.col("e.jsd")) <= 0.02)
    return exact.join(found, "feature").select("feature", *[f"e.{c}" for c in ("psi", "ks_stat", "jsd", "ref_n", "cur_n", "status")], (near & (F.col("s.ref_n") == F.col("e.ref_n")) & (F.col("s.cur_n") == F.col("e.cur_n"))).alias("near"))


@query(f"WITH {_REPORT} SELECT * FROM rep UNION ALL SELECT 'absent', 0, 0, 1, 0, 0, 0, 'MISSING'", "txn")
def d5_drift_report(spark, sf_dir):
    return drift.feature_drift_report(*_halves(spark, sf_dir), ["amount", "merchant_id", "absent"])


@query(
    f"""WITH {_REPORT} SELECT CASE WHEN count_if(status = 'CRITICAL_DRIFT') > 0 THEN 'CRITICAL_DRIFT' WHEN count_if(status = 'WARNING') / count(*) > 0.2 THEN 'WARNING' ELSE 'STABLE' END AS overall_status, count_if(status = 'CRITICAL_DRIFT') AS critical_count, count_if(status = 'WARNING') AS warning_count,
    count_if(status = 'STABLE') AS stable_count, count_if(status = 'INSUFFICIENT_DATA') AS insufficient_data_count, round(max(psi), 4) AS max_psi, round(avg(jsd), 4) AS mean_jsd, count(*) AS total_features_evaluated, round(count_if(status <> 'STABLE') / count(*), 4) AS drift_severity_pct FROM rep""",
    "txn",
)
def d6_drift_summary(spark, sf_dir):
    return drift.drift_summary(drift.feature_drift_report(*_halves(spark, sf_dir), ["amount", "merchant_id"]))


_SCORE_SIDES = _SIDES.replace("'amount' AS feature", "'s' AS feature").replace("amount AS v FROM txn WHERE amount IS NOT NULL UNION ALL SELECT 'merchant_id', event_date < DATE '2024-01-16', CAST(merchant_id AS DOUBLE) FROM txn", "champion AS v FROM scores")


@query(
    f"WITH {_SCORE_SIDES}, {_PSI}, {_JSD} SELECT round(psi, 6) AS psi, round(jsd, 6) AS jsd, (SELECT round(avg(v), 6) FROM x WHERE ref) AS ref_mean, (SELECT round(stddev_pop(v), 6) FROM x WHERE ref) AS ref_std, (SELECT round(avg(v), 6) FROM x WHERE NOT ref) AS cur_mean, (SELECT round(stddev_pop(v), 6) FROM x WHERE NOT ref) AS cur_std, psi >= 0.15 OR jsd >= 0.1 AS drifted FROM psi JOIN jsd USING (feature)",
    "scores",
)
def d7_prediction_drift(spark, sf_dir):
    return rounded(drift.prediction_drift(*_halves(spark, sf_dir, "scores"), "champion"))


@query(
    "WITH r AS (SELECT avg(is_fraud) FILTER (event_date < DATE '2024-01-16') AS b, avg(is_fraud) FILTER (event_date >= DATE '2024-01-16') AS c FROM txn) SELECT round(b, 6) AS baseline_rate, round(c, 6) AS current_rate, round(abs(c - b) / b, 6) AS relative_change, abs(c - b) / b >= 0.3 AS drifted FROM r",
    "txn",
)
def d8_label_rate_drift(spark, sf_dir):
    return rounded(drift.label_rate_drift(*_halves(spark, sf_dir), "is_fraud"))


@query()
def d9_retrain_decision(spark, sf_dir):
    summary = drift.drift_summary(drift.feature_drift_report(*_halves(spark, sf_dir), ["amount", "merchant_id"]))
    return drift.retrain_decision(summary, drift.prediction_drift(*_halves(spark, sf_dir, "scores"), "champion"), drift.label_rate_drift(*_halves(spark, sf_dir), "is_fraud"))


@query(
    f"WITH {_RECONCILED}, u AS (SELECT is_fraud_reconciled AS y FROM r WHERE is_fraud_reconciled IS NOT NULL AND label_confidence >= 0.7) SELECT count(*) AS labels, round(avg(y), 6) AS fraud_rate, count(*) >= 1000 AS enough, avg(y) BETWEEN 0.001 AND 0.30 AS plausible, count(*) >= 1000 AND avg(y) BETWEEN 0.001 AND 0.30 AS can_train FROM u",
    "txn",
)
def d11_training_guards(spark, sf_dir):
    return rounded(labels.training_set_guards(_reconciled(spark, sf_dir)))


_CURVE = """l AS (SELECT 'champion' AS model, champion AS score, is_fraud FROM scores UNION ALL SELECT 'challenger', challenger, is_fraud FROM scores),
    sc AS (SELECT model, score, count_if(is_fraud = 1) AS pos, count_if(is_fraud = 0) AS neg FROM l GROUP BY 1, 2),
    cv AS (SELECT model, score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER m AS p, sum(neg) OVER m AS n FROM sc WINDOW w AS (PARTITION BY model ORDER BY score DESC), m AS (PARTITION BY model)),
    pr AS (SELECT model, score, tp, fp, p, n, tp / (tp + fp) AS precision, tp / p AS recall, fp / n AS fpr FROM cv),
    pv AS (SELECT *, lag(precision, 1, 1.0) OVER w AS pp, lag(recall, 1, 0.0) OVER w AS lr, lag(fpr, 1, 0.0) OVER w AS lf FROM pr WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
    au AS (SELECT model, sum((recall - lr) * (precision + pp) / 2) AS pr_auc, sum((recall - lr) * precision) AS average_precision FROM pv GROUP BY model)"""
_MODELS = ["champion", "challenger"]


@query(f"WITH {_CURVE} SELECT model, score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(p AS BIGINT) AS p, CAST(n AS BIGINT) AS n, round(precision, 6) AS precision, round(recall, 6) AS recall, round(fpr, 6) AS fpr FROM pr", "scores")
def d12_pr_curve(spark, sf_dir):
    return rounded(evaluate.pr_curve(load(spark, sf_dir, "scores"), _MODELS))


@query(f"WITH {_CURVE} SELECT model, round(pr_auc, 6) AS pr_auc, round(average_precision, 6) AS average_precision FROM au", "scores")
def d12_pr_summary(spark, sf_dir):
    return rounded(evaluate.pr_summary(load(spark, sf_dir, "scores"), _MODELS))


@query(
    f"""WITH {_CURVE} SELECT model, round(max(CASE WHEN lf <= 0.01 AND fpr >= 0.01 THEN lr + (recall - lr) * coalesce((0.01 - lf) / nullif(fpr - lf, 0), 1) END), 6) AS recall_at_fpr_1,
    round(max(CASE WHEN lf <= 0.05 AND fpr >= 0.05 THEN lr + (recall - lr) * coalesce((0.05 - lf) / nullif(fpr - lf, 0), 1) END), 6) AS recall_at_fpr_5,
    round(max(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)), 6) AS best_f1, arg_max(score, [coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), score]) AS best_threshold FROM pv GROUP BY model""",
    "scores",
)
def d13_operating_points(spark, sf_dir):
    return rounded(evaluate.operating_points(load(spark, sf_dir, "scores"), _MODELS))


@query(
    f"""WITH {_CURVE}, g AS (SELECT (SELECT pr_auc FROM au WHERE model = 'champion') AS ca, (SELECT pr_auc FROM au WHERE model = 'challenger') AS na, count_if(champion >= 0.5 AND is_fraud = 0) / count_if(is_fraud = 0) AS cf, count_if(challenger >= 0.5 AND is_fraud = 0) / count_if(is_fraud = 0) AS nf,
    count_if(champion >= 0.5 AND amount > 100 AND is_fraud = 1) / nullif(count_if(amount > 100 AND is_fraud = 1), 0) AS cr, count_if(challenger >= 0.5 AND amount > 100 AND is_fraud = 1) / nullif(count_if(amount > 100 AND is_fraud = 1), 0) AS nr FROM scores)
    SELECT round(ca, 6) AS champion_pr_auc, round(na, 6) AS challenger_pr_auc, round(cf, 6) AS champion_fpr, round(cr, 6) AS champion_high_recall, round(nf, 6) AS challenger_fpr, round(nr, 6) AS challenger_high_recall,
    na >= ca - 0.005 AS pr_auc_gate, cr IS NULL OR nr >= cr - 0.01 AS high_recall_gate, nf <= cf * 1.05 AS fpr_gate, na >= ca - 0.005 AND (cr IS NULL OR nr >= cr - 0.01) AND nf <= cf * 1.05 AS promote FROM g""",
    "scores",
)
def d14_champion_challenger(spark, sf_dir):
    return rounded(evaluate.champion_challenger(load(spark, sf_dir, "scores"), high_amount=100.0))


@query(
    """WITH d AS (SELECT count_if((champion >= 0.5) = (is_fraud = 1) AND (challenger >= 0.5) <> (is_fraud = 1)) AS b, count_if((champion >= 0.5) <> (is_fraud = 1) AND (challenger >= 0.5) = (is_fraud = 1)) AS c FROM scores)
    SELECT b, c, round(least(1.0, 2 * list_sum([exp(lgamma(b + c + 1) - lgamma(k + 1) - lgamma(b + c - k + 1) - (b + c) * ln(2.0)) FOR k IN range(0, CAST(least(b, c) AS BIGINT) + 1)])), 6) AS p_value FROM d""",
    "scores",
)
def d15_mcnemar(spark, sf_dir):
    return rounded(evaluate.mcnemar(load(spark, sf_dir, "scores")))


@query("WITH w AS (SELECT count_if(is_fraud = 0) / count_if(is_fraud = 1) AS r FROM txn) SELECT transaction_id, round(CASE WHEN is_fraud = 1 THEN r ELSE 1 END, 6) AS weight FROM txn, w", "txn")
def d20_class_weights(spark, sf_dir):
    return rounded(labels.class_weights(load(spark, sf_dir, "txn"), "is_fraud").select("transaction_id", "weight"))


# Profiles -----------------------------------------------------------------------


@query("""SELECT 'events' AS "table", count(*) AS rows, 6 AS columns FROM events UNION ALL SELECT 'orders', count(*), 6 FROM orders""")
def e1_table_inventory(spark, sf_dir):
    return profile.table_inventory({t: load(spark, sf_dir, t) for t in ("events", "orders")})


@query("SELECT count_if(is_fraud = 0) AS negatives, count_if(is_fraud = 1) AS positives, round(avg(is_fraud), 6) AS rate, round(count_if(is_fraud = 0) / count_if(is_fraud = 1), 6) AS ratio FROM txn", "txn")
def e2_class_balance(spark, sf_dir):
    return rounded(profile.class_balance(load(spark, sf_dir, "txn")))


_PROFILED = ["device_id", "amount", "channel", "latitude", "longitude", "card_id", "merchant_id"]


@query(
    """WITH r AS (SELECT count_if(device_id IS NULL) / count(*) AS d, count_if(amount IS NULL) / count(*) AS a, count_if(channel IS NULL) / count(*) AS c, count_if(latitude IS NULL) / count(*) AS l FROM txn),
    t AS (SELECT 'id' AS family, unnest([d, 0.0, 0.0]) AS x FROM r UNION ALL SELECT 'place', unnest([l, 0.0]) FROM r UNION ALL SELECT 'other', unnest([a, c]) FROM r)
    SELECT family, count(*) AS columns, round(min(x), 6) AS min_rate, round(quantile_cont(x, 0.5), 6) AS median_rate, round(max(x), 6) AS max_rate FROM t GROUP BY family""",
    "txn",
)
def e3_null_profile(spark, sf_dir):
    return rounded(profile.null_profile(load(spark, sf_dir, "txn"), _PROFILED, {"id": "_id$", "place": "itude$"}))


@query(
    "SELECT 'card_id,longitude,merchant_id' AS columns, 0 AS nulls UNION ALL SELECT 'device_id,twin', count_if(device_id IS NULL) FROM txn UNION ALL SELECT 'amount', count_if(amount IS NULL) FROM txn UNION ALL SELECT 'channel', count_if(channel IS NULL) FROM txn UNION ALL SELECT 'latitude', count_if(latitude IS NULL) FROM txn",
    "txn",
)
def e4_null_blocks(spark, sf_dir):
    return profile.null_blocks(load(spark, sf_dir, "txn").withColumn("twin", F.col("device_id")), [*_PROFILED, "twin"], "transaction_id")


@query(
    """WITH h AS (SELECT CAST(hour(event_time_ts) AS INT) AS h, count(*) AS n, avg(is_fraud) AS r FROM txn GROUP BY 1) SELECT (SELECT h FROM h ORDER BY n DESC, h LIMIT 1) AS peak_hour, (SELECT h FROM h ORDER BY n, h LIMIT 1) AS trough_hour, (SELECT h FROM h ORDER BY r DESC, h LIMIT 1) AS highest_rate_hour, (SELECT h FROM h ORDER BY r, h LIMIT 1) AS lowest_rate_hour,
    (SELECT round(max(r), 6) FROM h) AS highest_rate, (SELECT round(min(r), 6) FROM h) AS lowest_rate""",
    "txn",
)
def e5_hourly_profile(spark, sf_dir):
    return rounded(profile.hourly_profile(hours(load(spark, sf_dir, "txn"))))


_LIFT = "l AS (SELECT count_if(i.order_id IS NOT NULL) AS with_rows, count_if(i.order_id IS NULL) AS without_rows, avg(is_fraud) FILTER (i.order_id IS NOT NULL) AS with_rate, avg(is_fraud) FILTER (i.order_id IS NULL) AS without_rate FROM txn_wide w LEFT JOIN identity i USING (order_id))"


@query(f"WITH {_LIFT} SELECT with_rows, without_rows, round(with_rate, 6) AS with_rate, round(without_rate, 6) AS without_rate, round(with_rate / without_rate, 6) AS lift FROM l", "txn_wide", "identity")
def e6_presence_lift(spark, sf_dir):
    return rounded(profile.presence_lift(load(spark, sf_dir, "txn_wide"), load(spark, sf_dir, "identity"), "order_id"))


@query("WITH m AS (SELECT avg(is_fraud) AS r FROM txn) SELECT 'fraud_rate' AS name, round(r, 6) AS measured, 0.2E0 AS claimed, CASE WHEN abs(r - 0.2) <= 0.02 THEN 'CONFIRMED' ELSE 'REFUTED' END AS verdict FROM m UNION ALL SELECT 'coverage', NULL, 0.24, 'UNMEASURED'", "txn")
def e7_verdicts(spark, sf_dir):
    measured = load(spark, sf_dir, "txn").agg(F.avg(F.col("is_fraud").cast("double")).alias("measured")).select(F.lit("fraud_rate").alias("name"), "measured")
    return rounded(profile.verdicts(measured, spark.createDataFrame([("fraud_rate", 0.2), ("coverage", 0.24)], "name string, claimed double")))


def _cardinality_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count(DISTINCT v) AS levels, round(count_if(v IS NULL) / count(*), 6) AS null_rate, (SELECT v FROM c WHERE c.f = '{column}' AND v IS NOT NULL ORDER BY n DESC, v LIMIT 1) AS top_value,
    round((SELECT max(n) FROM c WHERE c.f = '{column}' AND v IS NOT NULL) / count(*), 6) AS top_share, round((SELECT sum(n) FROM (SELECT n FROM c WHERE c.f = '{column}' AND v IS NOT NULL ORDER BY n DESC, v LIMIT 20)) / count(*), 6) AS top_coverage FROM u WHERE f = '{column}'"""


@query(
    "WITH u AS (SELECT 'channel' AS f, channel AS v FROM txn UNION ALL SELECT 'merchant_id', CAST(merchant_id AS VARCHAR) FROM txn), c AS (SELECT f, v, count(*) AS n FROM u GROUP BY 1, 2) " + " UNION ALL ".join(_cardinality_sql(c) for c in ("channel", "merchant_id")),
    "txn",
)
def e8_cardinality(spark, sf_dir):
    return rounded(profile.cardinality_profile(load(spark, sf_dir, "txn"), ["channel", "merchant_id"]))


@query(
    "SELECT CASE WHEN event_date < DATE '2024-01-16' THEN 'train' ELSE 'test' END AS side, count(amount) AS n, round(avg(amount), 4) AS mean, round(stddev(amount), 4) AS std, round(min(amount), 4) AS low, round(quantile_cont(amount, 0.5), 4) AS median, round(max(amount), 4) AS high FROM txn GROUP BY 1",
    "txn",
)
def e9_describe_compare(spark, sf_dir):
    return rounded(profile.describe_compare(*_halves(spark, sf_dir), "amount", "channel", "event_time_ts")[0], 4)


@query(
    "WITH c AS (SELECT CASE WHEN event_date < DATE '2024-01-16' THEN 'train' ELSE 'test' END AS side, channel, count(*) AS n FROM txn GROUP BY 1, 2) SELECT side, channel, round(n / sum(n) OVER (PARTITION BY side), 6) AS share FROM c",
    "txn",
)
def e9_category_shares(spark, sf_dir):
    return rounded(profile.describe_compare(*_halves(spark, sf_dir), "amount", "channel", "event_time_ts")[1])


# Streams in batch form, sources, models -----------------------------------------

_BODY = """CASE WHEN event_id % 31 = 0 THEN 'not json' WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN '{}' ELSE 'ok' END"""


def _messages(spark, sf_dir) -> DataFrame:
    """The events as broker messages, some of them broken."""
    key = F.col("event_id")
    event = F.to_json(F.struct(key.cast("string").alias("transaction_id"), F.col("ts").cast("string").alias("event_time"), F.col("user_id").cast("string").alias("card_id"), F.col("value").alias("amount"), F.col("event_type").alias("channel")))
    body = F.when(key % 31 == 0, "not json").when(key % 37 == 0, None).when(key % 41 == 0, "{}").otherwise(event)
    return load(spark, sf_dir, "events").select(body.alias("value"))


@query(f"SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS card_id, value AS amount, event_type AS channel FROM events WHERE {_BODY} = 'ok'")
def s9_parsed_events(spark, sf_dir):
    good, _ = events.split_parse_failures(events.parse_events(_messages(spark, sf_dir)))
    return good.select("transaction_id", "card_id", "amount", "channel")


@query(f"SELECT 'stream_to_bronze' AS _gate, 'JSON_PARSE_FAILURE' AS _rejection_reason, count(*) AS rows FROM events WHERE coalesce({_BODY}, '') <> 'ok'")
def s21_quarantine_summary(spark, sf_dir):
    _, bad = events.split_parse_failures(events.parse_events(_messages(spark, sf_dir)), as_of())
    return files.quarantine_summary(bad)


@query("SELECT CAST(file AS VARCHAR) AS file, rows, 2 AS columns, passed FROM (SELECT 'orders' AS file, count(*) AS rows, true AS passed FROM orders)")
def s7_landing_counts(spark, sf_dir):
    """The landing check's counts, on a CSV copy of the orders in the shared folder, of a file a partition."""
    import uuid

    from ..functions.lineage import shared_dir

    folder = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"
    load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").write.option("header", True).csv(folder)
    landed = spark.read.option("header", True).csv(folder).groupBy(F.col("_metadata.file_name").alias("name")).count().collect()
    checked = files.landing_check(spark, folder, {r["name"]: (r["count"], 2) for r in landed})
    return checked.agg(F.sum("rows").alias("rows"), F.max("columns").alias("columns"), F.bool_and("passed").alias("passed")).select(F.lit("orders").alias("file"), "rows", "columns", "passed")


@query("SELECT transaction_id, event_time_ts < TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 10 MINUTE AS late FROM txn", "txn")
def t12_late_events(spark, sf_dir):
    good, late = events.split_late_events(load(spark, sf_dir, "txn"), F.expr("TIMESTAMP_NTZ '2024-01-10 00:00:00'"), at=as_of())
    return good.select("transaction_id", F.lit(False).alias("late")).unionByName(late.select("transaction_id", F.lit(True).alias("late")))


@query("SELECT count_if(event_time_ts < TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 10 MINUTE) AS late_drops FROM txn", "txn")
def a11_late_drops(spark, sf_dir):
    _, late = events.split_late_events(load(spark, sf_dir, "txn"), F.expr("TIMESTAMP_NTZ '2024-01-10 00:00:00'"), at=as_of())
    return aggregates.late_drops(late, as_of())


@query("SELECT 'cases' AS output, count_if(champion >= 0.1) AS n FROM scores UNION ALL SELECT 'audit', count_if(champion >= 0.1) FROM scores UNION ALL SELECT 'step_up', count_if(champion >= 0.1 AND champion < 0.6) FROM scores", "scores")
def t10_routed_decisions(spark, sf_dir):
    out = None
    for name, df in events.route_decisions(load(spark, sf_dir, "scores"), "champion").items():
        own = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("output"), "n")
        out = own if out is None else out.unionByName(own)
    return out


@query(
    f"""WITH q AS (SELECT transaction_id AS case_id, event_time_ts AS asked FROM txn), a AS (SELECT CASE WHEN transaction_id % 3 = 0 THEN transaction_id ELSE -transaction_id END AS case_id, event_time_ts + INTERVAL 1 MINUTE * (transaction_id % 8) AS told, CASE WHEN transaction_id % 2 = 0 THEN 'VERIFIED' ELSE 'FAILED' END AS s FROM txn)
    SELECT q.case_id, CASE WHEN told <= asked + INTERVAL 5 MINUTE THEN s ELSE 'ESCALATED' END AS status, CASE WHEN told <= asked + INTERVAL 5 MINUTE THEN told ELSE asked + INTERVAL 5 MINUTE END AS at FROM q LEFT JOIN a USING (case_id) WHERE TIMESTAMP '{AS_OF}' > asked""",
    "txn",
)
def t11_step_up_timeouts(spark, sf_dir):
    txn = load(spark, sf_dir, "txn").withColumn("case_id", F.col("transaction_id"))
    told = F.col("event_time_ts") + F.make_dt_interval(mins=(F.col("transaction_id") % 8).cast("int"))
    answers = txn.select(F.when(F.col("case_id") % 3 == 0, F.col("case_id")).otherwise(-F.col("case_id")).alias("case_id"), F.when(F.col("case_id") % 2 == 0, "VERIFIED").otherwise("FAILED").alias("status"), told.alias("answered_at"))
    return events.step_up_timeouts(txn.select("case_id", F.col("event_time_ts").alias("requested_at")), answers, as_of())


@query("WITH l AS (SELECT DISTINCT channel FROM txn WHERE event_date < DATE '2024-01-16' AND channel IS NOT NULL AND channel <> 'signup'), r AS (SELECT channel, row_number() OVER (ORDER BY channel) - 1 AS i FROM l) SELECT transaction_id, CAST(coalesce(i, -1) AS INT) AS channel_idx FROM txn LEFT JOIN r USING (channel)", "txn")
def d19_ordinal_encode(spark, sf_dir):
    from ..operators import model

    txn = load(spark, sf_dir, "txn")
    fitted = model.fit_ordinals(txn.filter("event_date < DATE '2024-01-16' AND channel IS NOT NULL AND channel <> 'signup'"), ["channel"])
    return model.ordinal_encode(txn, fitted).select("transaction_id", "channel_idx")


@query(
    """WITH c AS (SELECT transaction_id, 0.5 * (coalesce(amount, 20.0) - 20.0) AS a, -0.1 * (merchant_id - 50.0) AS m, 0.02 * (card_id - 70.0) AS k FROM txn),
    l AS (SELECT transaction_id, f.name AS name, f.v AS v FROM (SELECT transaction_id, unnest([{'name': 'amount', 'v': a}, {'name': 'merchant_id', 'v': m}, {'name': 'card_id', 'v': k}]) AS f FROM c))
    SELECT c.transaction_id, coalesce(string_agg(name, ',' ORDER BY v DESC), '') AS factors FROM c LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY v DESC) AS r FROM l WHERE v > 0) t ON t.transaction_id = c.transaction_id AND r <= 2 GROUP BY c.transaction_id""",
    "txn",
)
def d26_top_risk_factors(spark, sf_dir):
    from ..operators import model

    out = model.top_risk_factors(load(spark, sf_dir, "txn"), {"amount": 0.5, "merchant_id": -0.1, "card_id": 0.02}, {"amount": 20.0, "merchant_id": 50.0, "card_id": 70.0}, 2)
    return out.select("transaction_id", F.array_join(F.transform("top_risk_factors", lambda x: x["feature"]), ",").alias("factors"))


@query(
    "SELECT CAST(CASE WHEN count(amount) / count(*) > 0.05 AND var_pop(coalesce(amount, 0)) > 0.01 THEN 1 ELSE 0 END + CASE WHEN count(merchant_id) / count(*) > 0.05 AND var_pop(coalesce(merchant_id, 0)) > 0.01 THEN 1 ELSE 0 END AS BIGINT) AS kept FROM txn",
    "txn",
)
def d18_selected_columns(spark, sf_dir):
    """How many of four columns survive the null and variance rules: a constant and an empty one don't."""
    from ..operators import model

    df = load(spark, sf_dir, "txn").withColumns({"flat": F.lit(1.0), "none": F.lit(None).cast("double")})
    names = model.select_columns(df, ["amount", "merchant_id", "flat", "none"])
    return df.agg(*[F.count_if(F.col(c).isNotNull()).alias(c) for c in names]).select(F.lit(len(names)).cast("long").alias("kept"))


@query("SELECT transaction_id AS case_id, 't' || transaction_id AS transaction_id, champion FROM scores WHERE transaction_id % 7 = 0", "scores")
def j8_cases_with_decisions(spark, sf_dir):
    """A decision of each transaction, of which six sevenths name a case that doesn't exist."""
    scored, key = load(spark, sf_dir, "scores"), F.col("transaction_id")
    decisions = scored.select(F.when(key % 7 == 0, key).otherwise(-key).alias("case_id"), "champion")
    cases = scored.select(key.alias("case_id"), F.concat(F.lit("t"), key.cast("string")).alias("transaction_id"))
    return joins.cases_with_decisions(decisions, cases).select("case_id", "transaction_id", "champion")


@also_whole
@query(f"{_COMPONENTS}, {_DEGREES}, {_rank_ctes()} SELECT substr(id, 10) AS customer_id, TIMESTAMP '2024-02-06 00:00:00' AS feature_timestamp, rank, degree, component FROM v JOIN c USING (id) JOIN d USING (id) JOIN pr USING (id) WHERE id LIKE 'customer:%'", "txn")
def j11_graph_features(spark, sf_dir):
    return rounded(joins.graph_features(graph.entity_metrics(*_graph(spark, sf_dir), "2024-02-05")))
