"""The sample tables in the shapes that the operators expect.

The same text runs in Spark SQL and DuckDB, so that a query and its SQL read
equal rows. Nulls and bad values are put in by modulus, for the gates to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TXN = """
SELECT event_id AS transaction_id, ts AS event_time_ts, CAST(ts AS DATE) AS event_date,
       user_id AS card_id, user_id % 50 AS customer_id, k AS merchant_id,
       CASE WHEN event_id % 53 = 0 THEN NULL ELSE k % 20 END AS device_id,
       CASE WHEN event_id % 97 = 0 THEN -value WHEN event_id % 89 = 0 THEN NULL ELSE value END AS amount,
       CASE WHEN event_id % 61 = 0 THEN NULL ELSE event_type END AS channel,
       CASE WHEN event_id % 41 = 0 THEN NULL ELSE k * 1.0E0 - 50.0E0 END AS latitude,
       CAST((event_id * 37) % 360 AS DOUBLE) - 180.0E0 AS longitude,
       CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_fraud
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events)
"""

TXN_WIDE = """
SELECT l_orderkey * 10 + l_linenumber AS transaction_id, l_orderkey AS order_id,
       l_extendedprice AS transaction_amt, l_returnflag AS product_cd,
       o_orderpriority AS card4, l_linestatus AS card6, CAST(l_shipdate AS DATE) AS event_date,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_fraud
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

IDENTITY = "SELECT CASE WHEN o_custkey % 4 = 0 THEN o_orderkey ELSE -o_orderkey END AS order_id, o_orderstatus AS device_type FROM orders"

FEATURES = "SELECT card_id, event_time_ts AS feature_timestamp, amount AS feature_value, transaction_id AS feature_id FROM txn WHERE channel = 'purchase'"

SCORES = """
SELECT transaction_id, event_date, amount, is_fraud,
       ((transaction_id * 7919) % 1000) / 1000.0E0 AS champion, ((transaction_id * 104729) % 1000) / 1000.0E0 AS challenger
FROM txn
"""

TXN_IP = "SELECT *, concat('10.0.', merchant_id % 5, '.', card_id % 30) AS ip_address FROM txn"

DERIVED = {"txn": TXN, "txn_ip": TXN_IP, "txn_wide": TXN_WIDE, "identity": IDENTITY, "features": FEATURES, "scores": SCORES}
NEEDS = {"txn": (), "txn_ip": ("txn",), "txn_wide": (), "identity": (), "features": ("txn",), "scores": ("txn",)}
BASE = {"txn": ("events",), "txn_ip": (), "txn_wide": ("lineitem", "orders"), "identity": ("orders",), "features": (), "scores": ()}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table by its own name, or one derived from such tables."""
    if name not in DERIVED:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    inputs = {x: load(spark, sf_dir, x) for x in (*BASE[name], *NEEDS[name])}
    return spark.sql(_braced(DERIVED[name], inputs), **inputs)


def _braced(sql: str, names) -> str:
    """``FROM name`` and ``JOIN name`` as parameters of ``spark.sql``, so that no view is registered."""
    for name in names:
        for word in ("FROM", "JOIN"):
            sql = sql.replace(f"{word} {name}", f"{word} {{{name}}}")
    return sql


def with_derived(sql: str, *names: str) -> str:
    """``sql`` with the derived tables it uses as leading CTEs."""
    wanted: list[str] = []
    for name in names:
        wanted += [x for x in (*NEEDS[name], name) if x not in wanted]
    ctes = [f"{x} AS ({DERIVED[x].strip()})" for x in wanted]
    head = sql.lstrip()
    if head.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {', '.join(ctes)}, {head[15:]}"
    if head.upper().startswith("WITH "):
        return f"WITH {', '.join(ctes)}, {head[5:]}"
    return f"WITH {', '.join(ctes)} {head}"
