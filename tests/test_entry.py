import pytest

import __spark_entry__ as entry
from riskspark.plans import catalogue


def test_every_query_has_a_name_and_sql_names_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES) and len(catalogue.QUERIES) > 90


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["a1_daily_fraud_summary", "j2_asof_join", "g3_gate_report", "d5_drift_report", "r4_connected_components", "w3_chronological_split", "m1_insert_new", "m2_upsert_all", "m6_upsert_cases", "m6_case_events", "m7_update_case_status", "m8_case_state", "j1_identity_join", "j8_cases_with_decisions", "j10_key_coverage", "e6_presence_lift", "t11_step_up_timeouts"])
def test_queries_agree_with_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("events", "lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(catalogue.ORACLES[name])
    columns = sorted(d[0] for d in want.description)
    at = [[d[0] for d in want.description].index(c) for c in columns]
    text = lambda row: tuple(str(round(float(x), 6)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x) for x in row)
    expected = sorted(text(r[i] for i in at) for r in want.fetchall())
    assert sorted(text(r) for r in catalogue.QUERIES[name](spark, sf).select(*columns).collect()) == expected
