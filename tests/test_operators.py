import datetime as dt
import math
from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskspark.functions import scalars
from riskspark.operators import aggregates, clean, drift, evaluate, graph, joins, labels, merge, profile, quality, windows

T0 = dt.datetime(2026, 1, 15, 12)
SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_snake_case(spark):
    df = spark.createDataFrame([(1001, 86400, 150.0, "W", 1, 2, 3)], ["TransactionID", "TransactionDT", "TransactionAmt", "ProductCD", "isFraud", "P_emaildomain", "_Kept"])
    assert clean.to_snake_case(df).columns == ["transaction_id", "transaction_dt", "transaction_amt", "product_cd", "is_fraud", "p_emaildomain", "_Kept"]
    assert clean.normalise_id_columns(df.toDF("id-01", "id-2x", "c", "d", "e", "f", "g")).columns[:2] == ["id_01", "id-2x"]


def test_cleaning(spark):
    df = spark.createDataFrame([("W", None, 100.0), (None, " VISA", 50.25), ("C", "x", None)], "product_cd string, card4 string, transaction_amt double")
    out = clean.amount_features(clean.fill_categoricals(clean.null_flags(df, ["card4", "absent"]), ["product_cd", "card4", "absent"])).collect()
    assert [(r.product_cd, r.card4, r.card4_is_null) for r in out] == [("w", "unknown", 1), ("unknown", "visa", 0), ("c", "x", 0)]
    assert [(r.is_round_amount, r.amount_cents) for r in out] == [(1, 0), (0, 25), (0, None)]


def test_batch_times(spark):
    out = clean.synthesize_timestamps(spark.createDataFrame([(0,), (86400 * 8 + 3600 * 5,), (None,)], "transaction_dt long")).collect()
    assert [(r.event_hour, r.event_day_of_week) for r in out] == [(0, 0), (5, 1), (None, None)]
    assert str(out[1].event_date) == "2025-01-09"


def test_event_contract(spark):
    good = dict(transaction_id="t", schema_version="1.0", event_time="2026-01-01T00:00:00Z", customer_id="c", card_id="k", amount=1.0, merchant_id="m", payment_method="upi", channel="web", source="s", latitude=1.0, longitude=2.0)
    bad = good | {"amount": -1.0, "channel": "fax", "latitude": 91.0, "card_id": None, "event_time": "junk"}
    schema = ", ".join(f"{k} {'double' if k in ('amount', 'latitude', 'longitude') else 'string'}" for k in good)
    out = clean.validate_event(spark.createDataFrame([tuple(good.values()), tuple(bad.values())], schema)).collect()
    assert out[0].reasons == []
    assert set(out[1].reasons) == {"NEGATIVE_AMOUNT", "INVALID_CHANNEL", "LATITUDE_OUT_OF_RANGE", "MISSING_CARD_ID", "BAD_EVENT_TIME"}
    conformed = clean.conform_event(spark.createDataFrame([tuple(good.values()), tuple(bad.values())], schema))
    assert conformed.count() == 1


def test_stateless_features(spark):
    df = spark.createDataFrame([(100.0, dt.datetime(2025, 1, 1, 14), "US", "IN", "card_1", "merch_1", "credit_card", "mobile_app"), (None, dt.datetime(2025, 1, 4, 2), None, "IN", "c", "m", "x", None)], "amount double, event_time_ts timestamp_ntz, shipping_country string, billing_country string, card_id string, merchant_id string, payment_method string, channel string")
    a, b = scalars.stateless_features(df).collect()
    assert (a.feature_is_weekend, a.feature_is_night, a.feature_billing_shipping_mismatch, a.feature_payment_method_idx, a.feature_channel_idx, a.feature_amount_bucket) == (0, 0, 1, 1, 2, "medium")
    assert (b.feature_is_weekend, b.feature_is_night, b.feature_billing_shipping_mismatch, b.feature_payment_method_idx, b.feature_channel_idx, b.feature_amount_bucket) == (1, 1, 0, 0, 0, "high_value")


@pytest.mark.parametrize("p, action", [(0.0, "approve"), (0.001, "approve"), (0.099, "approve"), (0.10, "step_up"), (0.599, "step_up"), (0.60, "manual_review"), (0.899, "manual_review"), (0.90, "manual_review"), (0.999, "block"), (1.0, "block"), (7.0, "block"), (-1.0, "approve"), (None, None)])
def test_decision_bands(spark, p, action):
    assert spark.createDataFrame([(p,)], "p double").select(scalars.classify_decision(F.col("p"))).first()[0] == action


def test_decision_input_and_fallback(spark):
    df = spark.createDataFrame([("t", "c", "k", "10", "0.05"), ("t", None, "k", "10", "0.5"), ("t", "c", "k", "ten", "0.5")], "transaction_id string, customer_id string, card_id string, amount string, fraud_probability string")
    assert [(r.decision_action, r.error) for r in scalars.decision_input_check(df).collect()] == [("approve", None), ("approve_fallback", "missing: customer_id"), ("approve_fallback", "unreadable: amount")]
    amounts = spark.createDataFrame([(100.0,), (600.0,), (1500.0,), (6000.0,), (None,)], "a double")
    assert [r[0] for r in amounts.select(scalars.fallback_score(F.col("a"))).collect()] == [0.05, 0.20, 0.40, 0.85, 0.05]


def test_pii(spark):
    df = spark.createDataFrame([("10.1.2.3", "dev12345", "ann@x.org"), (None, None, None)], "ip_address string, device_id string, email string")
    masked = scalars.masked_view(df).first()
    assert tuple(masked) == ("10.1.xxx.xxx", "dev1****", "an***@x.org") and scalars.masked_view(df, privileged=True) is df
    hashed = scalars.hash_pii(df, "salt")
    scalars.assert_pii_hashed(hashed, 1.0)
    assert hashed.collect()[1].ip_address is None
    with pytest.raises(ValueError):
        scalars.assert_pii_hashed(df, 1.0)
    with pytest.raises(ValueError):
        scalars.hash_pii(df, "")


def test_geo(spark):
    rows = [("c1", 40.7128, -74.0060, T0, "a"), ("c1", 51.5074, -0.1278, T0 + dt.timedelta(hours=2), "b"), ("c2", 1.0, 1.0, T0, "a"), ("c2", 1.0, 1.0, T0 + dt.timedelta(hours=1), "b"), ("c3", 1.0, 1.0, T0, "a"), ("c3", 1.0, None, T0, "b")]
    out = {(r.card_id, r.transaction_id): r for r in windows.geo_velocity(spark.createDataFrame(rows, "card_id string, latitude double, longitude double, event_time_ts timestamp_ntz, transaction_id string")).collect()}
    far = out["c1", "b"]
    assert 5500 < far.distance_km < 5700 and far.velocity_kmh > 2500 and far.is_impossible_travel == 1
    assert (out["c1", "a"].distance_km, out["c1", "a"].velocity_kmh) == (0, 0) and out["c2", "b"].distance_km == 0
    assert out["c3", "b"].distance_km is None and out["c3", "b"].velocity_kmh == 0


OBS, FEAT = "transaction_id string, card_id string, event_time_ts timestamp_ntz", "card_id string, feature_timestamp timestamp_ntz, feature_value double"


@pytest.mark.parametrize("bucketed", [False, True])
def test_asof_join(spark, bucketed):
    day, minute = dt.timedelta(days=1), dt.timedelta(minutes=1)
    obs = spark.createDataFrame([("t", "k", T0), ("t", "k", T0), ("u", "other", T0), ("n", None, T0)], OBS)
    feat = spark.createDataFrame([("k", T0 - 2 * day, 1.0), ("k", T0 - day, 2.0), ("k", T0 - minute, 3.0), ("k", T0 + 5 * minute, 4.0), (None, T0, 9.0)], FEAT)
    out = joins.asof_join(obs, feat, "card_id", 3 * 86400, bucketed=bucketed).collect()
    assert sorted((r.transaction_id, r.feature_value) for r in out if r.transaction_id == "t") == [("t", 3.0), ("t", 3.0)]
    assert {r.transaction_id: r.feature_value for r in out if r.transaction_id != "t"} == {"u": None, "n": None}
    stale = joins.asof_join(obs, spark.createDataFrame([("k", T0 - 10 * day, 1.0)], FEAT), "card_id", 3 * 86400, bucketed=bucketed)
    assert {r.feature_value for r in stale.collect()} == {None}
    same = joins.asof_join(obs, spark.createDataFrame([("k", T0, 1.0), ("k", T0 - 3 * day, 2.0)], FEAT), "card_id", 3 * 86400, bucketed=bucketed)
    assert same.filter("card_id = 'k'").first().feature_value == 1.0


@SLOW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40)), max_size=12), st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40)), max_size=12), st.integers(1, 20))
def test_asof_join_against_brute_force(spark, obs, feat, back):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    o = spark.createDataFrame([(str(i), k, at(s)) for i, (k, s) in enumerate(obs)], OBS)
    f = spark.createDataFrame([(k, at(s), float(i)) for i, (k, s) in enumerate(feat)], FEAT)
    for bucketed in (False, True):
        got = {r.transaction_id: r.feature_value for r in joins.asof_join(o, f, "card_id", back, tie=["feature_value"], bucketed=bucketed).collect()}
        for i, (k, s) in enumerate(obs):
            best = max(((fs, float(j)) for j, (fk, fs) in enumerate(feat) if fk == k and s - back <= fs <= s), default=(0, None))
            assert got[str(i)] == best[1]


def test_gate_conserves_rows(spark):
    rows = [(1, 10.0, 5, 0, "W"), (2, None, 5, 0, "W"), (3, 10.0, -5, 0, "W"), (4, 10.0, 5, None, None), (None, 0.0, None, 1, "Z")]
    df = spark.createDataFrame(rows, "transaction_id int, transaction_amt double, transaction_dt int, is_fraud int, product_cd string")
    rules = quality.wide_reject_rules()
    good, bad = quality.reject_rows(df, rules)
    assert [r.transaction_id for r in good.collect()] == [1] and bad.count() == 4 and "" not in {r._rejection_reason for r in bad.collect()}
    report = quality.gate_report(df, rules).first()
    assert (report.total_rows, report.clean_rows, report.rejected_rows) == (5, 1, 4)
    assert quality.gate_report(df.limit(0), rules).first().rejection_rate == 0


def test_checks_on_an_empty_table(spark):
    df = spark.createDataFrame([], "transaction_id int, transaction_amt double, product_cd string, is_fraud int")
    assert {r.passed for r in quality.run_checks(df, quality.wide_error_checks(), ["transaction_id"]).collect()} == {True}


@SLOW
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9)), max_size=10), st.lists(st.tuples(st.integers(0, 6), st.integers(10, 19)), max_size=10, unique_by=lambda x: x[0]))
def test_merges_against_dictionaries(spark, target, source):
    target = list(dict(target).items())
    t, s = (spark.createDataFrame(x, "k int, v int") for x in (target, source))
    as_dict = lambda df: {r.k: r.v for r in df.collect()}
    assert as_dict(merge.insert_new(t, s, ["k"])) == dict(source) | dict(target)
    assert as_dict(merge.upsert_all(t, s, ["k"])) == dict(target) | dict(source)
    even = merge.upsert_if(t, s, ["k"], F.col("s.v") % 2 == 0)
    assert as_dict(even) == {k: (dict(source)[k] if k in dict(source) and (k not in dict(target) or dict(source)[k] % 2 == 0) else dict(target)[k]) for k in dict(target) | dict(source)}


def test_tables_are_the_same_after_a_second_run(spark, tmp_path):
    df = spark.createDataFrame([(1, "2026-01-01", 5), (2, "2026-01-02", 6)], "k int, snapshot_date string, v int")
    path = str(tmp_path / "new")
    for _ in range(3):
        merge.append_new(spark, path, df, ["k"])
    assert spark.read.parquet(path).count() == 2
    path = str(tmp_path / "snapshots")
    merge.overwrite_partitions(df, path, ["k", "snapshot_date"])
    merge.overwrite_partitions(df.filter("k = 2").withColumn("v", F.lit(9)), path, ["k", "snapshot_date"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, 5), (2, 9)]
    with pytest.raises(ValueError):
        merge.overwrite_partitions(df.union(df), path, ["k", "snapshot_date"])
    root = str(tmp_path / "versions")
    merge.write_version(df, root, 1)
    merge.write_version(merge.read_version(spark, root).filter("k = 1"), root, 2)
    assert merge.read_version(spark, root).count() == 1


def test_cases(spark):
    at = F.expr("TIMESTAMP_NTZ '2026-01-01 00:00:00'")
    empty = spark.createDataFrame([], "case_id string, transaction_id string, fraud_probability double, scoring_mode string, decision_action string, model_version string, case_status string, created_at timestamp_ntz, updated_at timestamp_ntz")
    batch = spark.createDataFrame([("t", 0.7, "full", "manual_review", "v1"), ("t", 0.95, "full", "block", "v1"), (None, 0.1, "full", "approve", "v1")], "transaction_id string, fraud_probability double, scoring_mode string, decision_action string, model_version string")
    cases, events = merge.upsert_cases(empty, batch, at)
    assert [(r.decision_action, r.case_status) for r in cases.collect()] == [("block", "OPEN")] and [r.event_type for r in events.collect()] == ["CASE_CREATED"]
    again, more = merge.upsert_cases(cases, batch, at)
    assert again.count() == 1 and [r.event_type for r in more.collect()] == ["MODEL_SCORE_UPDATED"]
    closed, changed = merge.update_case_status(cases, cases.select("case_id", F.lit("CLOSED").alias("new_status"), F.lit("x").alias("updated_by"), F.lit(None).cast("string").alias("notes")), at)
    assert closed.first().case_status == "CLOSED"
    later = changed.withColumn("created_at", F.expr("TIMESTAMP_NTZ '2026-01-02 00:00:00'"))
    assert merge.case_state_from_events(events.unionByName(later)).first().status == "CLOSED"


def test_label_precedence(spark):
    day = dt.date(2026, 1, 1)
    txn = spark.createDataFrame([(i, day if i < 6 else dt.date(2026, 2, 10)) for i in range(9)], "transaction_id int, event_date date")
    charged = spark.createDataFrame([(0,), (0,), (7,)], "transaction_id int")
    said = spark.createDataFrame([(0, "CONFIRMED_LEGIT", 1), (1, "CONFIRMED_LEGIT", 1), (1, "CONFIRMED_FRAUD", 2), (2, "CONFIRMED_LEGIT", 1), (3, "INCONCLUSIVE", 1), (6, "CONFIRMED_LEGIT", 1)], "transaction_id int, decision_result string, decided_at int")
    out = {r.transaction_id: (r.is_fraud_reconciled, r.label_source, r.label_confidence) for r in labels.reconcile_labels(txn, charged, said, F.lit("2026-02-15").cast("date")).collect()}
    assert out[0] == (1, "CHARGEBACK", 1.0) and out[1] == (1, "ANALYST_CONFIRMED_FRAUD", 0.9) and out[2] == (0, "ANALYST_CONFIRMED_LEGIT", 0.9)
    assert out[3] == (None, "AUTO_MATURED_LEGIT", 0.9) and out[4] == (0, "AUTO_MATURED_LEGIT", 0.7) and out[6] == (None, "ANALYST_CONFIRMED_LEGIT", 0.9) and out[8] == (None, "MATURING", 0.0)


def test_drift_of_equal_shifted_and_constant(spark):
    ref = spark.createDataFrame([(float(i % 100), 1.0, None) for i in range(1000)], "a double, flat double, none double")
    cur = spark.createDataFrame([(float(i % 100) + 60, 1.0, None) for i in range(1000)], "a double, flat double, none double")
    same = {r.feature: r for r in drift.feature_drift_report(ref, ref, ["a", "flat", "none", "absent"]).collect()}
    assert (same["a"].psi, same["a"].ks_stat, same["a"].jsd, same["a"].status) == (0, 0, 0, "STABLE")
    assert same["flat"].status == "STABLE" and same["none"].status == "INSUFFICIENT_DATA" and same["absent"].status == "MISSING"
    moved = drift.feature_drift_report(ref, cur, ["a"])
    assert moved.first().status == "CRITICAL_DRIFT" and moved.first().ks_stat == 0.6
    assert drift.drift_summary(moved).first().overall_status == "CRITICAL_DRIFT"
    assert drift.drift_summary(moved.limit(0)).first().overall_status == "NO_DATA"


@SLOW
@given(st.lists(st.tuples(st.sampled_from([0.1, 0.2, 0.5, 0.9]), st.integers(0, 1)), min_size=2, max_size=14).filter(lambda x: 0 < sum(y for _, y in x) < len(x)))
def test_pr_curve_against_brute_force(spark, scored):
    df = spark.createDataFrame([(s, y) for s, y in scored], "s double, is_fraud int")
    p = sum(y for _, y in scored)
    want = {}
    for cut in {s for s, _ in scored}:
        tp, flagged = sum(y for s, y in scored if s >= cut), sum(1 for s, _ in scored if s >= cut)
        want[cut] = (tp / flagged, tp / p)
    got = {r.score: (r.precision, r.recall) for r in evaluate.pr_curve(df, ["s"]).collect()}
    assert {k: tuple(map(lambda x: round(x, 9), v)) for k, v in got.items()} == {k: tuple(map(lambda x: round(x, 9), v)) for k, v in want.items()}


@pytest.mark.parametrize("b, c", [(0, 0), (1, 0), (3, 9), (10, 10)])
def test_mcnemar(spark, b, c):
    df = spark.createDataFrame([(0.9, 0.1, 1)] * b + [(0.1, 0.9, 1)] * c + [(0.9, 0.9, 1)], "champion double, challenger double, is_fraud int")
    want = 1.0 if b + c == 0 else min(1.0, 2 * sum(math.comb(b + c, i) for i in range(min(b, c) + 1)) / 2 ** (b + c))
    assert abs(evaluate.mcnemar(df).first().p_value - want) < 1e-9


@SLOW
@given(st.lists(st.tuples(st.integers(0, 11), st.integers(0, 11)), max_size=14))
def test_components_against_brute_force(spark, edges):
    parent = list(range(12))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    df = spark.createDataFrame(edges + [(None, 1)], "src int, dst int")
    want = {x: root(x) for e in edges for x in e if e[0] != e[1]}
    assert {r.id: r.component for r in graph.connected_components(df).collect()} == want


def test_long_chain_of_components(spark):
    df = spark.range(300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert {r.component for r in graph.connected_components(df).collect()} == {0}


def test_global_rank_and_split(spark):
    df = spark.createDataFrame([(i, (i * 37) % 101) for i in range(200)], "transaction_id int, event_time_ts int")
    want = {i: n for n, (_, i) in enumerate(sorted(((i * 37) % 101, i) for i in range(200)), 1)}
    assert {r.transaction_id: r["rank"] for r in windows.with_global_rank(df, "event_time_ts", "transaction_id").collect()} == want
    assert dict(windows.chronological_split(df).groupBy("split").count().collect()) == {"train": 140, "validation": 30, "test": 30}


def test_velocity_ends_after_its_events(spark):
    df = spark.createDataFrame([("c", "a", 50.0, T0), ("c", "b", 150.0, T0 + dt.timedelta(seconds=30))], "card_id string, transaction_id string, amount double, event_time_ts timestamp_ntz")
    out = windows.card_velocity_5m(df).collect()
    assert len(out) == 5 and {(r.card_5m_count, r.card_5m_sum, r.card_5m_max) for r in out} == {(2, 200.0, 150.0)}
    assert min(r.feature_timestamp for r in out) > T0


def test_sharing_window(spark):
    h = dt.timedelta(hours=1)
    df = spark.createDataFrame([(1, "d", "x", T0), (2, "d", "y", T0 + h), (3, "d", "z", T0 + 30 * h), (4, None, "z", T0)], "transaction_id int, device_id string, customer_id string, event_time_ts timestamp_ntz")
    assert {r.transaction_id: r.sharing_count for r in graph.sharing_count(df, "device_id", "customer_id", 24).collect()} == {1: 1, 2: 2, 3: 1}


def test_profiles(spark):
    df = spark.createDataFrame([(i, None if i % 2 else 1, None if i % 2 else "x", "c") for i in range(10)], "k int, a int, b string, c string")
    assert {(r.columns, r.nulls) for r in profile.null_blocks(df, ["a", "b", "c"], "k").collect()} == {("a,b", 5), ("c", 0)}
    top = {r.column: r for r in profile.cardinality_profile(df, ["b", "c"]).collect()}
    assert (top["b"].levels, top["b"].null_rate, top["b"].top_value, top["c"].top_share) == (1, 0.5, "x", 1.0)


def test_kpis_of_nothing(spark):
    df = spark.createDataFrame([("v", 0.2, 0)], "model_version string, fraud_probability double, is_fraud_reconciled int")
    row = aggregates.model_kpis(df, "model_version").first()
    assert (row.precision, row.recall, row.false_positive_rate) == (None, None, 0.0)


def test_feature_vector(spark):
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([(1.0, float("nan"), dt.datetime(2026, 1, 1)), (None, float("inf"), None)], "feature_b double, feature_a double, feature_timestamp timestamp_ntz")
    names = scalars.feature_columns(df)
    assert names == ["feature_a", "feature_b"]
    assert [r[0] for r in scalars.feature_vector(df, names).select(vector_to_array("features")).collect()] == [[0.0, 1.0], [0.0, 0.0]]


def test_rare_levels(spark):
    df = spark.createDataFrame([(x,) for x in "aaabbc"] + [(None,)], "v string")
    assert sorted(str(r.v_bucket) for r in clean.bucket_rare_levels(df, "v", 2).collect()) == ["None", "a", "a", "a", "b", "b", "rare"]


def test_haversine_is_symmetric(spark):
    points = [(0.0, 0.0), (10.0, 20.0), (-45.0, 170.0)]
    df = spark.createDataFrame([(a, b, c, d) for (a, b), (c, d) in product(points, points)], "a double, b double, c double, d double")
    for r in df.select(scalars.haversine_km(*map(F.col, "abcd")).alias("x"), scalars.haversine_km(*map(F.col, "cdab")).alias("y")).collect():
        assert abs(r.x - r.y) < 1e-6
