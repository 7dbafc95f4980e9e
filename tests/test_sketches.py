"""Sketches against exact measures, and the binomial tail against whole numbers."""

import datetime as dt
import random
from fractions import Fraction
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.functions.tails import fair_tail
from riskspark.operators import aggregates, drift, evaluate, windows


def tails(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, k long")
    return {(r.n, r.k): r.p for r in df.select("n", "k", fair_tail(F.col("n"), F.col("k")).alias("p")).collect()}


def test_tail_is_that_of_whole_numbers(spark):
    pairs = [(n, k) for n in (1, 2, 3, 7, 16, 31, 40, 101, 1000) for k in sorted({0, 1, n // 10, n // 3, max(0, (n - 1) // 2)}) if 2 * k < n] + [(20_000, 9_800), (20_000, 9_999), (20_000, 3_000)]
    for (n, k), p in tails(spark, pairs).items():
        want = float(Fraction(sum(comb(n, i) for i in range(k + 1)), 2**n))
        assert p == pytest.approx(want, rel=1e-11), (n, k)


def test_tail_of_three_billion(spark):
    n = 3_000_000_000
    pairs = [(n, n // 2 - d) for d in (1, 1000, 50_000, 200_000)]
    for (_, k), p in tails(spark, pairs).items():
        u = 1 - 2 * k / n
        point = np.sqrt(2 / (np.pi * n * (1 - u * u))) * np.exp(-n / 2 * ((1 - u) * np.log1p(-u) + (1 + u) * np.log1p(u)) - 1 / (4 * n))
        j = np.arange(1_500_000.0)
        want = point * (1 + np.exp(np.cumsum(np.log((k - j) / (n - k + 1 + j)))).sum())
        assert p == pytest.approx(want, rel=1e-7)


def test_mcnemar_of_more_pairs_than_an_int_holds(spark, monkeypatch):
    df = spark.createDataFrame([(0.9, 0.1, 1)] * 3 + [(0.1, 0.9, 1)] * 12, "champion double, challenger double, is_fraud int")
    row = evaluate.mcnemar(df).first()
    assert (row.b, row.c) == (3, 12) and row.p_value == pytest.approx(2 * sum(comb(15, i) for i in range(4)) / 2**15)
    assert evaluate.mcnemar(df.limit(0)).first().p_value == 1.0
    even = evaluate.mcnemar(df.filter("champion > 0.5").unionByName(df.filter("champion < 0.5").limit(3))).first()
    assert (even.b, even.c, even.p_value) == (3, 3, 1.0)


@pytest.fixture(scope="module")
def sides(spark):
    r = np.random.default_rng(4)
    n = 30_000
    columns = {"same": (r.normal(size=n), r.normal(size=n)), "moved": (r.normal(size=n), r.normal(0.5, 1.3, n)), "coarse": (r.integers(0, 7, n), r.integers(0, 9, n)), "flat": (np.full(n, 2.0), np.full(n, 2.0)), "apart": (r.random(n), 5 + r.random(n))}
    frames = []
    for i in range(2):
        rows = [tuple(float(x) for x in row) for row in zip(*[c[i] for c in columns.values()], strict=True)]
        frames.append(spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(6))
    return frames, list(columns)


def test_sketched_measures_are_near_exact_ones(sides):
    (reference, current), names = sides
    values = drift.long_form(reference, current, names)
    got = {r.feature: r for r in drift.sketched_measures(drift.side_sketches(values, 1024)).collect()}
    exact = {r.feature: r for r in drift.psi(values).join(drift.ks_2samp(values), "feature").join(drift.jsd(values), "feature").collect()}
    assert set(got) == set(exact) == set(names)
    for f in names:
        assert got[f].ks_stat == pytest.approx(exact[f].ks_stat, abs=3 * drift.rank_error(1024) + 0.001), f
        assert got[f].jsd == pytest.approx(exact[f].jsd, abs=0.01), f
        if f != "coarse":  # edges between two of few values differ by interpolation
            assert got[f].psi == pytest.approx(exact[f].psi, abs=0.03, rel=0.05), f


def test_sketches_merge_over_days(sides):
    (reference, current), names = sides
    values = drift.long_form(reference, current, names).withColumn("day", F.pmod(F.hash("value"), F.lit(9)))
    daily = drift.side_sketches(values, 1024, "day")
    whole = {r.feature: r for r in drift.sketched_measures(drift.side_sketches(values, 1024)).collect()}
    for r in drift.sketched_measures(drift.merged_sketches(daily)).collect():
        assert (r.ref_n, r.cur_n) == (whole[r.feature].ref_n, whole[r.feature].cur_n)
        assert r.ks_stat == pytest.approx(whole[r.feature].ks_stat, abs=6 * drift.rank_error(1024))


def test_no_value_is_shuffled_by_sketches(sides):
    (reference, current), names = sides
    plan = drift.side_sketches(drift.long_form(reference, current, names))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(feature" in plan and "hashpartitioning(feature#" in plan and ", value" not in plan.split("hashpartitioning")[1][:60]


def test_sketched_report_has_every_feature(spark, sides):
    (reference, current), names = sides
    few = current.limit(5)
    out = {r.feature: r.status for r in drift.feature_drift_report(reference, current, [*names, "absent"], sketch=2048).collect()}
    assert out == {"same": "STABLE", "moved": "CRITICAL_DRIFT", "coarse": "CRITICAL_DRIFT", "flat": "STABLE", "apart": "CRITICAL_DRIFT", "absent": "MISSING"}
    assert {r.status for r in drift.feature_drift_report(reference, few, names, sketch=2048).collect()} == {"INSUFFICIENT_DATA"}
    none = drift.feature_drift_report(reference.limit(0), current.limit(0), ["same"], sketch=2048).first()
    assert (none.ref_n, none.cur_n, none.status) == (0, 0, "INSUFFICIENT_DATA")


def test_distinct_counts_unite_over_days(spark):
    r = random.Random(1)
    day = dt.date(2026, 1, 1)
    rows = [(day + dt.timedelta(days=r.randrange(20)), r.choice("ab"), r.randrange(40_000), None if i % 5 else i) for i in range(60_000)] + [(day, "c", None, None)]
    df = spark.createDataFrame(rows, "event_date date, shop string, card int, device int")
    stored = aggregates.distinct_sketches(df, ["card", "device"], "event_date", "shop")
    as_of = F.lit(day + dt.timedelta(days=15)).cast("timestamp_ntz")
    got = {x.shop: x for x in aggregates.distinct_as_of(stored, ["card", "device"], as_of, 10, "shop").collect()}
    for shop in "ab":
        own = [x for x in rows if x[1] == shop and 5 <= (x[0] - day).days < 15]
        assert got[shop].rows == len(own)
        for c, i in (("card", 2), ("device", 3)):
            assert got[shop][f"distinct_{c}"] == pytest.approx(len({x[i] for x in own} - {None}), rel=0.05)
    assert {x.shop: x.distinct_card for x in aggregates.united_distinct(stored, ["card"], "shop").collect()}["c"] == 0


def test_panes_give_the_windows_of_whole_rows(spark):
    r = random.Random(2)
    rows = [(r.randrange(3), dt.datetime(2026, 1, 1, 12) + dt.timedelta(seconds=r.randrange(9000)), None if r.random() < 0.1 else r.random(), None if r.random() < 0.2 else r.randrange(30)) for _ in range(800)]
    df = spark.createDataFrame(rows, "customer_id int, event_time_ts timestamp_ntz, amount double, merchant_id int")
    panes = windows.velocity_by_panes(df, "customer_id", "1 hour", "5 minutes", "customer_1h_", distinct="merchant_id")
    whole = windows.customer_velocity_1h(df, exact=True)
    as_rows = lambda x: sorted((a.customer_id, a.feature_timestamp, a.customer_1h_count, round(a.customer_1h_sum or 0, 6), round(a.customer_1h_avg or 0, 6), a.customer_1h_distinct_merchant_id) for a in x.collect())
    assert as_rows(panes) == as_rows(whole)
