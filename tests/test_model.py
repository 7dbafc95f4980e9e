import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskspark.operators import model
from riskspark.plans import catalogue


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(y), float(x + 2 * y), float(z), float(x)) for i, (y, x, z) in enumerate(zip(rng.random(400) < 0.3, rng.normal(size=400), rng.normal(size=400), strict=True))]
    return spark.createDataFrame(rows, "transaction_id long, y int, a double, b double, c double").withColumn("features", array_to_vector(F.array("a", "b", "c"))).cache()


def test_column_choice_and_ordinals(spark):
    df = spark.createDataFrame([(1.0, None, 5.0, "b"), (9.0, None, 5.0, "a"), (4.0, 1.0, 5.0, None)], "a double, n double, flat double, v string")
    assert model.select_columns(df, ["a", "n", "flat"], most_null=0.5) == ["a"]
    coded = model.fit_ordinals(df, ["v"])
    assert [r.v_idx for r in model.ordinal_encode(spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "v string"), coded).collect()] == [0, 1, -1, -1]


def test_classifier_and_shadow(train):
    best, area, passed = model.train_classifier(train, "y", floor=0.5, depths=(2,), trees=5)
    assert passed and area > 0.5
    scored = model.shadow_scores(train, best, best, ("v1", "v2")).collect()
    assert len(scored) == 400 and all(r.delta == 0 and not r.is_error for r in scored)


def test_anomalies(spark, train):
    fitted = model.anomaly_model(train.filter("y = 0"), components=2)
    scores = [r.anomaly_score for r in model.anomaly_score(train, fitted).collect()]
    assert all(0 <= s <= 1.000001 for s in scores)


def test_calibration_and_stack(spark, train):
    iso = model.fit_isotonic(train, "a", "y")
    wide = spark.createDataFrame([(s,) for s in (-5.0, -1.0, 0.0, 2.5, 10.0, 100.0)], "a double")
    p = [r.calibrated for r in model.calibrate(wide, iso, "a").collect()]
    assert all(0 <= x <= 1 for x in p) and p == sorted(p)
    q = [r.calibrated for r in model.calibrate(wide, model.fit_sigmoid(train, "a", "y"), "a").collect()]
    assert all(0 <= x <= 1 for x in q) and q == sorted(q)
    stacked = model.fit_stack(train, ["a", "b"], "y")
    out = model.stack_scores(train, stacked, ["a", "b"], "v9")
    direct = stacked.transform(train.withColumn("__x", array_to_vector(F.array("a", "b"))))
    both = out.join(direct.select("transaction_id", "probability"), "transaction_id").limit(20).collect()
    assert all(abs(r.fraud_probability - r.probability[1]) < 1e-9 and r.model_version == "v9" for r in both)


def test_risk_factors(spark):
    df = spark.createDataFrame([(3.0, 1.0, None), (0.0, 0.0, 5.0)], "a double, b double, c double")
    rows = model.top_risk_factors(df, {"a": 1.0, "b": 2.0, "c": -1.0}, {"a": 1.0, "b": 0.5, "c": 1.0}, k=2).collect()
    assert [[f.feature for f in r.top_risk_factors] for r in rows] == [["a", "b"], []]


def test_equal_risk_factors_come_as_in_their_sql(spark, tmp_path):
    """Few amounts, merchants and cards, so that contributions are often equal, also but for the rounding of doubles."""
    duckdb = pytest.importorskip("duckdb")
    r = random.Random(5)
    rows = []
    for i in range(4000):
        a, m, c = (r.choice([-2, 3, 5, 10, 15, 31, 40]) for _ in range(3))  # tenths of contribution
        rows.append((i, dt.datetime(2024, 1, 1), 70 + 5 * c, "purchase", 20 + a / 5, json.dumps({"k": 50 - m})))
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect(config={"threads": 1})  # with more, a tie in 100,000 falls otherwise from run to run
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    want = sorted(con.execute(catalogue.ORACLES["d26_top_risk_factors"]).fetchall())
    assert sorted(map(tuple, catalogue.QUERIES["d26_top_risk_factors"](spark, str(tmp_path)).collect())) == want


def test_risk_factors_of_coefficients_too_long_for_decimals(spark):
    df = spark.createDataFrame([(5, 2**62)], "a int, b long")
    rows = model.top_risk_factors(df, {"a": 1.2345678901234567e-9, "b": 1.2345678901234567e-9}, {"a": 0.1234567890123456, "b": 1e20 / 3}, k=2).collect()
    assert [(f.feature, f.contribution) for f in rows[0].top_risk_factors] == [("a", pytest.approx(1.2345678901234567e-9 * (5 - 0.1234567890123456)))]
