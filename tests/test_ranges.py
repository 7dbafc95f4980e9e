import random
from itertools import accumulate

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.functions import ranges, skew
from riskspark.operators import graph


def test_sums_previous_rows_and_quantiles_of_dealt_groups(spark):
    r = random.Random(2)
    rows = [(g, v, r.randrange(5)) for g in "ab" for v in r.sample(range(1000), 200)] + [("c", 7, 3)]
    df = spark.createDataFrame(rows, "g string, v int, n int")
    for down in (False, True):
        summed = ranges.running_sums(df, "g", "v", {"n": "total"}, down)
        got = {(x.g, x.v): (x.total, x.prev_n) for x in ranges.previous_rows(summed, "g", "v", ["n"], down).collect()}
        for g in "abc":
            own = sorted((x for x in rows if x[0] == g), key=lambda x: x[1], reverse=down)
            assert [got[x[0], x[1]][0] for x in own] == list(accumulate(x[2] for x in own))
            assert [got[x[0], x[1]][1] for x in own] == [None, *(x[2] for x in own[:-1])]
    points = [0, 0.1, 0.5, 0.93, 1]
    repeated = df.select("g", F.explode(F.array_repeat("v", F.col("n") + 1)).alias("v")).unionByName(spark.createDataFrame([("a", None)], "g string, v int"))
    found = {x.g: x.quantiles for x in ranges.exact_quantiles(repeated, "g", "v", points).collect()}
    for g in "abc":
        assert found[g] == pytest.approx(np.quantile([v for x, v, n in rows if x == g for _ in range(n + 1)], points))
    assert ranges.exact_quantiles(repeated.limit(0), "g", "v", points).count() == 0


@pytest.mark.parametrize("parts", [2000, 3])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_joins_are_joins(spark, monkeypatch, parts, how):
    monkeypatch.setattr(skew, "HOT_PARTS", parts)
    rows = spark.createDataFrame([("a", i) for i in range(150)] + [("b", 1), ("c", 2), (None, 3)], "k string, i int")
    keys = spark.createDataFrame([("a", 10, 150), ("b", 20, 1), ("d", 30, None)], "k string, x int, n int")
    got = sorted(map(tuple, skew.join_hot(rows, keys, "k", "n", 153, how).select("k", "i", "x").collect()), key=str)
    assert got == sorted(map(tuple, rows.join(keys.drop("n"), "k", how).select("k", "i", "x").collect()), key=str)


def test_sharing_counts_against_brute_force(spark):
    r = random.Random(4)
    rows = [(i, r.choice([None, "d", "e"]), r.choice([None, "x", "y", "z", "w"]), r.randrange(40) * 1800) for i in range(300)]
    df = spark.createDataFrame(rows, "transaction_id int, device_id string, customer_id string, s int").withColumn("event_time_ts", F.timestamp_seconds(F.col("s")))
    got = {x.transaction_id: x.sharing_count for x in graph.sharing_count(df, "device_id", "customer_id", 3).collect()}
    assert got == {i: len({c for _, e, c, t in rows if e == d and c and s - 3 * 3600 <= t <= s}) for i, d, _, s in rows if d}


def test_components_with_hot_vertices(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_PARTS", 4)
    edges = [(0, i) for i in range(1, 150)] + [(1000 + i, 149) for i in range(150)] + [(5000 + i, 5001 + i) for i in range(9)]
    found = {x.id: x.component for x in graph.connected_components(spark.createDataFrame(edges, "src int, dst int")).collect()}
    assert found == {**{x: 0 for e in edges if e[1] < 5000 for x in e}, **{5000 + i: 5000 for i in range(10)}}


def test_first_rows_are_those_of_a_sort(spark):
    r = random.Random(6)
    rows = [(r.choice([None, 1, 2, 2, 3]), r.choice([None, "a", "b", "b", "c", "{}"])) for _ in range(60)]
    df = spark.createDataFrame(rows, "at int, raw string").repartition(5)
    order = lambda x: tuple((v is not None, v or 0 if i == 0 else v or "") for i, v in enumerate(x))
    for n in (0, 1, 7, 12, 29, 30, 31, 47, 59, 60, 3_000_000_000):
        found = ranges.first_rows(df, ["at", "raw"], n)
        assert sorted(map(tuple, found.collect()), key=order) == sorted(rows, key=order)[:n]
    assert ranges.first_rows(df.limit(0), ["at", "raw"], 5).count() == 0
