import random
from fractions import Fraction

import numpy as np
import pytest

from riskspark.operators import calibration


def max_min(rows):
    """Isotonic values by their definition: the greatest, over starts up to a score, of the least means from there on."""
    scores = sorted({s for s, _ in rows})
    at = {s: [y for t, y in rows if t == s] for s in scores}
    out = {}
    for i, s in enumerate(scores):
        best = Fraction(-1)
        for j in range(i + 1):
            pos, n, least = 0, 0, Fraction(2)
            for k in range(j, len(scores)):
                pos, n = pos + sum(at[scores[k]]), n + len(at[scores[k]])
                least = min(least, Fraction(pos, n)) if k >= i else least
            best = max(best, least)
        out[s] = float(best)
    return out


@pytest.mark.parametrize("fan", [2, 16])
def test_blocks_are_the_isotonic_fit(spark, monkeypatch, fan):
    monkeypatch.setattr(calibration, "FAN", fan)
    r = random.Random(fan)
    rows = [(s, int(r.random() < s / 60)) for s in (float(r.randrange(50)) for _ in range(600))]
    odd = [(None, 1), (float("nan"), 1), (3.0, None)]
    df = spark.createDataFrame([*rows, *odd], "s double, y int").repartition(7)
    blocks = calibration.isotonic_blocks(df, "s", "y")
    got = sorted(map(tuple, blocks.collect()))
    want = max_min(rows)
    assert sum(b[3] for b in got) == len(rows) and all(a[4] < b[4] and a[1] < b[0] for a, b in zip(got, got[1:], strict=False))
    value = {x.s: x.calibrated for x in calibration.calibrate_by_blocks(df, blocks, "s").filter("s is not null and not isnan(s)").collect()}
    assert {s: pytest.approx(v) for s, v in want.items()} == value
    outside = calibration.calibrate_by_blocks(spark.createDataFrame([(-9.0,), (99.0,), (None,)], "s double"), blocks, "s").collect()
    assert [x.calibrated for x in outside] == [pytest.approx(got[0][4]), pytest.approx(got[-1][4]), None]


def test_blocks_of_falling_rising_and_no_rows(spark):
    fall = spark.createDataFrame([(float(i), int(i < 50)) for i in range(100)], "s double, y int").repartition(5)
    assert [tuple(b) for b in calibration.isotonic_blocks(fall, "s", "y").collect()] == [(0.0, 99.0, 50, 100, 0.5)]
    rise = spark.createDataFrame([(float(i), int(i >= 50)) for i in range(100)], "s double, y int").repartition(5)
    assert sorted(tuple(b)[:2] for b in calibration.isotonic_blocks(rise, "s", "y").collect()) == [(0.0, 49.0), (50.0, 99.0)]
    none = calibration.isotonic_blocks(rise.limit(0), "s", "y")
    assert none.count() == 0 and calibration.calibrate_by_blocks(rise.limit(2), none, "s").filter("calibrated is null").count() == 2


def test_components_and_residuals_are_those_of_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4)) @ rng.normal(size=(4, 4)) + [5, 0, -3, 100]
    df = spark.createDataFrame([(*map(float, row), 7.0) for row in x] + [(None, 1.0, 1.0, 1.0, 7.0), (float("nan"), 1.0, 1.0, 1.0, 7.0)], "a double, b double, c double, d double, flat double").repartition(6)
    table = calibration.fit_components(df, ["a", "b", "c", "d", "flat"], 2)
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    size, vectors = np.linalg.eigh(np.corrcoef(z.T))
    got = {(r.component, r.feature): r for r in table.collect()}
    for c in range(2):
        v = vectors[:, 3 - c]
        v = v * np.sign(v[np.argmax(np.abs(v))])
        assert [got[c, f].weight for f in "abcd"] == pytest.approx(v.tolist(), abs=1e-9) and got[c, "flat"].weight == pytest.approx(0)
        assert got[c, "a"].share == pytest.approx(size[3 - c] / 4)
    left = z - z @ vectors[:, 2:] @ vectors[:, 2:].T
    want = np.linalg.norm(left, axis=1) / np.linalg.norm(z, axis=1)
    rows = calibration.residual_score(df, table).collect()
    assert sorted(r.anomaly_score for r in rows if r.anomaly_score is not None) == pytest.approx(sorted(want.tolist()), abs=1e-6)
    assert sum(r.anomaly_score is None for r in rows) == 2
    assert calibration.fit_components(df.limit(0), ["a", "b"], 2).count() == 4
