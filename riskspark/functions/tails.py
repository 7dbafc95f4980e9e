"""The exact lower tail of a fair binomial, as a column, for any number of trials."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Coefficients of the series of ln n! - Stirling's formula, in odd powers of 1 / n. Fixed values.
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680)
TINY = 1e-300


def stirling_error(n: Column) -> Column:
    """ln n! - ln(sqrt(2 pi n) (n / e)^n), for n of at least 1."""
    x = n.cast("double")
    few = F.log(F.factorial(F.least(n, F.lit(15)).cast("int")).cast("double")) - (x + 0.5) * F.log(x) + x - 0.5 * math.log(2 * math.pi)
    series = F.lit(0.0)
    for i, c in enumerate(STIRLING):
        series = series + F.lit(c) / F.pow(x, F.lit(2 * i + 1))
    return F.when(n <= 15, few).otherwise(series)


def fair_point(n: Column, k: Column) -> Column:
    """P(X = k) of n fair trials, 0 < k <= n / 2, to full precision however large n is.

    Written around the mean, so that no difference of large logarithms is formed.
    """
    x, u = n.cast("double"), 1 - 2 * k / n
    away = x / 2 * ((1 - u) * F.log1p(-u) + (1 + u) * F.log1p(u))
    error = stirling_error(n) - stirling_error(k) - stirling_error(n - k)
    return F.sqrt(x / (2 * math.pi * k * (n - k))) * F.exp(error - away)


def _kept_off_zero(c: Column) -> Column:
    return F.when(F.abs(c) < TINY, F.lit(TINY)).otherwise(c)


def _steps(n: Column, k: Column) -> Column:
    """The continued fraction of the incomplete beta function at 1/2, for n - k and k + 1, by Lentz's way.

    It needs about sqrt(n) steps; they run as rows of steps within rows, so that
    memory grows with the fourth root of n.
    """
    a, b = (n - k).cast("double"), (k + 1).cast("double")
    d = 1 / _kept_off_zero(1 - (a + b) * 0.5 / (a + 1))
    width = F.ceil(F.sqrt(3 * F.sqrt(n.cast("double")) + 50)).cast("int")

    def step(acc: Column, m: Column) -> Column:
        first = m * (b - m) * 0.5 / ((a + 2 * m - 1) * (a + 2 * m))
        second = -(a + m) * (a + b + m) * 0.5 / ((a + 2 * m) * (a + 2 * m + 1))
        d1, c1 = 1 / _kept_off_zero(1 + first * acc["d"]), _kept_off_zero(1 + first / acc["c"])
        half = F.struct(d1.alias("d"), c1.alias("c"), (acc["h"] * d1 * c1).alias("h"))

        def rest(x: Column) -> Column:
            d2, c2 = 1 / _kept_off_zero(1 + second * x["d"]), _kept_off_zero(1 + second / x["c"])
            return F.struct(d2.alias("d"), c2.alias("c"), (x["h"] * d2 * c2).alias("h"), (F.abs(d2 * c2 - 1) < 1e-16).alias("done"))

        return F.get(F.transform(F.array(half), rest), F.lit(0))

    start = F.struct(d.alias("d"), F.lit(1.0).alias("c"), d.alias("h"), F.lit(False).alias("done"))
    row = lambda acc, i: F.aggregate(F.sequence(F.lit(1), width), acc, lambda x, j: F.when(x["done"], x).otherwise(step(x, (i * width + j).cast("double"))))
    return F.aggregate(F.sequence(F.lit(0), width), start, lambda acc, i: F.when(acc["done"], acc).otherwise(row(acc, i)), lambda acc: acc["h"])


def fair_tail(n: Column, k: Column) -> Column:
    """P(X <= k) of n fair trials, 0 <= k <= n / 2: the regularised incomplete beta function of n - k and k + 1 at 1/2."""
    inner = F.greatest(k, F.lit(1))
    beyond = fair_point(n, inner) / 2 * _steps(n, inner)
    return F.when(k == 0, F.exp(-n * math.log(2))).otherwise(beyond)
