"""The n-th root is the nearest double, whatever the platform's pow says."""
from __future__ import annotations

import math
import random
from decimal import Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from barsmith.functions.numeric import compound_growth, nth_root, refined_root


def nearest_root(x: float, n: int) -> float:
    getcontext().prec = 120
    y, exact = Decimal(x ** (1 / n)), Decimal(x)
    for _ in range(8):
        y -= (y ** n - exact) / (n * y ** (n - 1))
    return float(y)  # Python rounds a decimal correctly


@pytest.mark.parametrize("n", [1, 2, 5, 12])
def test_roots_are_correctly_rounded(spark, n):
    rnd = random.Random(n)
    xs = [rnd.uniform(0.01, 100) for _ in range(500)] + [math.exp(rnd.uniform(-300, 300)) for _ in range(200)] + [1.0, 2.0 ** (5 * n), 0.1, 1e-9]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert [r.y for r in df.select(nth_root(F.col("x"), n).alias("y")).collect()] == [nearest_root(x, n) for x in xs]


def test_a_start_some_units_off_gives_the_same_root(spark):
    rnd = random.Random(7)
    data = []
    for _ in range(300):
        x = rnd.uniform(0.05, 20)
        y = x ** 0.2
        for _ in range(rnd.randrange(4)):
            y = math.nextafter(y, rnd.choice([0, 9]))
        data.append((x, y))
    df = spark.createDataFrame(data, "x double, y double")
    assert [r.r for r in df.select(refined_root(F.col("x"), F.col("y"), 5).alias("r")).collect()] == [nearest_root(x, 5) for x, _ in data]


def test_edges(spark):
    df = spark.createDataFrame([(0.0,), (float("inf"),), (float("nan"),), (None,), (1e-300,), (1e300,)], "x double")
    got = [r.y for r in df.select(nth_root(F.col("x"), 5).alias("y")).collect()]
    assert got[0] == 0.0 and got[1] == math.inf and math.isnan(got[2]) and got[3] is None and got[4] == pytest.approx(1e-60) and got[5] == pytest.approx(1e60)
    one = spark.createDataFrame([(100.0, 160.0)], "a double, b double").select(compound_growth(F.col("a"), F.col("b"), 5).alias("g")).collect()
    assert one[0].g == nearest_root(1.6, 5) - 1.0
