"""Tails of Student's t against tables, closed forms and numeric integration."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from procurelytics.functions import stats

# two-sided 5% and 1% points from printed tables
TABLE = [(1, 12.7062047362, 0.05), (2, 4.30265272975, 0.05), (5, 2.57058183564, 0.05), (10, 2.22813885196, 0.05), (30, 2.04227245630, 0.05), (120, 1.97993040505, 0.05),
         (1, 63.6567411629, 0.01), (10, 3.16927267262, 0.01), (30, 2.74999565357, 0.01), (120, 2.61742114477, 0.01)]


def closed(t, n):
    """The finite sum for whole degrees of freedom."""
    s, c2 = abs(t) / math.sqrt(n + t * t), n / (n + t * t)
    if n % 2 == 0:
        return 1 - s * sum(math.exp(math.lgamma(k + 0.5) - math.lgamma(k + 1)) / math.sqrt(math.pi) * c2**k for k in range(n // 2))
    rest = sum(math.exp(math.lgamma(k + 1) - math.lgamma(k + 1.5)) * math.sqrt(math.pi) / 2 * c2**k for k in range((n - 1) // 2))
    return 1 - 2 / math.pi * (math.asin(s) + s * math.sqrt(c2) * rest)


def test_tails(spark):
    rows = [(t, float(n), p) for n, t, p in TABLE]
    rows += [(float(t), float(n), closed(t, n)) for n in (1, 2, 3, 4, 7, 10, 57, 998) for t in (0.0, 1e-3, 0.3, 1.0, 2.5, 5.0)]
    df = spark.createDataFrame(rows, "t double, n double, p double")
    for r in df.withColumn("got", stats.t_p_value(F.col("t"), F.col("n"))).collect():
        assert r["got"] == pytest.approx(r["p"], abs=1e-8), r


def test_many_degrees_are_normal(spark):
    df = spark.createDataFrame([(1.959963984540054, 1e4)], "t double, n double")
    assert df.select(stats.t_p_value(F.col("t"), F.col("n")).alias("p")).first()[0] == pytest.approx(0.05, abs=5e-5)


def test_beta_by_integration(spark):
    cases = [(x, a, b) for x in (0.05, 0.4, 0.9) for a in (0.5, 2.0, 7.5) for b in (1.0, 3.3)]
    df = spark.createDataFrame(cases, "x double, a double, b double").withColumn("got", stats.incomplete_beta(F.col("x"), F.col("a"), F.col("b")))
    points, weights = np.polynomial.legendre.leggauss(60)
    for r in df.collect():
        # u = s^2 takes the root away from the lower end
        s = (points + 1) / 2 * math.sqrt(r["x"])
        part = (weights / 2 * math.sqrt(r["x"]) * 2 * s * s ** (2 * r["a"] - 2) * (1 - s * s) ** (r["b"] - 1)).sum()
        whole = math.exp(math.lgamma(r["a"]) + math.lgamma(r["b"]) - math.lgamma(r["a"] + r["b"]))
        assert r["got"] == pytest.approx(part / whole, abs=1e-7), r


def test_edges(spark):
    df = spark.createDataFrame([(0.0, 10), (1.0, 10), (None, 10), (0.5, 2), (float("nan"), 9)], "r2 double, n int")
    assert [r[0] for r in df.select(stats.correlation_p_value(F.col("r2"), F.col("n"))).collect()] == [1.0, 0.0, None, None, None]
