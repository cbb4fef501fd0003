"""Tails of Student's t as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from procurelytics.functions.text import let

#: Terms of the continued fraction; enough for 1e-10 up to some 10,000 degrees of freedom.
TERMS = 200
TINY = 1e-300


def log_gamma(z: Column) -> Column:
    """ln of the gamma function for positive ``z``: moved up by eight, then Stirling's series."""
    product = z
    for k in range(1, 8):
        product = product * (z + k)
    w = z + 8
    series = 1 / (12 * w) - 1 / (360 * F.pow(w, 3)) + 1 / (1260 * F.pow(w, 5)) - 1 / (1680 * F.pow(w, 7))
    return (w - 0.5) * F.ln(w) - w + 0.5 * math.log(2 * math.pi) + series - F.ln(product)


def _away(value: Column) -> Column:
    return F.when(F.abs(value) < TINY, F.lit(TINY)).otherwise(value)


def _fraction(x: Column, a: Column, b: Column) -> Column:
    """The continued fraction of the incomplete beta function, term by term from the front."""
    def term(i: Column) -> Column:
        m = F.floor(i / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return F.when(i == 0, 1.0).when(i % 2 == 0, even).otherwise(odd)

    def step(acc: Column, t: Column) -> Column:
        def joined(cd: Column) -> Column:
            return F.struct(cd["c"].alias("c"), cd["d"].alias("d"), (acc["h"] * cd["c"] * cd["d"]).alias("h"))

        c, d = _away(1 + t / acc["c"]), 1 / _away(1 + t * acc["d"])
        return let(F.struct(c.alias("c"), d.alias("d")), joined)

    # 1 / (1 + t1 / (1 + t2 / ...)): ratios of neighbouring numerators (c) and denominators (d)
    terms = F.transform(F.sequence(F.lit(1), F.lit(2 * TERMS)), term)
    start = F.struct(F.lit(1.0).alias("c"), F.lit(0.0).alias("d"), F.lit(1.0).alias("h"))
    return 1 / F.aggregate(terms, start, step, lambda acc: acc["h"])


def incomplete_beta(x: Column, a: Column, b: Column) -> Column:
    """The regularised incomplete beta function of ``x`` in [0, 1] for positive ``a`` and ``b``."""
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.ln(x) + b * F.ln(1 - x))
    low, high = front * _fraction(x, a, b) / a, 1 - front * _fraction(1 - x, b, a) / b
    inside = F.when(x < (a + 1) / (a + b + 2), low).otherwise(high)
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(inside)


def correlation_p_value(r2: Column, n: Column) -> Column:
    """Chance of a squared correlation (or R squared of a straight line) of at least ``r2`` in ``n`` unrelated
    pairs: the two-sided tail of Student's t with n - 2 degrees of freedom.  NULL below three pairs."""
    def tail(v: Column) -> Column:
        return F.when((v["n"] > 2) & v["r2"].isNotNull() & ~F.isnan(v["r2"]), incomplete_beta(1 - v["r2"], (v["n"] - 2) / 2, F.lit(0.5)))

    return let(F.struct(r2.cast("double").alias("r2"), n.cast("double").alias("n")), tail)


def t_p_value(t: Column, freedom: Column) -> Column:
    """Two-sided tail of Student's t."""
    return F.when(freedom > 0, incomplete_beta(freedom / (freedom + t * t), freedom / 2, F.lit(0.5)))
