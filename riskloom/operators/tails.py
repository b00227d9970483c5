"""Tail probabilities of test statistics: chi-squared at any degrees of freedom, exact two-sample Kolmogorov-Smirnov."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F


def _stirling(a: Column) -> Column:
    """log-gamma(a) less (a - 1/2) log a - a + log(2 pi) / 2, for a of 10 or more."""
    return 1 / (12 * a) - 1 / (360 * a ** 3) + 1 / (1260 * a ** 5) - 1 / (1680 * a ** 7) + 1 / (1188 * a ** 9)


def _front(a: Column, h: Column) -> Column:
    """exp(-h) h**a / gamma(a).  Written around h = a, so that large a cancels nothing; below 10 by ten steps upwards."""
    d = (h - a) / a
    large = F.sqrt(a / (2 * math.pi)) * F.exp(a * (F.log1p(d) - d) - _stirling(a))
    b = a + 10
    steps = F.lit(1.0)
    for k in range(10):
        steps = steps * (a + k)
    log_gamma = (b - 0.5) * F.log(b) - b + 0.5 * math.log(2 * math.pi) + _stirling(b) - F.log(steps)
    return F.when(a >= 10, large).otherwise(F.exp(a * F.log(h) - h - log_gamma))


def chi2_sf(x: Column, dof: Column) -> Column:
    """Upper tail of the chi-squared distribution for any positive ``dof``.

    Below the mean by the power series of the lower incomplete gamma function, above it by the continued fraction of the
    upper one (modified Lentz).  Both settle within a number of terms that grows with the square root of ``dof``."""
    a, h = (dof / F.lit(2.0)).cast("double"), (x / F.lit(2.0)).cast("double")
    terms = (F.lit(80) + 12 * F.sqrt(a)).cast("int")
    steps = F.sequence(F.lit(1), terms)
    one = (F.lit(1.0) / a)
    series = F.aggregate(steps, F.struct(one.alias("t"), one.alias("s")), lambda acc, k: F.struct(
        (acc["t"] * h / (a + k)).alias("t"), (acc["s"] + acc["t"] * h / (a + k)).alias("s")))["s"]
    tiny = F.lit(1e-300)
    b0 = h + 1 - a
    start = F.struct((1 / tiny).alias("c"), (1 / b0).alias("d"), (1 / b0).alias("f"))

    def lentz(acc, k):
        an, b = -1.0 * k * (k - a), b0 + 2 * k
        guard = lambda v: F.when(F.abs(v) < tiny, tiny).otherwise(v)
        d = 1 / guard(an * acc["d"] + b)
        c = guard(b + an / acc["c"])
        return F.struct(c.alias("c"), d.alias("d"), (acc["f"] * d * c).alias("f"))

    upper = F.aggregate(steps, start, lentz)["f"]
    q = F.when(h < a + 1, F.lit(1.0) - _front(a, h) * series).otherwise(_front(a, h) * upper)
    return F.when(x <= 0, F.lit(1.0)).otherwise(F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0)))


def ks_exact(d: float, n1: int, n2: int) -> float:
    """P(D >= d) of two samples of ``n1`` and ``n2`` values without ties: the share of lattice paths that leave the band.

    A path of n1 steps right and n2 steps up is a way to merge the samples; ``out[i]`` is the share of the paths to the
    point (i, s - i) that have touched a gap of ``d`` or more, for all points of a diagonal at once."""
    g = math.gcd(n1, n2)
    up, right = n1 // g, n2 // g
    h = round(d * n1 * right)  # the gap in units of 1 / lcm(n1, n2)
    if h <= 0:
        return 1.0
    out = np.ones(n1 + 3)
    out[1] = 0.0  # point (0, 0); place i + 1 belongs to i
    for s in range(1, n1 + n2 + 1):
        lo = max(0, s - n2, -((h - s * up) // (up + right)) if False else (s * up - h) // (up + right) + 1)
        hi = min(n1, s, -((-s * up - h) // (up + right)) - 1)
        if lo > hi:
            return 1.0
        i = np.arange(lo, hi + 1)
        out[lo + 1:hi + 2] = out[lo:hi + 1] * (i / s) + out[lo + 1:hi + 2] * ((s - i) / s)
        out[lo] = out[hi + 2] = 1.0
    return float(min(1.0, out[n1 + 1]))


def ks_exact_column():
    """``ks_exact`` for a column of statistics; NULL where an argument is.  It is called on grouped results, a row a feature."""
    @F.pandas_udf("double")
    def pvalue(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
        # a batch with a NULL size arrives as floats with NaN, which is not false
        known = ~(d.isna() | n1.isna() | n2.isna() | (n1 == 0) | (n2 == 0))
        return pd.Series([ks_exact(float(x), int(a), int(b)) if k else None for x, a, b, k in zip(d, n1, n2, known)], dtype="float64")

    return pvalue
