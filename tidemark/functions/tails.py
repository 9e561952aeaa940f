"""Tail probabilities for final readout rows (one row per metric, never per user).

Spark has no Student t, chi-square or normal distribution functions. They are evaluated here with
the regularised incomplete beta and gamma functions (continued fraction / power series) in Arrow
batches over frames that hold a few rows per metric.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TINY = 1e-300
_EPS = 1e-15


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    # modified Lentz evaluation of the continued fraction
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    result = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        change = 1.0
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > _TINY else _TINY)
            c = 1.0 + term / c
            c = c if abs(c) > _TINY else _TINY
            change = c * d
            result *= change
        if abs(change - 1.0) < _EPS:
            break
    return front * result / a


def upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0.0:
        return 1.0
    if math.isinf(x):
        return 0.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * _EPS:
            k += 1.0
            term *= x / k
            total += term
        return 1.0 - scale * total
    b = x + 1.0 - a
    c, d = 1.0 / _TINY, 1.0 / b
    result = d
    for i in range(1, 1000):
        step = -i * (i - a)
        b += 2.0
        d = 1.0 / (step * d + b or _TINY)
        c = b + step / c or _TINY
        result *= c * d
        if abs(c * d - 1.0) < _EPS:
            break
    return scale * result


def t_two_sided(t: float, df: float) -> float:
    if math.isinf(t):
        return 0.0
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def t_quantile(q: float, df: float) -> float:
    """Inverse Student t CDF by bisection; q in (0.5, 1)."""
    low, high = 0.0, 1.0
    while 1.0 - 0.5 * t_two_sided(high, df) < q:
        high *= 2.0
    for _ in range(200):
        mid = 0.5 * (low + high)
        if 1.0 - 0.5 * t_two_sided(mid, df) < q:
            low = mid
        else:
            high = mid
        if high - low <= 1e-15 * high:
            break
    return 0.5 * (low + high)


def _apply(function, *series: pd.Series) -> pd.Series:
    rows = zip(*series, strict=True)
    return pd.Series([None if any(pd.isna(v) for v in row) else function(*map(float, row)) for row in rows],
                     dtype="float64")


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided Student t p-value."""
    return _apply(t_two_sided, t, df)


@F.pandas_udf(T.DoubleType())
def t_critical(q: pd.Series, df: pd.Series) -> pd.Series:
    """Student t quantile."""
    return _apply(t_quantile, q, df)


@F.pandas_udf(T.DoubleType())
def normal_pvalue(z: pd.Series) -> pd.Series:
    """Two-sided normal p-value."""
    return _apply(lambda v: math.erfc(abs(v) / math.sqrt(2.0)), z)


@F.pandas_udf(T.DoubleType())
def chi2_pvalue(x: pd.Series, df: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution."""
    return _apply(lambda v, k: upper_gamma(k / 2.0, v / 2.0), x, df)


# 97.5 % point of the standard normal distribution (fixed value)
Z_975 = 1.959963984540054
