"""Tail probabilities for the t and chi-square tests, in plain Python.

Only the one-row test summaries go through these, via an Arrow-batched pandas
UDF; the statistics themselves are Spark aggregates. The formulas are those of
the NIST Digital Library of Mathematical Functions (DLMF): the incomplete beta
function's continued fraction 8.17.22 and the incomplete gamma function's series
8.11.4, continued fraction 8.9.2 and uniform expansion 8.12. Both ``x`` and
``1 - x`` are formed directly from the statistic, tails are never ``1 - cdf`` where
they are small, and large degrees of freedom go through expansions whose error
falls with them. A computation that does not settle raises.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

LARGE = 1e4  # from here on the expansions in 1/df are exact to double precision


def _fraction(part: Callable[[int], tuple[float, float]], most: int = 1 << 16) -> float:
    """``a1/(b1 + a2/(b2 + ...))`` with ``part(k) = (ak, bk)``, cut ever deeper until it settles."""
    depth, last = 16, math.nan
    while depth <= most:
        value = 0.0
        for k in range(depth, 0, -1):
            a, b = part(k)
            value = a / (b + value)
        if abs(value - last) <= 4e-16 * abs(value):
            return value
        depth, last = 2 * depth, value
    raise ArithmeticError("continued fraction did not settle")


def _log_beta(a: float, b: float) -> float:
    if b == 0.5 and a >= 50:
        # DLMF 5.11.13: gamma(a + 1/2) / gamma(a), so that no large logarithms are subtracted.
        r = 1 / a
        ratio = 1 + r * (-1 / 8 + r * (1 / 128 + r * (5 / 1024 + r * (-21 / 32768))))
        return math.lgamma(0.5) - 0.5 * math.log(a) - math.log(ratio)
    return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)


def _beta_lower(a: float, b: float, x: float, y: float) -> float:
    """I_x(a, b) for ``x`` below the distribution's bulk; ``y = 1 - x``."""
    def part(k: int) -> tuple[float, float]:
        if k == 1:
            return 1.0, 1.0
        m, odd = divmod(k - 1, 2)
        if odd:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    front = a * (math.log(x) if x < 0.5 else math.log1p(-y)) + b * (math.log(y) if y < 0.5 else math.log1p(-x))
    return math.exp(front - _log_beta(a, b)) * _fraction(part) / a


def betainc_reg(a: float, b: float, x: float, y: float | None = None) -> float:
    """Regularized incomplete beta I_x(a, b); ``y`` is ``1 - x`` where it is known better."""
    y = 1.0 - x if y is None else y
    if x <= 0.0:
        return 0.0
    if y <= 0.0:
        return 1.0
    if x < (a + 1.0) / (a + b + 2.0):
        return _beta_lower(a, b, x, y)
    return 1.0 - _beta_lower(b, a, y, x)


def _gamma_uniform(s: float, x: float) -> float:
    """Q(s, x) for large ``s``: DLMF 8.12.4 and 8.12.7 with two coefficients."""
    mu = (x - s) / s
    if abs(mu) < 1e-4:
        half = mu * mu * (1 / 2 - mu * (1 / 3 - mu / 4))
    else:
        half = mu - math.log1p(mu)
    eta = math.copysign(math.sqrt(2 * half), mu)
    if abs(eta) < 0.03:
        c0 = -1 / 3 + eta * (1 / 12 + eta * (-2 / 135 + eta * (1 / 864 + eta / 2835)))
        c1 = -1 / 540 + eta * (-1 / 288 + eta / 378)
    else:
        c0 = 1 / mu - 1 / eta
        c1 = 1 / eta**3 - 1 / mu**3 - 1 / mu**2 - 1 / (12 * mu)
    rest = math.exp(-s * half) / math.sqrt(2 * math.pi * s) * (c0 + c1 / s)
    return min(1.0, max(0.0, 0.5 * math.erfc(eta * math.sqrt(s / 2)) + rest))


def gammainc_upper_reg(s: float, x: float) -> float:
    """Regularized upper incomplete gamma Q(s, x)."""
    if x <= 0.0:
        return 1.0
    if math.isinf(x):
        return 0.0
    if s >= LARGE:
        return _gamma_uniform(s, x)
    if x < s + 1.0:  # P is the smaller or a similar part
        front = s * math.log(x) - x - math.lgamma(s + 1)
        total, term, n = 1.0, 1.0, 0
        while term > 1e-17 * total:
            n += 1
            term *= x / (s + n)
            total += term
        return max(0.0, 1.0 - math.exp(front) * total)
    front = s * math.log(x) - x - math.lgamma(s)
    return math.exp(front) * _fraction(lambda k: (1.0 if k == 1 else (k - 1) * (s - (k - 1)), x + 2 * k - 1 - s))


def _t_large(t: float, df: float) -> float:
    """The normal deviate of ``t``: Hill's expansion (Communications of the ACM 13, 1970)."""
    a = df - 0.5
    b = 48 * a * a
    w2 = a * math.log1p(t * t / df)
    w = math.sqrt(w2)
    return w + w * (w2 + 3) / b - w * (4 * w2**3 + 33 * w2**2 + 240 * w2 + 855) / (10 * b * (b + 0.8 * w2**2 + 100))


def t_two_sided_p(t: float | None, df: float | None) -> float | None:
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom."""
    if t is None or df is None or math.isnan(t) or math.isnan(df) or df <= 0:
        return None
    if math.isinf(t):
        return 0.0
    if math.isinf(df):
        return math.erfc(abs(t) / math.sqrt(2))
    if df >= LARGE:
        return math.erfc(_t_large(t, df) / math.sqrt(2))
    whole = df + t * t
    return min(1.0, betainc_reg(df / 2.0, 0.5, df / whole, t * t / whole))


def chi2_upper_p(stat: float | None, df: float | None) -> float | None:
    """P(X >= stat) for chi-square with ``df`` degrees of freedom."""
    if stat is None or df is None or math.isnan(stat) or math.isnan(df) or df <= 0:
        return None
    return gammainc_upper_reg(df / 2.0, stat / 2.0)


def _none(v) -> float | None:
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else float(v)


@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided_p(_none(a), _none(b)) for a, b in zip(t, df)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_p_value(stat: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([chi2_upper_p(_none(a), _none(b)) for a, b in zip(stat, df)], dtype="float64")
