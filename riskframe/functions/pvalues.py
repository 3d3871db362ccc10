"""p-values for summary rows (one row per test, never per base row).

Spark SQL has no erfc or incomplete gamma, so these two are vectorised
pandas UDFs; they run on the handful of rows a test produces.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normal_two_sided(z: float) -> float:
    """2 * P(Z > |z|) = erfc(|z| / sqrt 2), capped at 1."""
    if z is None or (isinstance(z, float) and math.isnan(z)):
        return float("nan")
    return min(1.0, math.erfc(abs(z) / math.sqrt(2.0)))


#: Above, the expansion is exact to better than 1e-7; below, both loops converge in a few thousand steps.
LARGE = 1e5


def _gamma_q_large(a: float, x: float) -> float:
    """Q(a, x) for large a: uniform expansion around x = a, first correction included."""
    m = x / a - 1.0
    half = m - math.log1p(m) if abs(m) > 1e-4 else m * m * (0.5 - m / 3 + m * m / 4)
    eta = math.copysign(math.sqrt(2.0 * half), m)
    first = 1.0 / m - 1.0 / eta if abs(m) > 1e-4 else -1.0 / 3.0 + m / 12.0
    q = 0.5 * math.erfc(eta * math.sqrt(a / 2.0)) + math.exp(-a * half) / math.sqrt(2.0 * math.pi * a) * first
    return min(1.0, max(0.0, q))


def _gamma_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x): series below a + 1,
    Lentz continued fraction above (standard numerical recipe)."""
    if x < 0 or a <= 0:
        return float("nan")
    if x == 0 or math.isinf(a):
        return 1.0
    if math.isinf(x):
        return 0.0
    if a > LARGE:
        return _gamma_q_large(a, x)
    lg = math.lgamma(a)
    if x < a + 1.0:
        term = 1.0 / a
        total = term
        ap = a
        while True:
            ap += 1.0
            term *= x / ap
            total += term
            if abs(term) < abs(total) * 1e-16:
                break
        p = total * math.exp(-x + a * math.log(x) - lg)
        return max(0.0, 1.0 - p)
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in itertools.count(1):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        if abs(d) < tiny:
            d = tiny
        c = b + an / c
        if abs(c) < tiny:
            c = tiny
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - lg) * h


def chi2_sf(x: float, dof: float) -> float:
    """P(X > x) for a chi-square with ``dof`` degrees of freedom."""
    if x is None or dof is None or (isinstance(x, float) and math.isnan(x)) or dof <= 0:
        return float("nan")
    return _gamma_q(dof / 2.0, max(x, 0.0) / 2.0)


@F.pandas_udf(T.DoubleType())
def normal_p_udf(z: pd.Series) -> pd.Series:
    return pd.Series([normal_two_sided(None if pd.isna(v) else float(v)) for v in z], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_p_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    out = [chi2_sf(None if pd.isna(a) else float(a), None if pd.isna(b) else float(b))
           for a, b in zip(x, dof)]
    return pd.Series(np.asarray(out, dtype="float64"))
