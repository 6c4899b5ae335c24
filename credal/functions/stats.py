"""Small statistical helpers for per-column summary tables (one row per column).

They run on tables bounded by the number of columns, never on row data.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ks_pvalue(d: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample Kolmogorov–Smirnov p-value:
    Q(λ) = 2 Σ_{k≥1} (−1)^{k−1} exp(−2 k² λ²), λ = (√n_e + 0.12 + 0.11/√n_e)·D,
    n_e = n1·n2 / (n1 + n2) (the classic small-sample-corrected form)."""
    ne = n1.cast("double") * n2 / (n1 + n2)
    lam = (F.sqrt(ne) + F.lit(0.12) + F.lit(0.11) / F.sqrt(ne)) * d
    total = F.lit(0.0)
    for k in range(1, terms + 1):
        total = total + F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * lam * lam)
    return F.when(d <= 0, F.lit(1.0)).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def _gammaincc(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x) (series / continued fraction)."""
    if x <= 0:
        return 1.0
    gln = math.lgamma(a)
    if x < a + 1:
        term = total = 1.0 / a
        ap = a
        for _ in range(1000):
            ap += 1
            term *= x / ap
            total += term
            if abs(term) < abs(total) * 1e-15:
                break
        return max(0.0, 1.0 - total * math.exp(-x + a * math.log(x) - gln))
    b = x + 1 - a
    c = 1.0 / 1e-300
    d = 1.0 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - gln) * h


@F.pandas_udf(T.DoubleType())
def chi2_pvalue(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """χ² survival function P(X ≥ stat) for ``dof`` degrees of freedom."""
    return pd.Series([None if s is None or k is None or k <= 0 or pd.isna(s) else _gammaincc(k / 2.0, s / 2.0)
                      for s, k in zip(stat, dof)], dtype="float64")
