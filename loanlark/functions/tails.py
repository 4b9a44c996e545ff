"""Tail probabilities of the two test statistics."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KS_TERMS = 100


def ks_p_value(d: Column, n0: Column, n1: Column) -> Column:
    """Asymptotic two-sample Kolmogorov tail with the finite-sample correction of lambda."""
    n = n0.cast("double") * n1 / (n0 + n1)
    lam = (F.sqrt(n) + 0.12 + F.lit(0.11) / F.sqrt(n)) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    # below 0.2 the tail is 1 to double precision and the alternating series is not summable
    return F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def _chi2_tail(x: float, dof: int) -> float:
    """Upper incomplete gamma ratio at (dof / 2, x / 2), by whichever expansion converges.

    Below the mean the power series of the lower part is summed, above it the continued
    fraction of the upper part; both stop when a term no longer counts, after a number of
    steps that grows with the root of ``dof``.
    """
    a, h = dof / 2.0, x / 2.0
    if h <= 0:
        return 1.0
    scale = math.exp(a * math.log(h) - h - math.lgamma(a))
    if h < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > total * 1e-17:
            n += 1.0
            term *= h / n
            total += term
        return min(1.0, max(0.0, 1.0 - total * scale))
    tiny = 1e-300
    b = h + 1.0 - a
    c, d = 1.0 / tiny, 1.0 / b
    fraction, i = d, 0
    while True:
        i += 1
        k = -i * (i - a)
        b += 2.0
        d = k * d + b
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = b + k / c
        c = c if abs(c) > tiny else tiny
        fraction *= c * d
        if abs(c * d - 1.0) < 1e-16:
            return min(1.0, fraction * scale)


@F.pandas_udf(T.DoubleType())
def chi2_p_value(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    """Closed-form chi-square tail; runs on the one-row-per-feature result only."""
    return pd.Series([_chi2_tail(float(x), int(k)) for x, k in zip(statistic, dof)])
