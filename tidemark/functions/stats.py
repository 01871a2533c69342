"""Scalar statistics: test p-values, PSI bands, mergeable moments."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# PSI band limits and the smoothing constant of the PSI shares.
PSI_LOW = 0.10
PSI_HIGH = 0.25
PSI_EPSILON = 1e-8

# Fixed value: number of terms in the asymptotic KS series.
KS_TERMS = 19


def ks_p_value(statistic: Column, n_ref: Column, n_cur: Column) -> Column:
    """Asymptotic p-value of a two-sample KS statistic; 1 if a sample is empty."""
    n1, n2 = n_ref.cast("double"), n_cur.cast("double")
    en = F.sqrt(n1 * n2 / F.nullif(n1 + n2, F.lit(0.0)))
    z = (en + F.lit(0.12) + F.lit(0.11) / F.nullif(en, F.lit(0.0))) * statistic
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * z * z),
    )
    total = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x) * 2.0
    # greatest() and least() skip nulls, so the empty case is kept apart.
    clamped = F.least(F.lit(1.0), F.greatest(F.lit(0.0), total))
    return F.when(total.isNull(), 1.0).otherwise(clamped)


def psi_band(psi: Column) -> Column:
    """LOW / MEDIUM / HIGH, null for a null score."""
    return (
        F.when(psi < PSI_LOW, "LOW")
        .when(psi < PSI_HIGH, "MEDIUM")
        .when(psi.isNotNull(), "HIGH")
    )


def sample_variance(n: Column, total: Column, squares: Column, shift: Column) -> Column:
    """Sample variance from count, sum and sum of squares around ``shift``.

    Null below two values. With a shift near the mean the subtraction loses no
    digits that matter.
    """
    gap = total / F.nullif(n.cast("double"), F.lit(0.0)) - shift
    spread = F.greatest(squares - n * gap * gap, F.lit(0.0))
    return F.when(n > 1, spread / (n - 1))


def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0.0:
        return 1.0
    log_front = a * math.log(x) - x - math.lgamma(a)
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1.0
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * math.exp(log_front))
    # Continued fraction by Lentz's method.
    tiny = 1e-300
    b = x + 1.0 - a
    c, d = 1.0 / tiny, 1.0 / b
    h = d
    for i in range(1, 100_000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return math.exp(log_front) * h if log_front > -745 else 0.0


@F.pandas_udf(T.DoubleType())
def chi_squared_p_value(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper tail of the chi-squared distribution. Called on one row per feature."""
    return pd.Series(
        [
            None if pd.isna(s) or pd.isna(k) else (1.0 if k <= 0 else _upper_gamma(k / 2.0, s / 2.0))
            for s, k in zip(statistic, dof)
        ],
        dtype="float64",
    )


@F.pandas_udf(T.DoubleType())
def ks_exact_p_value(statistic: pd.Series, n0: pd.Series, n1: pd.Series) -> pd.Series:
    """Exact p-value of the two-sample KS statistic, null without sizes.

    Every order of the pooled values is a path over a lattice of ``n0`` by ``n1`` steps; the
    p-value is the share of paths on which the two distribution functions come ``statistic``
    apart or more. Paths that stay closer are counted row by row, as shares, so that no number
    grows; one such row is a running sum over the places that are close enough. One row per test,
    not per value: a test of 10,000 by 10,000 values takes a second.
    """
    return pd.Series([_share_of_paths(d, n, m) for d, n, m in zip(statistic, n0, n1)], dtype="float64")


def _share_of_paths(d: float, n: float, m: float) -> float | None:
    if pd.isna(d) or pd.isna(n) or pd.isna(m):
        return None
    n, m = int(n), int(m)
    if n == 0 or m == 0:
        return 1.0
    apart = round(d * n * m)  # the statistic in steps of 1 / (n * m)
    place = np.arange(m + 1)
    inside = (place * n < apart).astype(float)
    for i in range(1, n + 1):
        near = np.abs(i * m - place * n) < apart
        inside = np.where(near, np.cumsum(np.where(near, inside, 0.0)) * (i / (i + m)), 0.0)
    return float(min(1.0, max(0.0, 1.0 - inside[m])))
