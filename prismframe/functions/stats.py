"""Tail probabilities that Spark lacks, as Arrow functions over whole batches, and expressions for the rest."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Chi-squared (one degree of freedom) at p = 0.001, and |z| at p = 0.05: thresholds that need no tail function.
CHI2_001, Z_05 = 10.827566170662733, 1.959963984540054


def _erfc(x: float) -> float:
    return math.nan if x is None or math.isnan(x) else math.erfc(x)


def p_of_z(z: Column) -> Column:
    """Two-sided p of a normal z."""

    @F.pandas_udf("double")
    def tail(v: pd.Series) -> pd.Series:
        return pd.Series([_erfc(abs(x) / math.sqrt(2)) if x == x else None for x in v.astype(float)])

    return tail(z.cast("double"))


def p_of_g2(g2: Column) -> Column:
    return p_of_z(F.sqrt(g2))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised, by Lentz's continued fraction."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, f, c, d = 1e-300, 1.0, 1.0, 0.0
    for i in range(400):
        m = i // 2
        if i == 0:
            step = 1.0
        elif i % 2 == 0:
            step = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            step = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + step * d or tiny)
        c = 1 + step / c or tiny
        f *= c * d
        if abs(1 - c * d) < 1e-14:
            break
    return front * (f - 1.0)


def p_of_r_value(r: float, n: int) -> float | None:
    """Two-sided p of Pearson's r: normal tail from 30 degrees of freedom, exact Student's t below; |r| = 1 gives 0."""
    if n is None or r is None or n < 3 or r != r:
        return None
    if abs(r) >= 1:
        return 0.0
    dof = n - 2
    t = r * math.sqrt(dof / (1 - r * r))
    return math.erfc(abs(t) / math.sqrt(2)) if dof >= 30 else incomplete_beta(dof / 2, 0.5, dof / (dof + t * t))


def p_of_r(r: Column, n: Column) -> Column:
    @F.pandas_udf("double")
    def tail(rs: pd.Series, ns: pd.Series) -> pd.Series:
        return pd.Series([p_of_r_value(x, int(k)) if x == x and k == k else None for x, k in zip(rs.astype(float), ns.astype(float), strict=True)], dtype=object).astype(float)

    return tail(r.cast("double"), n.cast("double"))


def g2(a: Column, b: Column, total_a: Column, total_b: Column) -> Column:
    """Dunning's log-likelihood ratio of the 2x2 table of a term's and the other counts in two corpora."""
    both, n = a + b, total_a + total_b

    def cell(seen: Column, row: Column, column: Column) -> Column:
        return F.when(seen > 0, seen * F.ln(seen * n / (row * column))).otherwise(F.lit(0.0))

    return 2 * (cell(a, both, total_a) + cell(b, both, total_b) + cell(total_a - a, n - both, total_a) + cell(total_b - b, n - both, total_b))


def log_odds(a: Column, b: Column, total_a: Column, total_b: Column, alpha: float = 0.5) -> tuple[Column, Column]:
    """(log odds ratio with a symmetric prior, its z)."""
    odds_a = (a + alpha) / F.greatest(total_a - a, F.lit(1e-9))
    odds_b = (b + alpha) / F.greatest(total_b - b, F.lit(1e-9))
    delta = F.ln(odds_a) - F.ln(odds_b)
    return delta, delta / F.sqrt(1 / (a + alpha) + 1 / (b + alpha))


def bootstrap_interval(values: list[float], weights: list[float], draws: int = 1000, seed: int = 42) -> tuple[float, float]:
    """5th and 95th percentile of the weighted mean over resamples of the units; weights of a resample may sum to 0 (skipped)."""
    v, w, rng, found = np.asarray(values, float), np.asarray(weights, float), np.random.default_rng(seed), []
    for _ in range(draws):
        at = rng.integers(0, len(v), len(v))
        if w[at].sum() > 0:
            found.append(float((v[at] * w[at]).sum() / w[at].sum()))
    return (float(np.percentile(found, 5)), float(np.percentile(found, 95))) if found else (math.nan, math.nan)
