"""Student's t distribution, for summary rows."""

from __future__ import annotations

from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _beta_fraction(a: np.ndarray, b: float, x: np.ndarray, steps: int = 300) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, steps):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + term * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + term / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
    return h


def t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| >= |t|) for T with ``df`` degrees of freedom; NaN where either is NaN or df <= 0."""
    t, df = np.asarray(t, float), np.asarray(df, float)
    out = np.full(t.shape, np.nan)
    ok = np.isfinite(df) & (df > 0) & ~np.isnan(t)
    a, b = df[ok] / 2, 0.5
    x = np.where(np.isinf(t[ok]), 0.0, df[ok] / (df[ok] + np.where(np.isinf(t[ok]), 0, t[ok]) ** 2))
    near_one = x > (a + 1) / (a + b + 2)
    front = np.array([lgamma(v + b) - lgamma(v) - lgamma(b) for v in a])
    with np.errstate(divide="ignore", invalid="ignore"):
        weight = np.exp(front + a * np.log(x) + b * np.log1p(-x))
    direct = weight * _beta_fraction(a, b, np.where(near_one, 0.0, x)) / a
    mirrored = 1 - weight * np.array([_mirror(v, b, 1 - y) if near else 0.0 for v, y, near in zip(a, x, near_one)]) / b
    p = np.where(near_one, mirrored, direct)
    out[ok] = np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, p)).clip(0, 1)
    return out


def _mirror(a: float, b: float, y: float) -> float:
    """Fraction of the mirrored integral I(1 - x; b, a)."""
    return float(_beta_fraction(np.array([b]), a, np.array([y]))[0])


@F.pandas_udf(DoubleType())
def _p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_two_sided(t.to_numpy(float), df.to_numpy(float)))


def t_pvalue(t: Column, df: Column) -> Column:
    """Two-sided p-value of a t statistic; for tables of summary rows."""
    return F.nanvl(_p(t.cast("double"), df.cast("double")), F.lit(None).cast("double"))
