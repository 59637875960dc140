"""Two-sided tail of Student's t, vectorised, without SciPy."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function, by Lentz's method."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 300):
        for t in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + t * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + t / np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        if np.all(np.abs(d * c - 1) < 1e-15):
            break
    return h


def regularised_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    a, b, x = np.broadcast_arrays(*(np.asarray(v, float) for v in (a, b, x)))
    gamma = np.vectorize(math.lgamma, otypes=[float])
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        front = np.exp(gamma(a + b) - gamma(a) - gamma(b) + a * np.log(x) + b * np.log1p(-x))
        low = x < (a + 1) / (a + b + 2)
        one = front * _beta_fraction(a, b, np.where(low, x, 0.5)) / a
        two = 1 - front * _beta_fraction(b, a, np.where(low, 0.5, 1 - x)) / b
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, np.where(low, one, two)))


def two_sided(t: np.ndarray, dof: np.ndarray) -> np.ndarray:
    t, dof = np.asarray(t, float), np.asarray(dof, float)
    with np.errstate(over="ignore"):
        x = dof / (dof + t * t)
    return regularised_beta(dof / 2, np.full_like(dof, 0.5), x)


def p_value_udf():
    @F.pandas_udf("double")
    def p_value(t: pd.Series, dof: pd.Series) -> pd.Series:
        out = np.ones(len(t))
        ok = t.notna().to_numpy() & (dof.to_numpy() >= 1)
        if ok.any():
            out[ok] = two_sided(t.to_numpy()[ok], dof.to_numpy()[ok])
        return pd.Series(out)

    return p_value
