"""Normal and Student-t functions on columns; only ever applied to aggregated rows."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Coefficients of the published double-precision rational approximation
# of the normal tail (Hart 1968, in the form given by West 2005), highest power first.
TAIL_TOP = [
    3.52624965998911e-02,
    0.700383064443688,
    6.37396220353165,
    33.912866078383,
    112.079291497871,
    221.213596169931,
    220.206867912376,
]
TAIL_BOTTOM = [
    8.83883476483184e-02,
    1.75566716318264,
    16.064177579207,
    86.7807322029461,
    296.564248779674,
    637.333633378831,
    793.826512519948,
    440.413735824752,
]


def z_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def _polynomial(x: Column, coefficients: list[float]) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def norm_cdf(z: Column) -> Column:
    """Standard normal distribution function as a JVM-side expression."""
    a = F.abs(z)
    density = F.exp(-a * a / 2)
    near = density * _polynomial(a, TAIL_TOP) / _polynomial(a, TAIL_BOTTOM)
    fraction = a + 0.65
    for k in (4, 3, 2, 1):
        fraction = a + F.lit(float(k)) / fraction
    far = density / fraction / F.lit(2.506628274631)
    tail = F.when(a > 37, F.lit(0.0)).when(a < 7.07106781186547, near).otherwise(far)
    return F.when(z > 0, 1 - tail).otherwise(tail)


def norm_two_sided(z: Column) -> Column:
    return 2 * norm_cdf(-F.abs(z))


def norm_log_density(x: Column, mean, std) -> Column:
    """Log of the normal density; sums of these never underflow."""
    mean, std = _lit(mean), _lit(std)
    return -F.pow((x - mean) / std, F.lit(2.0)) / 2 - F.ln(std) - F.lit(0.9189385332046727)


def _lit(v):
    return v if isinstance(v, Column) else F.lit(float(v))


def _log_beta(a, b):
    """log B(a, b); for a large argument from the ratio of its gamma functions, where logs would cancel."""
    small, big = np.minimum(a, b), np.maximum(a, b)
    large = np.maximum(big, 10.0)
    growth = (large + small - 0.5) * np.log1p(small / large) + small * np.log(large) - small
    ratio = growth + _stirling(large + small) - _stirling(large)
    plain = _log_gamma(big) + _log_gamma(small) - _log_gamma(big + small)
    return np.where(big >= 10, _log_gamma(small) - ratio, plain)


def _stirling(x):
    inv = 1 / x
    return inv / 12 - inv**3 / 360 + inv**5 / 1260 - inv**7 / 1680


def _log_gamma(x):
    """Stirling series after shifting the argument above 10."""
    x = np.asarray(x, dtype=float).copy()
    shift = np.zeros_like(x)
    for _ in range(10):
        small = x < 10
        shift = np.where(small, shift + np.log(np.where(small, x, 1.0)), shift)
        x = np.where(small, x + 1, x)
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + _stirling(x) - shift


def _beta_fraction(a, b, x, steps=300):
    """Continued fraction of the incomplete beta function, evaluated bottom up."""
    value = np.ones_like(x)
    for m in range(steps, 0, -1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        value = 1 + even / (1 + odd / value)
    return 1 / (1 - (a + b) * x / (a + 1) / value)


def incomplete_beta(a, b, x, rest=None):
    """Regularised incomplete beta function for numpy arrays; ``rest`` is 1 - x, if known more exactly."""
    a, b, x, rest = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, x, 1 - np.asarray(x, dtype=float) if rest is None else rest)))
    x, rest = np.clip(x, 0.0, 1.0), np.clip(rest, 0.0, 1.0)
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, rest, x)
    z = np.where(swap, x, rest)
    with np.errstate(all="ignore"):
        front = np.exp(p * np.log(y) + q * np.where(y < 0.5, np.log1p(-y), np.log(z)) - _log_beta(p, q)) / p
        part = np.where(y <= 0, 0.0, front * _beta_fraction(p, q, y))
    return np.where(swap, 1 - part, part)


def beta_table(a: float, b: float, grid: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Points in [0, 1] and the distribution function of Beta(``a``, ``b``) there."""
    # more points where the mass lies, and down to the ends for shapes below 1
    spread = np.sqrt(a * b / (a + b + 1)) / (a + b)
    points = np.concatenate([np.linspace(0, 1, grid), a / (a + b) + spread * np.linspace(-9, 9, grid)])
    x = np.unique(np.clip(points, 0, 1))
    return x, incomplete_beta(a, b, x)


def beta_bracket(table: tuple[np.ndarray, np.ndarray], p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring points of a table of the distribution function that enclose the quantile of each ``p``."""
    x, reached = table
    at = np.clip(np.searchsorted(reached, p, side="right"), 1, len(x) - 1)
    return x[at - 1], x[at]


def beta_quantile(a: float, b: float, p: np.ndarray, grid: int = 2048, table: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Where the distribution function of Beta(``a``, ``b``) reaches each of ``p``.

    A table of the function brackets each root; Newton's steps that stay inside the bracket,
    and halvings where they don't, end it.
    """
    p = np.asarray(p, dtype=float)
    low, high = beta_bracket(table or beta_table(a, b, grid), p)
    root, log_beta = (low + high) / 2, _log_beta(np.float64(a), np.float64(b))
    for _ in range(60):
        off = incomplete_beta(a, b, root) - p
        low, high = np.where(off < 0, root, low), np.where(off < 0, high, root)
        with np.errstate(all="ignore"):
            step = root - off / np.exp((a - 1) * np.log(root) + (b - 1) * np.log1p(-root) - log_beta)
        new = np.where((step > low) & (step < high), step, (low + high) / 2)
        moved, root = np.abs(new - root).max(initial=0.0), new
        if moved < 1e-15:
            break
    return np.where(p <= 0, 0.0, np.where(p >= 1, 1.0, root))


def student_two_sided(t, dof):
    """Two-sided p-values for numpy arrays of t statistics and degrees of freedom."""
    t, dof = np.broadcast_arrays(np.asarray(t, dtype=float), np.asarray(dof, dtype=float))
    with np.errstate(all="ignore"):
        # close to the normal law: its first term in 1 / dof leaves an error far below 1e-9
        near = (dof > 1e7) & (t**4 < 1e-4 * dof)
    normal = np.vectorize(math.erfc, otypes=[float])(np.abs(t) / math.sqrt(2))
    density = np.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    corrected = normal + density * np.abs(t) * (t * t + 1) / (2 * np.where(near, dof, 1.0))
    return np.where(near, corrected, _student_by_beta(t, dof))


def _student_by_beta(t, dof):
    return incomplete_beta(dof / 2, 0.5, dof / (dof + t * t), t * t / (dof + t * t))


@F.pandas_udf(T.DoubleType())
def t_two_sided(t: pd.Series, dof: pd.Series) -> pd.Series:
    """Two-sided Student-t p-value; applied to one row per test."""
    return pd.Series(student_two_sided(t.to_numpy(), dof.to_numpy())).where(t.notna() & dof.notna(), None)


@F.pandas_udf(T.DoubleType())
def t_quantile(p: pd.Series, dof: pd.Series) -> pd.Series:
    """Student-t quantile by bisection; applied to one row per test."""
    p_, dof_ = p.to_numpy(dtype=float), dof.to_numpy(dtype=float)
    lo, hi = np.zeros_like(p_), np.ones_like(p_)
    want = 2 * np.minimum(p_, 1 - p_)
    for _ in range(500):  # until the quantile is below, as far as numbers go
        short = student_two_sided(hi, dof_) > want
        if not short.any():
            break
        hi = np.where(short, hi * 4, hi)
    for _ in range(200):
        mid = (lo + hi) / 2
        above = student_two_sided(mid, dof_) > want
        lo, hi = np.where(above, mid, lo), np.where(above, hi, mid)
    return pd.Series(np.where(p_ < 0.5, -lo, lo))
