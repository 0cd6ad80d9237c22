"""Tail probabilities of t, F and the studentized range, for a handful of result rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_inc(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            total *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * total


def t_two_sided(t: float, df: float) -> float:
    return beta_inc(df / 2, 0.5, df / (df + t * t))


def f_upper(f: float, df1: float, df2: float) -> float:
    return 1.0 if f <= 0 else beta_inc(df2 / 2, df1 / 2, df2 / (df2 + df1 * f))


_ERF = np.vectorize(math.erf)


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + _ERF(x / math.sqrt(2.0)))


def studentized_range_upper(q: float, k: float, df: float) -> float:
    """P(range of k means / s > q), by quadrature over the normal and the chi densities."""
    if q <= 0:
        return 1.0
    z, wz = np.polynomial.legendre.leggauss(96)
    z, wz = 8.0 * z, 8.0 * wz
    phi = np.exp(-z * z / 2) / math.sqrt(2 * math.pi)

    def range_cdf(w: np.ndarray) -> np.ndarray:
        inner = _normal_cdf(z)[None, :] - _normal_cdf(z[None, :] - w[:, None])
        return k * ((phi * wz)[None, :] * inner ** (k - 1)).sum(axis=1)

    half = 8.0 / math.sqrt(2.0 * df)
    lo, hi = max(0.0, 1.0 - half), 1.0 + half
    s, ws = np.polynomial.legendre.leggauss(96)
    s, ws = lo + (hi - lo) * (s + 1) / 2, ws * (hi - lo) / 2
    log_density = (
        math.log(2.0) + (df / 2) * math.log(df / 2) - math.lgamma(df / 2) + (df - 1) * np.log(np.maximum(s, 1e-300)) - df * s * s / 2)
    return float(min(1.0, max(0.0, 1.0 - (np.exp(log_density) * ws * range_cdf(q * s)).sum())))


def _over_rows(fn):
    def apply(*cols: pd.Series) -> pd.Series:
        frame = pd.concat(cols, axis=1)
        return pd.Series([float("nan") if r.isna().any() else fn(*r) for _, r in frame.iterrows()], dtype="float64")

    return apply


_t_rows, _f_rows, _q_rows = _over_rows(t_two_sided), _over_rows(f_upper), _over_rows(studentized_range_upper)


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    return _t_rows(t, df)


@F.pandas_udf(T.DoubleType())
def f_pvalue(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return _f_rows(f, df1, df2)


@F.pandas_udf(T.DoubleType())
def range_pvalue(q: pd.Series, k: pd.Series, df: pd.Series) -> pd.Series:
    return _q_rows(q, k, df)


@F.pandas_udf(T.DoubleType())
def normal_upper(z: pd.Series) -> pd.Series:
    """P(a normal number > z)."""
    return pd.Series([None if v is None or v != v else 0.5 * math.erfc(v / math.sqrt(2.0)) for v in z])


# Rational approximations of the normal quantile (Wichura 1988, algorithm AS 241; fixed values): numerator and denominator
# in rising powers, for the middle, for the tails and for the far tails.
QUANTILE_MIDDLE = (
    (3.3871328727963666080, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3))
QUANTILE_TAIL = (
    (1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
     1.27045825245236838258, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187, 1.67638483018380384940, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9))
QUANTILE_FAR = (
    (6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15))


def polynomial(x, factors):
    """factors[0] + factors[1] x + ..., of columns or numbers."""
    out = factors[-1]
    for f in reversed(factors[:-1]):
        out = out * x + f
    return out


def normal_quantile(p: Column) -> Column:
    """The number below which a normal number falls with probability p (inside 0 to 1); inside code generation, no Python."""
    q = p - 0.5
    root = F.sqrt(-F.log(F.least(p, 1 - p)))
    ratio = lambda x, of: polynomial(x, [F.lit(v) for v in of[0]]) / polynomial(x, [F.lit(v) for v in of[1]])
    tail = F.when(root <= 5.0, ratio(root - 1.6, QUANTILE_TAIL)).otherwise(ratio(root - 5.0, QUANTILE_FAR))
    return F.when(F.abs(q) <= 0.425, q * ratio(0.180625 - q * q, QUANTILE_MIDDLE)).otherwise(F.signum(q) * tail)
