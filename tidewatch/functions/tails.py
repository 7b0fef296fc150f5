"""Tail probabilities for the drift tests (t, F, chi-square, two-sample KS).

No scipy in the runtime, so these are written from the published algorithms:
continued fractions for the incomplete beta / gamma functions (modified Lentz),
the Kolmogorov limiting series (and its theta-function form for small
arguments), and lattice-path counting for the exact two-sample KS law.

They run inside an Arrow-batched pandas UDF on the *aggregated* per-feature
table (one row per feature and segment), so their cost does not grow with the
data.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_EPS = 1e-15
_TINY = 1e-300

# largest sample size for which the exact two-sample KS law is used (fixed value:
# the reference's library changes its law there); above it ``ks_large_p`` is
KS_EXACT_MAX_N = 10_000


def _rounds(size: float) -> int:
    """Terms allowed to a fraction or series of this size: they need a few
    times the square root; one that has not settled by then gives NaN."""
    return int(200 + 20 * math.sqrt(max(size, 1.0)))


def _lentz(numerator, denominator, rounds: int) -> float:
    """Continued fraction K(numerator(i) / denominator(i)) from i = 1, by the
    modified Lentz recurrence; NaN when it does not settle."""
    value, c, d = _TINY, _TINY, 0.0
    for i in range(1, rounds + 1):
        a, b = numerator(i), denominator(i)
        d = 1.0 / ((b + a * d) or _TINY)
        c = (b + a / c) or _TINY
        value *= c * d
        if abs(c * d - 1.0) < _EPS:
            return value
    return float("nan")


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The fraction 1 / (1 + d1 / (1 + d2 / (1 + ...))) of the incomplete beta function."""
    def coefficient(i: int) -> float:
        if i == 1:
            return 1.0
        m, odd = divmod(i - 1, 2)
        if odd:  # d_{2m+1}
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))

    return _lentz(coefficient, lambda i: 1.0, _rounds(max(a, b)))


def _lgamma_ratio(a: float, b: float) -> float:
    """ln Gamma(a + b) - ln Gamma(a), stable when a is large (Stirling series
    difference; plain lgamma differences cancel catastrophically)."""
    if a < 1e4:
        return math.lgamma(a + b) - math.lgamma(a)
    c = a + b
    out = (a - 0.5) * math.log1p(b / a) + b * math.log(c) - b
    out += (1.0 / c - 1.0 / a) / 12.0 - (1.0 / c ** 3 - 1.0 / a ** 3) / 360.0
    return out


def _lbeta_norm(a: float, b: float) -> float:
    """ln Gamma(a + b) - ln Gamma(a) - ln Gamma(b)."""
    if a >= b:
        return _lgamma_ratio(a, b) - math.lgamma(b)
    return _lgamma_ratio(b, a) - math.lgamma(a)


def betainc(a: float, b: float, x: float, y: float | None = None, lx: float | None = None,
            ly: float | None = None) -> float:
    """Regularised incomplete beta I_x(a, b); ``y`` = 1 - x and the logs
    ``lx``, ``ly`` may be passed when the caller forms them without
    cancellation (needed for very large a or b)."""
    if not (a > 0 and b > 0) or math.isnan(x):
        return float("nan")
    y = 1.0 - x if y is None else y
    if x <= 0.0:
        return 0.0
    if y <= 0.0:
        return 1.0
    lx = math.log(x) if lx is None else lx
    ly = math.log(y) if ly is None else ly
    lbt = _lbeta_norm(a, b) + a * lx + b * ly
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(lbt) * _beta_fraction(b, a, y) / b


def _minus_log1p(u: float) -> float:
    """u - ln(1 + u), without cancellation for small u."""
    if abs(u) > 0.1:
        return u - math.log1p(u)
    total, power, k = 0.0, u * u, 2
    while True:
        step = power / k if k % 2 == 0 else -power / k
        total += step
        if abs(step) <= 1e-17 * abs(total) or k > 60:
            return total
        power *= u
        k += 1


def _gamma_density(a: float, x: float) -> float:
    """x**a * exp(-x) / Gamma(a), from deviations of x from a when a is large."""
    if a < 100:
        return math.exp(-x + a * math.log(x) - math.lgamma(a))
    stirling = 1 / (12 * a) - 1 / (360 * a**3) + 1 / (1260 * a**5)
    return math.sqrt(a / (2 * math.pi)) * math.exp(-a * _minus_log1p((x - a) / a) - stirling)


def gammaincc(a: float, x: float) -> float:
    """Upper regularised gamma Q(a, x); NaN when no expansion settles."""
    if a <= 0 or math.isnan(x):
        return float("nan")
    if x <= 0:
        return 1.0
    density = _gamma_density(a, x)
    if density == 0.0:
        return 1.0 if x < a else 0.0
    rounds = _rounds(a)
    if x < a + 1.0:  # series for P(a, x)
        term = total = 1.0 / a
        for n in range(1, rounds):
            term *= x / (a + n)
            total += term
            if term < total * _EPS:
                return max(0.0, 1.0 - total * density)
        return float("nan")
    fraction = _lentz(lambda i: 1.0 if i == 1 else (i - 1) * (a - i + 1), lambda i: x - a + 2 * i - 1, rounds)
    return density * fraction


def t_two_sided(t: float, df: float) -> float:
    """Two-sided p of Student t with (possibly fractional) df."""
    if t is None or df is None or math.isnan(t) or math.isnan(df) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    t2 = t * t
    if t2 == 0:
        return 1.0
    r = t2 / df
    if df > 1e6:  # normal deviate of a t deviate; its next terms are below 1e-12 here
        a = df - 0.5
        y = a * math.log1p(r)
        return math.erfc(math.sqrt(y / 2.0) * (1.0 + (y + 3.0) / (48.0 * a * a)))
    return betainc(df / 2.0, 0.5, df / (df + t2), t2 / (df + t2), -math.log1p(r), math.log(r) - math.log1p(r))


def f_upper(f: float, d1: float, d2: float) -> float:
    """Upper tail P(F(d1, d2) > f)."""
    if f is None or math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if math.isinf(f):
        return 0.0
    if f <= 0:
        return 1.0
    if d1 == 1:
        return t_two_sided(math.sqrt(f), d2)
    r = d1 * f / d2
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f), d1 * f / (d2 + d1 * f), -math.log1p(r),
                   math.log(r) - math.log1p(r))


def chi2_upper(x: float, k: float) -> float:
    """Upper tail of chi-square with k degrees of freedom; k=0 gives 1."""
    if x is None or math.isnan(x):
        return float("nan")
    if k <= 0:
        return 1.0
    return gammaincc(k / 2.0, x / 2.0)


def kolmogorov_sf(lam: float) -> float:
    """Limiting Kolmogorov survival function Q(lambda)."""
    if math.isnan(lam):
        return float("nan")
    if lam <= 0:
        return 1.0
    if lam < 1.0:  # theta-function form converges fast for small lambda
        s = 0.0
        for k in range(1, 50):
            s += math.exp(-((2 * k - 1) ** 2) * math.pi ** 2 / (8.0 * lam * lam))
        return min(1.0, max(0.0, 1.0 - math.sqrt(2.0 * math.pi) / lam * s))
    s = 0.0
    for k in range(1, 101):
        term = math.exp(-2.0 * k * k * lam * lam)
        s += term if k % 2 == 1 else -term
        if term < 1e-18:
            break
    return min(1.0, max(0.0, 2.0 * s))


def ks_exact_two_sided(d: float, n1: int, n2: int) -> float:
    """P(D >= d) for the two-sample KS statistic by lattice-path counting.

    A uniformly random monotone path from (0,0) to (n1,n2) is walked along
    anti-diagonals; cells with |i*n2 - j*n1| >= d*n1*n2 are absorbing. The
    surviving probability mass is P(D < d).
    """
    n1, n2 = int(n1), int(n2)
    m = int(round(d * n1 * n2))
    if m <= 0:
        return 1.0
    total = n1 + n2
    # only cells inside the band carry mass: on anti-diagonal s, |i * total - s * n1| < m
    mass, low = np.ones(1), 0  # mass[k]: at cell (low + k, s - low - k)
    for s in range(1, total + 1):
        first = max(0, s - n2, (s * n1 - m) // total + 1)
        last = min(n1, s, -((-s * n1 - m) // total) - 1)
        if last < first:
            return 1.0
        i = np.arange(first, last + 1)
        padded = np.zeros(last - first + 2)  # masses of cells first - 1 .. last
        a, b = max(low, first - 1), min(low + len(mass) - 1, last)
        if a <= b:
            padded[a - first + 1: b - first + 2] = mass[a - low: b - low + 1]
        mass = (padded[:-1] * (n1 - i + 1) + padded[1:] * (n2 - s + i + 1)) / (total - s + 1)
        low = first
    return float(min(1.0, max(0.0, 1.0 - mass[n1 - low])))


def ks_two_sample_p(d: float, n1: int, n2: int, exact_max: int = KS_EXACT_MAX_N) -> float:
    if d is None or math.isnan(d) or n1 <= 0 or n2 <= 0:
        return float("nan")
    if d <= 0:
        return 1.0
    if max(n1, n2) <= exact_max:
        return ks_exact_two_sided(d, n1, n2)
    return ks_large_p(d, n1 * n2 / (n1 + n2))


def ks_large_p(d: float, n: float) -> float:
    """P(D >= d) for a sample of ``n`` (two samples: n1 n2 / (n1 + n2)): the
    limiting law at Vrbik's corrected argument, which agrees with the finite-n
    law up to terms of order n**-1.5."""
    n = max(1, round(n))
    z = math.sqrt(n) * d
    return kolmogorov_sf(z + 1 / (6 * math.sqrt(n)) + (z - 1) / (4 * n))


def tail_prob_scalar(kind: str, stat: float, a: float, b: float) -> float:
    try:
        if stat is None or (isinstance(stat, float) and math.isnan(stat)):
            return float("nan")
        if kind == "t":
            return t_two_sided(float(stat), float(a))
        if kind == "f":
            return f_upper(float(stat), float(a), float(b))
        if kind == "chi2":
            return chi2_upper(float(stat), float(a))
        if kind == "ks":
            return ks_two_sample_p(float(stat), int(a), int(b))
    except (ValueError, OverflowError, ZeroDivisionError):
        return float("nan")
    return float("nan")


@F.pandas_udf(DoubleType())
def _tail_prob_udf(kind: pd.Series, stat: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
    out = [
        tail_prob_scalar(k, s, x, y)
        for k, s, x, y in zip(kind, stat.astype("float64"), a.astype("float64"), b.astype("float64"))
    ]
    return pd.Series(out, dtype="float64")


def tail_prob(kind: str | Column, stat: Column, a: Column, b: Column | None = None) -> Column:
    """Column expression: tail probability of ``stat`` under the ``kind`` law.

    kind in {'t' (a=df), 'f' (a=d1, b=d2), 'chi2' (a=dof), 'ks' (a=n1, b=n2)}.
    Use it only on aggregated (per-feature) frames.
    """
    k = F.lit(kind) if isinstance(kind, str) else kind
    b = F.lit(0.0) if b is None else b
    return _tail_prob_udf(k, stat.cast("double"), a.cast("double"), b.cast("double"))
