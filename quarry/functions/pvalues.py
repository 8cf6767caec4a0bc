"""Upper-tail probabilities of the chi-square, t and F distributions in plain Python.

Applied to a handful of aggregated rows (one per input column), never to raw data.
Regularized incomplete gamma by series / continued fraction; incomplete beta by Lentz's
continued fraction.
"""

from __future__ import annotations

import math

_EPS = 1e-15
_TINY = 1e-300
_MAX_ITER = 10_000


def _gamma_p_series(a: float, x: float) -> float:
    term = total = 1.0 / a
    ap = a
    for _ in range(_MAX_ITER):
        ap += 1.0
        term *= x / ap
        total += term
        if abs(term) < abs(total) * _EPS:
            break
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gamma_q_cf(a: float, x: float) -> float:
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, _MAX_ITER):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = _TINY if abs(d) < _TINY else d
        c = b + an / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def gamma_q(a: float, x: float) -> float:
    """Regularized upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    if x < a + 1.0:
        return 1.0 - _gamma_p_series(a, x)
    return _gamma_q_cf(a, x)


def _beta_cf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = _TINY if abs(d) < _TINY else d
    d = 1.0 / d
    h = d
    for m in range(1, _MAX_ITER):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = _TINY if abs(d) < _TINY else d
        c = 1.0 + aa / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = _TINY if abs(d) < _TINY else d
        c = 1.0 + aa / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    ln_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(ln_front) * _beta_cf(a, b, x) / a
    return 1.0 - math.exp(ln_front) * _beta_cf(b, a, 1.0 - x) / b


def chi2_sf(stat: float, df: float) -> float:
    if stat is None or df is None or df <= 0:
        return float("nan")
    return gamma_q(df / 2.0, stat / 2.0)


def t_two_sided(t: float, df: float) -> float:
    if t is None or df is None or df <= 0 or math.isnan(t):
        return float("nan")
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


def f_sf(f: float, df1: float, df2: float) -> float:
    if f is None or df1 is None or df2 is None or df1 <= 0 or df2 <= 0 or f < 0:
        return float("nan")
    return beta_inc(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * f))


def t_quantile(p: float, df: float) -> float:
    """Quantile of Student's t (p in (0, 1)) by bisection on the two-sided tail."""
    if not 0.0 < p < 1.0 or df <= 0:
        return float("nan")
    if p == 0.5:
        return 0.0
    tail = 2.0 * min(p, 1.0 - p)           # two-sided tail mass beyond |t|
    lo, hi = 0.0, 1.0
    while t_two_sided(hi, df) > tail:
        hi *= 2.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if t_two_sided(mid, df) > tail:
            lo = mid
        else:
            hi = mid
    t = (lo + hi) / 2.0
    return t if p > 0.5 else -t


def beta_quantile(q: float, a: float, b: float) -> float:
    """Inverse of the regularized incomplete beta I_x(a, b) by bisection."""
    if q <= 0:
        return 0.0
    if q >= 1:
        return 1.0
    lo, hi = 0.0, 1.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if beta_inc(a, b, mid) < q:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0


def binom_ci(k: int, n: int, level: float = 0.95) -> tuple[float, float]:
    """Exact (Clopper-Pearson) interval of a binomial proportion."""
    alpha = 1.0 - level
    lo = 0.0 if k == 0 else beta_quantile(alpha / 2, k, n - k + 1)
    hi = 1.0 if k == n else beta_quantile(1 - alpha / 2, k + 1, n - k)
    return lo, hi


def binom_upper_tail(k: int, n: int, p: float) -> float:
    """P(X >= k) for X ~ Binomial(n, p)."""
    if k <= 0:
        return 1.0
    if k > n:
        return 0.0
    return beta_inc(k, n - k + 1, p)
