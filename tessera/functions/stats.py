"""Student-t probabilities for prediction intervals, evaluated on the driver (no data).

With ``t = sqrt(n) * tan(a)`` the probability of ``|T| <= t`` is the integral of
``cos(x) ** (n - 1)`` from 0 to ``a``, over its integral up to a right angle. The
integrand is smooth on ``[0, a]``, so Gauss-Legendre nodes give it to rounding.
"""

from __future__ import annotations

import math

import numpy as np

NODES, WEIGHTS = np.polynomial.legendre.leggauss(120)
#: Beyond this many degrees of freedom the gamma ratio is taken from its series.
SERIES_FROM = 1e4


def _gamma_ratio(df: float) -> float:
    """``gamma((df + 1) / 2) / gamma(df / 2)``."""
    if df < SERIES_FROM:
        return math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2))
    return math.sqrt(df / 2) * (1 - 1 / (4 * df) + 1 / (32 * df**2) + 5 / (128 * df**3))


def _within(angle: float, df: float) -> float:
    """Probability of ``|T| <= sqrt(df) * tan(angle)``."""
    x = 0.5 * angle * (NODES + 1)
    # log(cos) by the sine: exact for the tiny angles of many degrees of freedom
    area = 0.5 * angle * float(WEIGHTS @ np.exp(0.5 * (df - 1) * np.log1p(-np.sin(x) ** 2)))
    return min(1.0, 2 / math.sqrt(math.pi) * _gamma_ratio(df) * area)


def t_cdf(t: float, df: float) -> float:
    """Student-t cumulative distribution."""
    inside = _within(math.atan(abs(t) / math.sqrt(df)), df)
    return 0.5 * (1 + inside) if t >= 0 else 0.5 * (1 - inside)


def t_quantile(p: float, df: float) -> float:
    """Inverse of :func:`t_cdf`, by bisection of the angle."""
    if not 0.0 < p < 1.0:
        raise ValueError("p must be in (0, 1)")
    if df <= 0:
        return float("nan")
    inside = abs(2 * p - 1)
    # a tail beyond 40 standard deviations needs few degrees of freedom: start there
    lo, hi = 0.0, math.pi / 2 if df < 100 else math.atan(40 / math.sqrt(df))
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if mid in (lo, hi):
            break
        lo, hi = (mid, hi) if _within(mid, df) < inside else (lo, mid)
    t = math.sqrt(df) * math.tan(0.5 * (lo + hi))
    return t if p >= 0.5 else -t
