"""Closed-form p-values used by the drift tests (no scipy on the box).

Only scalars pass through here; the statistics themselves are computed in
Spark.
"""

from __future__ import annotations

import math


def ks_pvalue(d: float, n1: int, n2: int) -> float:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value:
    ``Q(lambda) = 2 sum_{k>=1} (-1)^(k-1) exp(-2 k^2 lambda^2)`` with
    ``lambda = (sqrt(en) + 0.12 + 0.11 / sqrt(en)) d`` and ``en = n1 n2 / (n1 + n2)``."""
    if n1 == 0 or n2 == 0:
        return float("nan")
    en = math.sqrt(n1 * n2 / (n1 + n2))
    lam = (en + 0.12 + 0.11 / en) * d
    if lam < 1e-3:
        return 1.0
    s, sign = 0.0, 1.0
    for k in range(1, 200):
        term = sign * math.exp(-2.0 * k * k * lam * lam)
        s += term
        if abs(term) < 1e-12:
            break
        sign = -sign
    return max(0.0, min(1.0, 2.0 * s))


def _gammainc_lower_reg(a: float, x: float) -> float:
    """Regularised lower incomplete gamma P(a, x) (series / continued fraction)."""
    if x <= 0:
        return 0.0
    gln = math.lgamma(a)
    if x < a + 1.0:
        ap, s, delta = a, 1.0 / a, 1.0 / a
        for _ in range(1000):
            ap += 1.0
            delta *= x / ap
            s += delta
            if abs(delta) < abs(s) * 1e-15:
                break
        return s * math.exp(-x + a * math.log(x) - gln)
    b = x + 1.0 - a
    c = 1.0 / 1e-300
    d = 1.0 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return 1.0 - math.exp(-x + a * math.log(x) - gln) * h


def chi2_sf(x: float, dof: int) -> float:
    """Survival function of the chi-square distribution."""
    if dof <= 0:
        return float("nan")
    return max(0.0, 1.0 - _gammainc_lower_reg(dof / 2.0, x / 2.0))
