"""Scalar distribution functions for p-values and critical values.

They are evaluated on small result tables only (one row per test, per pair
of groups, per grid point), through a pandas UDF, never per data row.
Standard numerical methods: continued fraction for the regularised
incomplete beta, series / continued fraction for the regularised gamma,
bisection for inverses, quadrature for the studentised range.
"""

from __future__ import annotations

import math

import numpy as np


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def _invert(cdf, p: float, lo: float, hi: float, iters: int = 200) -> float:
    for _ in range(iters):
        mid = 0.5 * (lo + hi)
        if cdf(mid) < p:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)


def normal_ppf(p: float) -> float:
    return _invert(normal_cdf, p, -40.0, 40.0)


def _betacf(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def t_sf_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom."""
    if t is None or df is None or math.isnan(t) or math.isnan(df) or df <= 0:
        return float("nan")
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    """P(F >= f) for the F distribution."""
    if f is None or math.isnan(f) or f <= 0:
        return 1.0 if f is not None and not math.isnan(f) else float("nan")
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def gammainc(a: float, x: float) -> float:
    """Regularised lower incomplete gamma P(a, x)."""
    if x <= 0:
        return 0.0
    gln = math.lgamma(a)
    if x < a + 1.0:
        ap, s, d = a, 1.0 / a, 1.0 / a
        for _ in range(100000):
            ap += 1.0
            d *= x / ap
            s += d
            if abs(d) < abs(s) * 1e-16:
                break
        return s * math.exp(-x + a * math.log(x) - gln)
    tiny = 1e-300
    b = x + 1.0 - a
    c, d = 1.0 / tiny, 1.0 / b
    h = d
    for i in range(1, 100000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-16:
            break
    return 1.0 - math.exp(-x + a * math.log(x) - gln) * h


def chi2_cdf(x: float, k: float) -> float:
    return gammainc(k / 2.0, x / 2.0)


def chi2_ppf(p: float, k: float) -> float:
    return _invert(lambda v: chi2_cdf(v, k), p, 0.0, max(10.0, k * 10.0 + 100.0))


def poisson_cdf(x: float, lam: float) -> float:
    if x < 0:
        return 0.0
    return 1.0 - gammainc(math.floor(x) + 1.0, lam)


def ptukey(q: float, k: int, df: float, nz: int = 241, ns: int = 241) -> float:
    """CDF of the studentised range of ``k`` means with ``df`` error degrees of freedom.

    P(Q <= q) = integral f_s(s) * k * integral phi(z) [Phi(z) - Phi(z - q s)]^(k-1) dz ds,
    s ~ sqrt(chi2_df / df); both integrals by the trapezoid rule on fine grids.
    """
    if q <= 0:
        return 0.0
    from math import erf

    z = np.linspace(-8.0, 8.0, nz)
    phi = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
    vPhi = np.vectorize(lambda v: 0.5 * (1.0 + erf(v / math.sqrt(2.0))))
    Pz = vPhi(z)

    def inner(w: float) -> float:
        diff = np.clip(Pz - vPhi(z - w), 0.0, 1.0)
        return float(k * np.trapezoid(phi * diff ** (k - 1), z))

    if df is None or math.isinf(df) or df > 5000:
        return min(1.0, inner(q))
    spread = 8.0 / math.sqrt(2.0 * df)
    s = np.linspace(max(1e-6, 1.0 - spread * 1.5), 1.0 + spread * 1.5, ns)
    logf = (df / 2.0) * math.log(df / 2.0) - math.lgamma(df / 2.0) + math.log(2.0) + (df - 1) * np.log(s) \
        - df * s * s / 2.0
    f = np.exp(logf - logf.max())
    f /= np.trapezoid(f, s)
    vals = np.array([inner(q * si) for si in s])
    return float(min(1.0, np.trapezoid(f * vals, s)))
