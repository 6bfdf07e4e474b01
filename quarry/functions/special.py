"""Special functions as native columns: p-values and quantiles without a UDF.

Gamma, incomplete beta and incomplete gamma functions are series and continued
fractions folded by the higher-order ``aggregate``, so they run in the JVM on the
small tables that hold test statistics (one row per test). NULL arguments and
arguments outside the domain give NULL, never an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: Lanczos coefficients of ln Gamma for g = 7
LANCZOS_G = 7.0
LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)
# fixed values: rational approximation of the normal tail (Hart 1968, no. 5666), highest power first
TAIL_TOP = (0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871,
            221.213596169931, 220.206867912376)
TAIL_BOTTOM = (0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674,
               637.333633378831, 793.826512519948, 440.413735824752)

BETA_STEPS = 600  # coefficients of the continued fraction; about 10 sqrt(max(a, b)) are needed
TINY, HUGE = 1e-300, 1e300


def _double(c: Column | str | float) -> Column:
    if isinstance(c, (int, float)):
        return F.lit(float(c))
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def let(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """``body`` of a struct of values, each worked out once."""
    bound = F.array(F.struct(*[v.alias(k) for k, v in values.items()]))
    return F.element_at(F.transform(bound, body), 1)


def _inverse(c: Column) -> Column:
    return F.coalesce(F.try_divide(F.lit(1.0), c), F.lit(HUGE))


def _horner(x: Column, coefficients: tuple[float, ...]) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def ln_gamma(x: Column | str | float) -> Column:
    """ln Gamma(x) for x > 0."""
    z = _double(x) - 1.0
    series = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        series = series + F.lit(c) / (z + float(i))
    t = z + (LANCZOS_G + 0.5)
    value = 0.5 * math.log(2 * math.pi) + (z + 0.5) * F.ln(t) - t + F.ln(series)
    return F.when(_double(x) > 0, value)


def normal_cdf(x: Column | str | float) -> Column:
    """P(Z <= x) of the standard normal."""
    x = _double(x)
    a = F.abs(x)
    density = F.exp(-a * a / 2.0)
    far = a + 0.65
    for k in (4.0, 3.0, 2.0, 1.0):
        far = a + F.lit(k) / far
    tail = F.when(a < 7.07106781186547, density * _horner(a, TAIL_TOP) / _horner(a, TAIL_BOTTOM)).otherwise(
        density / far / math.sqrt(2 * math.pi))
    return F.when(x > 0, 1.0 - tail).otherwise(tail)


def _beta_fraction(v: Column, a: str, b: str, x: str) -> Column:
    """The continued fraction of I_x(a, b) by the modified Lentz method; ``v`` holds a, b, x."""
    a, b, x = v[a], v[b], v[x]

    def coefficient(j: Column) -> Column:  # j = 1, 2, ...: odd and even terms take turns
        m = F.floor(j / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return F.when(j % 2 == 0, even).otherwise(odd)

    def step(s: Column, j: Column) -> Column:
        c = 1.0 + s["t"] * _inverse(s["c"])
        d = _inverse(1.0 + s["t"] * s["d"])
        return F.struct(coefficient(j + 1).alias("t"), c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    start = F.struct(coefficient(F.lit(1)).alias("t"), F.lit(1.0).alias("c"), F.lit(0.0).alias("d"), F.lit(1.0).alias("h"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(BETA_STEPS)), start, step, lambda s: _inverse(s["h"]))


def beta_inc(a: Column, b: Column, x: Column) -> Column:
    """Regularised incomplete beta I_x(a, b), a, b > 0; 0 and 1 outside (0, 1)."""
    def body(v: Column) -> Column:
        front = F.exp(ln_gamma(v["a"] + v["b"]) - ln_gamma(v["a"]) - ln_gamma(v["b"])
                      + v["a"] * F.ln(v["x"]) + v["b"] * F.ln(v["y"]))
        low = front * _beta_fraction(v, "a", "b", "x") / v["a"]
        high = 1.0 - front * _beta_fraction(v, "b", "a", "y") / v["b"]
        inside = F.when(v["x"] < (v["a"] + 1.0) / (v["a"] + v["b"] + 2.0), low).otherwise(high)
        return F.when((v["a"] > 0) & (v["b"] > 0), F.when(v["x"] <= 0, 0.0).when(v["y"] <= 0, 1.0).when(v["x"].isNotNull(), inside))

    x = _double(x)
    return let({"a": _double(a), "b": _double(b), "x": x, "y": 1.0 - x}, body)


def t_two_sided(t: Column | str, df: Column | str) -> Column:
    """P(|T| >= |t|) of Student's t with ``df`` degrees of freedom."""
    t, df = _double(t), _double(df)
    return beta_inc(df / 2.0, F.lit(0.5), F.try_divide(df, df + t * t))


def f_upper(f: Column | str, d1: Column | str, d2: Column | str) -> Column:
    """P(F >= f) with (d1, d2) degrees of freedom."""
    f, d1, d2 = _double(f), _double(d1), _double(d2)
    return F.when(f <= 0, F.when(d1.isNotNull() & d2.isNotNull(), 1.0)).otherwise(beta_inc(d2 / 2.0, d1 / 2.0, F.try_divide(d2, d2 + d1 * f)))


def gamma_p(s: Column | str | float, x: Column | str | float) -> Column:
    """Regularised lower incomplete gamma P(s, x), s > 0.

    A series below s + 1, a continued fraction above, both with about
    15 sqrt(s) terms; further than 40 deviations from the mean the value is 0 or 1.
    """
    def body(v: Column) -> Column:
        s, x = v["s"], v["x"]
        terms = F.sequence(F.lit(1), F.ceil(60.0 + 15.0 * F.sqrt(s)).cast("int"))
        front = F.exp(s * F.ln(x) - x - ln_gamma(s))

        def series(acc: Column, n: Column) -> Column:
            term = acc["term"] * x / (s + n)
            return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

        first = F.struct((1.0 / s).alias("term"), (1.0 / s).alias("sum"))
        low = front * F.aggregate(terms, first, series, lambda acc: acc["sum"])

        def fraction(acc: Column, n: Column) -> Column:
            an, b = -n * (n - s), x + 1.0 - s + 2.0 * n
            d = _inverse(an * acc["d"] + b)
            c = b + an * _inverse(acc["c"])
            return F.struct(c.alias("c"), d.alias("d"), (acc["h"] * c * d).alias("h"))

        begin = _inverse(x + 1.0 - s)
        start = F.struct(F.lit(HUGE).alias("c"), begin.alias("d"), begin.alias("h"))
        high = 1.0 - front * F.aggregate(terms, start, fraction, lambda acc: acc["h"])
        reach = 40.0 * F.sqrt(s) + 800.0
        return F.when(s > 0, F.when(x <= 0, 0.0).when(x < s - reach, 0.0).when(x > s + reach, 1.0)
                      .when(x < s + 1.0, low).when(x.isNotNull(), high))

    return let({"s": _double(s), "x": _double(x)}, body)


def poisson_cdf(k: Column, mean: Column) -> Column:
    """P(X <= k) for Poisson(mean); k below 0 gives 0, a mean of 0 gives 1."""
    k, mean = F.floor(_double(k)), _double(mean)
    return F.when(k < 0, 0.0).when(mean <= 0, 1.0).otherwise(1.0 - gamma_p(k + 1.0, mean))


def chi2_quantile(p: float, df: Column | str) -> Column:
    """The p-quantile of chi-square: Newton steps on ln x from the Wilson-Hilferty value."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf(p)
    k = _double(df)
    cube = 1.0 - 2.0 / (9.0 * k) + z * F.sqrt(2.0 / (9.0 * k))
    small = 2.0 * F.exp((math.log(p) + ln_gamma(k / 2.0 + 1.0)) * 2.0 / k)  # where the density rises from 0
    start = F.when(cube > 0.2, k * cube * cube * cube).otherwise(F.least(small, k))

    def body(v: Column) -> Column:
        half = v["k"] / 2.0

        def step(x: Column, _: Column) -> Column:
            slope = F.exp(half * F.ln(x / 2.0) - x / 2.0 - ln_gamma(half))  # x times the density
            move = F.try_divide(gamma_p(half, x / 2.0) - p, slope)
            return x * F.exp(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -move)))

        return F.aggregate(F.sequence(F.lit(1), F.lit(12)), v["start"], step)

    return F.when(k > 0, let({"k": k, "start": start}, body))


# ---- studentised range ------------------------------------------------------------------------

Z_NODES, Z_STEP = 81, 0.2  # normal nodes -8 .. 8
S_NODES = 240


def _s_range(df: Column) -> tuple[Column, Column]:
    """Where ln(s) of the scale s = sqrt(chi2 / df) has its mass."""
    spread = 10.0 / F.sqrt(2.0 * df)
    return -(40.0 / df + spread), 0.5 * F.ln(1.0 + 100.0 / df) + spread


def range_node(q: Column, k: Column, df: Column, i: Column, j: Column) -> Column:
    """What node (i, j) adds to P(range / scale <= q) of k normals: trapezoids in z and in ln(s)."""
    z = Z_STEP * i - Z_STEP * (Z_NODES - 1) / 2
    low, high = _s_range(df)
    step = (high - low) / float(S_NODES - 1)
    u = low + step * j
    s = F.exp(u)
    scale = F.exp(df / 2.0 * F.ln(df / 2.0) - ln_gamma(df / 2.0) + math.log(2.0) + df * u - df * s * s / 2.0)
    inner = k * F.exp(-z * z / 2.0) / math.sqrt(2 * math.pi) * F.pow(
        F.greatest(normal_cdf(z) - normal_cdf(z - q * s), F.lit(0.0)), k - 1.0)
    return scale * inner * step * Z_STEP


def range_cdf(q: Column, k: Column, df: Column) -> Column:
    """P(studentised range <= q) inside one row (for few rows; see ``stats.tukey_hsd`` for many)."""
    nodes = F.sequence(F.lit(0), F.lit(Z_NODES * S_NODES - 1))
    return F.aggregate(nodes, F.lit(0.0), lambda acc, n: acc + range_node(
        q, k, df, F.floor(n / S_NODES).cast("double"), (n % S_NODES).cast("double")))


def range_quantile(p: float, k: Column, df: Column, top: float = 256.0, steps: int = 46) -> Column:
    """The p-quantile of the studentised range by bisection on [0, ``top``]."""
    def halve(s: Column, _: Column) -> Column:
        below = range_cdf(s["at"], s["k"], s["df"]) < p
        return F.struct(F.when(below, s["at"] + s["width"] / 2.0).otherwise(s["at"] - s["width"] / 2.0).alias("at"),
                        (s["width"] / 2.0).alias("width"), s["k"].alias("k"), s["df"].alias("df"))

    k, df = _double(k), _double(df)
    start = F.struct(F.lit(top / 2).alias("at"), F.lit(top / 2).alias("width"), k.alias("k"), df.alias("df"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda s: s["at"])
    return F.when((df > 0) & (k > 1), found)
