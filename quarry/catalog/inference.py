"""Inference queries whose p-values, quantiles and components have independent DuckDB twins.

The twins integrate densities (double-exponential or Simpson sums) or use closed
forms; none of them repeats the series, fractions and rotations of the operators.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog.registry import query
from quarry.functions.rounding import rnd, rnd_sql as R
from quarry.operators import gram as G
from quarry.operators import stats as X
from quarry.operators.windows import top_contributors
from quarry.session import table


def _upper_integral(density: str, start: str) -> str:
    """The integral of ``density`` (an expression in u) from ``start`` to infinity: u = start + exp(pi/2 sinh(v))."""
    v = "(i * 0.02)"
    grow = f"exp(pi() / 2 * sinh({v}))"
    term = density.replace("@u", f"(({start}) + {grow})")
    return f"list_sum(list_transform(range(-200, 201), lambda i: 0.02 * ({term}) * {grow} * pi() / 2 * cosh({v})))"


def t_p_sql(t: str, df: str) -> str:
    density = f"exp(lgamma(({df} + 1) / 2.0) - lgamma({df} / 2.0) - 0.5 * ln(pi() * {df}) - ({df} + 1) / 2.0 * ln(1 + @u * @u / {df}))"
    return f"2 * {_upper_integral(density, f'abs({t})')}"


def f_p_sql(f: str, a: str, b: str) -> str:
    density = (f"exp({a} / 2.0 * ln({a} / {b}::DOUBLE) + ({a} / 2.0 - 1) * ln(@u) - ({a} + {b}) / 2.0 * ln(1 + {a} * @u / {b})"
               f" - lgamma({a} / 2.0) - lgamma({b} / 2.0) + lgamma(({a} + {b}) / 2.0))")
    return _upper_integral(density, f)


_AB = ["l_quantity", "l_discount", "l_extendedprice"]


def _welch_p_sql():
    parts = " UNION ALL ".join(
        f"""SELECT '{v}' AS variable, count({v}) FILTER (WHERE l_returnflag = 'A') AS n1, count({v}) FILTER (WHERE l_returnflag = 'R') AS n2,
          avg({v}) FILTER (WHERE l_returnflag = 'A') AS m1, avg({v}) FILTER (WHERE l_returnflag = 'R') AS m2,
          var_samp({v}) FILTER (WHERE l_returnflag = 'A') AS v1, var_samp({v}) FILTER (WHERE l_returnflag = 'R') AS v2 FROM lineitem""" for v in _AB)
    return f"""WITH m AS ({parts}),
      s AS (SELECT variable, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t,
        pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df FROM m)
      SELECT variable, {R('t')} AS t, {R('df', 4)} AS df, {R(t_p_sql('t', 'df'), 8)} AS p FROM s"""


@query("x4_welch_t_exact_p", _welch_p_sql())
def _x4_exact(spark, sf):
    w = X.welch_t(table(spark, sf, "lineitem"), "l_returnflag", "A", "R", _AB, with_p=True)
    return w.select("variable", rnd("t").alias("t"), rnd("df", 4).alias("df"), rnd("p", 8).alias("p"))


_PRIO = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _anova_report_sql(src, group, values, levels):
    parts = " UNION ALL ".join(f"SELECT '{v}' AS variable, {group} AS g, CAST({v} AS DOUBLE) AS x FROM {src} WHERE {v} IS NOT NULL AND {group} IS NOT NULL" for v in values)
    wide = ", ".join(f"""max(n) FILTER (WHERE g = '{x}') AS "n_{x}", {R(f"max(m) FILTER (WHERE g = '{x}')", 4)} AS "mean_{x}", {R(f"sqrt(max(v) FILTER (WHERE g = '{x}'))", 4)} AS "sd_{x}" """ for x in levels)
    return f"""WITH l AS ({parts}), g AS (SELECT variable, g, count(*) AS n, avg(x) AS m, var_samp(x) AS v FROM l GROUP BY ALL),
      t AS (SELECT variable, avg(x) AS grand FROM l GROUP BY variable),
      s AS (SELECT variable, CAST(sum(n) AS BIGINT) - count(*) AS df2, count(*) - 1 AS df1, sum(n * pow(m - grand, 2)) AS ssb, sum((n - 1) * coalesce(v, 0)) AS ssw, {wide}
        FROM g JOIN t USING (variable) GROUP BY variable),
      f AS (SELECT *, (ssb / df1) / (ssw / df2) AS fv FROM s)
      SELECT * EXCLUDE (ssb, ssw, fv), {R('fv')} AS f, {R(f_p_sql('fv', 'df1', 'df2'), 8)} AS p FROM f"""


@query("x5_anova_report", _anova_report_sql("orders", "o_orderpriority", ["o_totalprice", "o_shippriority_x"], _PRIO).replace(
    "FROM orders", "FROM (SELECT *, (o_orderkey * 7919) % 1013 AS o_shippriority_x FROM orders)"))
def _x5_report(spark, sf):
    o = table(spark, sf, "orders").withColumn("o_shippriority_x", (F.col("o_orderkey") * 7919) % 1013)
    a = X.anova_report(o, "o_orderpriority", ["o_totalprice", "o_shippriority_x"], _PRIO)
    out = {c: rnd(c, 4) for c in a.columns if c.startswith(("mean_", "sd_"))}
    return a.withColumns({**out, "f": rnd("f"), "p": rnd("p", 8)})


def _tukey_sql(src, group, value, alpha=0.05):
    """Panels of Simpson sums tabulate the normal CDF; a Taylor step reaches points between; scales on a linear grid."""
    phi = "(exp(-({x}) * ({x}) / 2) / sqrt(2 * pi()))"

    def taylor(x: str) -> str:
        near = f"(round(({x}) * 256) / 256)"
        d = f"(({x}) - {near})"
        f0 = phi.format(x=near)
        return (f"(nt[CAST(round(least(greatest({x}, -9), 9) * 256) AS INTEGER) + 2305] + {f0} * ({d} - {near} * {d} * {d} / 2 + ({near} * {near} - 1) * pow({d}, 3) / 6"
                f" - (pow({near}, 3) - 3 * {near}) * pow({d}, 4) / 24))")

    z = "(-8 + 0.1 * j)"
    gap = f"greatest({taylor(z)} - CASE WHEN {z} - q * s < -9 THEN 0 ELSE {taylor(f'greatest({z} - q * s, -9)')} END, 0)"
    inner = f"list_sum(list_transform(range(0, 161), lambda j: 0.1 * k * {phi.format(x=z)} * pow({gap}, k - 1)))"
    # the scale s = chi / sqrt(df) is close to normal around 1 with deviation 1 / sqrt(2 df)
    cdf = f"""SELECT k, dfw, q, sum(w * dens * {inner}) AS cdf FROM (
        SELECT k, dfw, q, s, w, exp(ln(2) + dfw / 2.0 * ln(dfw / 2.0) - lgamma(dfw / 2.0) + (dfw - 1) * ln(s) - dfw * s * s / 2.0) AS dens FROM (
          SELECT k, dfw, q, greatest(1 + i * 0.1 / sqrt(2.0 * dfw), 1e-9) AS s, 0.1 / sqrt(2.0 * dfw) AS w FROM {{0}}, range(-90, 91) AS r(i))), tab GROUP BY k, dfw, q"""
    return f"""WITH g AS (SELECT {group}, count(*) AS n, avg({value}) AS m, var_samp({value}) AS v FROM {src} GROUP BY 1),
      s0 AS (SELECT sum((n - 1) * coalesce(v, 0)) / (sum(n) - count(*)) AS msw, CAST(sum(n) - count(*) AS BIGINT) AS dfw, count(*) AS k FROM g),
      pn AS (SELECT i, {1 / 256 / 6} * ({phi.format(x='(i - 1) / 256.0')} + 4 * {phi.format(x='(i - 0.5) / 256.0')} + {phi.format(x='i / 256.0')}) AS a FROM range(-2304, 2305) AS r(i)),
      tab AS (SELECT list(c ORDER BY i) AS nt FROM (SELECT i, sum(a) OVER (ORDER BY i) AS c FROM pn)),
      p AS (SELECT a.{group} AS group1, b.{group} AS group2, b.m - a.m AS meandiff, sqrt(msw / 2.0 * (1.0 / a.n + 1.0 / b.n)) AS se,
        abs(b.m - a.m) / sqrt(msw / 2.0 * (1.0 / a.n + 1.0 / b.n)) AS q, k, dfw FROM g a JOIN g b ON a.{group} < b.{group}, s0),
      pc AS ({cdf.format('p')}),
      grid AS (SELECT k, dfw, 2.5 + 0.01 * i AS q FROM s0, range(0, 351) AS r(i)),
      gc AS ({cdf.format('grid')}),
      br AS (SELECT q, cdf, lead(q, 1) OVER (ORDER BY q) AS q1, lead(cdf, 1) OVER (ORDER BY q) AS c1, lag(q, 1) OVER (ORDER BY q) AS qm, lag(cdf, 1) OVER (ORDER BY q) AS cm,
        lead(q, 2) OVER (ORDER BY q) AS q2, lead(cdf, 2) OVER (ORDER BY q) AS c2 FROM gc),
      cr AS (SELECT {1 - alpha} AS y, qm * (y - cdf) * (y - c1) * (y - c2) / ((cm - cdf) * (cm - c1) * (cm - c2)) + q * (y - cm) * (y - c1) * (y - c2) / ((cdf - cm) * (cdf - c1) * (cdf - c2))
        + q1 * (y - cm) * (y - cdf) * (y - c2) / ((c1 - cm) * (c1 - cdf) * (c1 - c2)) + q2 * (y - cm) * (y - cdf) * (y - c1) / ((c2 - cm) * (c2 - cdf) * (c2 - c1)) AS crit
        FROM br WHERE cdf < {1 - alpha} AND c1 >= {1 - alpha})
      SELECT group1, group2, {R('meandiff')} AS meandiff, {R('se')} AS se, {R('p.q')} AS q, p.k, p.dfw, {R('1 - least(cdf, 1)', 8)} AS p_adj,
        {R('meandiff - crit * se', 5)} AS lo, {R('meandiff + crit * se', 5)} AS hi, 1 - cdf < {alpha} AS reject FROM p JOIN pc ON p.q = pc.q, cr"""


@query("x6_tukey_hsd_intervals", _tukey_sql("part", "p_type", "p_retailprice"))
def _x6_intervals(spark, sf):
    t = X.tukey_hsd(table(spark, sf, "part"), "p_type", "p_retailprice", with_p=True)
    return t.withColumns({**{c: rnd(c) for c in ("meandiff", "se", "q")}, "p_adj": rnd("p_adj", 8), "lo": rnd("lo", 5), "hi": rnd("hi", 5)})


def _chi2_sql(p: float) -> str:
    """The quantile from Simpson panels over the cube-root scale, where chi-square is close to normal."""
    x = "(k * pow(1 - 2 / (9 * k) + ({z}) * sqrt(2 / (9 * k)), 3))"
    slope = "(3 * k * pow(1 - 2 / (9 * k) + ({z}) * sqrt(2 / (9 * k)), 2) * sqrt(2 / (9 * k)))"
    dens = f"exp((k / 2 - 1) * ln({x} / 2) - {x} / 2 - lgamma(k / 2) - ln(2)) * {slope}"
    a2, a3 = "(-3 * f0 + 4 * fm - f1) / (2 * 0.01)", "(2 * f0 - 4 * fm + 2 * f1) / (3 * 0.01 * 0.01)"
    rounds = ", ".join(f"d{i + 1} AS (SELECT *, ({p} - c0 - {a2} * d * d - {a3} * d * d * d) / f0 AS dn FROM (SELECT * EXCLUDE (d, dn), dn AS d FROM d{i}))" for i in range(6))
    return f"""(WITH pan AS (SELECT k, -8 + 0.01 * i AS z, {dens.format(z='-8 + 0.01 * i')} AS f0, {dens.format(z='-8 + 0.01 * i + 0.005')} AS fm, {dens.format(z='-8 + 0.01 * i + 0.01')} AS f1 FROM (SELECT n - 1.0::DOUBLE AS k FROM m), range(0, 1600) AS r(i)),
      cum AS (SELECT *, coalesce(sum(0.01 / 6 * (f0 + 4 * fm + f1)) OVER (ORDER BY z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c0 FROM pan),
      d0 AS (SELECT *, 0.0::DOUBLE AS d, ({p} - c0) / f0 AS dn FROM cum WHERE c0 < {p} AND c0 + 0.01 / 6 * (f0 + 4 * fm + f1) >= {p}), {rounds}
      SELECT {x.format(z='z + dn')} FROM d6)"""


@query("x10_exact_intervals", f"""WITH m AS (SELECT count(l_extendedprice) AS n, avg(l_extendedprice) AS mean, stddev_samp(l_extendedprice) AS sd FROM lineitem)
    SELECT n, {R('mean')} AS mean, {R(f'mean - {X.Z975!r} * sd / sqrt(n)')} AS mean_lo, {R(f'mean + {X.Z975!r} * sd / sqrt(n)')} AS mean_hi, {R('sd')} AS sd,
      {R(f'sqrt((n - 1) * sd * sd / {_chi2_sql(0.975)})', 5)} AS sd_lo, {R(f'sqrt((n - 1) * sd * sd / {_chi2_sql(0.025)})', 5)} AS sd_hi FROM m""")
def _x10_exact(spark, sf):
    x = X.mean_sd_intervals(table(spark, sf, "lineitem"), "l_extendedprice", exact=True)
    return x.select("n", *[rnd(c).alias(c) for c in ("mean", "mean_lo", "mean_hi", "sd")], *[rnd(c, 5).alias(c) for c in ("sd_lo", "sd_hi")])


# ---- X17, X19, X20, O3 from cross moments ------------------------------------------------------

_XS = ["l_quantity", "l_discount", "l_tax"]


def _ols_sql():
    """Centred normal equations of three predictors by Cramer's rule."""
    xs = dict(zip("abc", _XS))
    covs = ", ".join(f"sum(({xs[i]} - m{i}) * ({xs[j]} - m{j})) AS s{i}{j}" for i, j in ("aa", "ab", "ac", "bb", "bc", "cc"))
    ys = ", ".join(f"sum(({x} - m{i}) * (l_extendedprice - my)) AS s{i}y" for i, x in xs.items())
    inv = {"aa": "sbb * scc - sbc * sbc", "bb": "saa * scc - sac * sac", "cc": "saa * sbb - sab * sab",
           "ab": "sac * sbc - sab * scc", "ac": "sab * sbc - sac * sbb", "bc": "sab * sac - saa * sbc"}

    def v(i, j):
        return f"v{''.join(sorted(i + j))}"

    betas = ", ".join(f"{' + '.join(f'{v(i, j)} * s{j}y' for j in 'abc')} AS b{i}" for i in "abc")
    spread = " + ".join(f"{v(i, j)} * m{i} * m{j}" for i in "abc" for j in "abc")
    lines = " UNION ALL ".join(
        [f"SELECT '{xs[i]}' AS term, b{i} AS coef, sqrt(sse / df * {v(i, i)}) AS se, df, r2, r2adj FROM f" for i in "abc"]
        + [f"SELECT 'intercept', my - ba * ma - bb * mb - bc * mc, sqrt(sse / df * (1.0 / n + {spread})), df, r2, r2adj FROM f"])
    return f"""WITH m AS (SELECT count(*) AS n, avg(l_extendedprice) AS my, {', '.join(f'avg({x}) AS m{i}' for i, x in xs.items())} FROM lineitem),
      s AS (SELECT any_value(n) AS n, any_value(my) AS my, {', '.join(f'any_value(m{i}) AS m{i}' for i in 'abc')}, {covs}, {ys}, sum(pow(l_extendedprice - my, 2)) AS syy FROM lineitem, m),
      d AS (SELECT *, saa * (sbb * scc - sbc * sbc) - sab * (sab * scc - sbc * sac) + sac * (sab * sbc - sbb * sac) AS det FROM s),
      i AS (SELECT *, {', '.join(f'({e}) / det AS v{k}' for k, e in inv.items())} FROM d),
      b AS (SELECT *, {betas} FROM i),
      e AS (SELECT *, syy - ba * say - bb * sby - bc * scy AS sse, n - 4 AS df FROM b),
      f AS (SELECT *, 1 - sse / syy AS r2, 1 - sse / syy * (n - 1) / df AS r2adj FROM e),
      l AS ({lines})
      SELECT term, {R('coef', 4)} AS coef, {R('se', 4)} AS se, {R('coef / se', 4)} AS t, {R(t_p_sql('(coef / se)', 'df'), 8)} AS p, false AS determined,
        {R('r2')} AS r2, {R('r2adj')} AS r2adj, df FROM l"""


@query("x17_multiple_ols_moments", _ols_sql())
def _x17_moments(spark, sf):
    o = G.ols(table(spark, sf, "lineitem"), "l_extendedprice", _XS)
    return o.select("term", *[rnd(c, 4).alias(c) for c in ("coef", "se", "t")], rnd("p", 8).alias("p"), "determined",
                    rnd("r2").alias("r2"), rnd("r2adj").alias("r2adj"), "df")


_PC = ["l_quantity", "l_tax", "l_discount"]
_PC_SRC = "(SELECT l_extendedprice, l_quantity / 50.0 AS l_quantity, l_tax * 10 + l_quantity / 200.0 AS l_tax, l_discount * 10 AS l_discount FROM lineitem)"


def _pc_source(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_extendedprice", (F.col("l_quantity") / 50.0).alias("l_quantity"),
        (F.col("l_tax") * 10 + F.col("l_quantity") / 200.0).alias("l_tax"), (F.col("l_discount") * 10).alias("l_discount"))


def _pca_ctes():
    """Eigenvalues of the 3 x 3 covariance by the cubic formula, vectors as cross products of two rows."""
    names = dict(zip("abc", _PC))
    covs = ", ".join(f"covar_samp({names[i]}, {names[j]}) AS s{i}{j}" for i, j in ("aa", "ab", "ac", "bb", "bc", "cc"))
    ys = ", ".join(f"covar_samp({x}, l_extendedprice) AS y{i}" for i, x in names.items())
    rows = [("saa - l", "sab", "sac"), ("sab", "sbb - l", "sbc"), ("sac", "sbc", "scc - l")]
    crosses = []
    for p, q in ((0, 1), (0, 2), (1, 2)):
        (a1, a2, a3), (b1, b2, b3) = rows[p], rows[q]
        crosses.append(f"[({a2}) * ({b3}) - ({a3}) * ({b2}), ({a3}) * ({b1}) - ({a1}) * ({b3}), ({a1}) * ({b2}) - ({a2}) * ({b1})]")
    norm = "list_sum(list_transform({0}, lambda x: x * x))"
    return f"""m AS (SELECT count(*) AS n, avg(l_extendedprice) AS my, var_samp(l_extendedprice) AS vy, {covs}, {ys} FROM {_PC_SRC}),
      q AS (SELECT *, (saa + sbb + scc) / 3 AS c FROM m),
      r AS (SELECT *, sqrt((pow(saa - c, 2) + pow(sbb - c, 2) + pow(scc - c, 2) + 2 * (sab * sab + sac * sac + sbc * sbc)) / 6) AS h FROM q),
      g AS (SELECT *, acos(greatest(-1, least(1, ((saa - c) * ((sbb - c) * (scc - c) - sbc * sbc) - sab * (sab * (scc - c) - sbc * sac) + sac * (sab * sbc - (sbb - c) * sac)) / pow(h, 3) / 2))) / 3 AS phi FROM r),
      ev AS (SELECT *, unnest([0, 1, 2]) AS component, unnest([c + 2 * h * cos(phi), 3 * c - (c + 2 * h * cos(phi)) - (c + 2 * h * cos(phi + 2 * pi() / 3)), c + 2 * h * cos(phi + 2 * pi() / 3)]) AS l FROM g),
      cx AS (SELECT *, unnest([{', '.join(crosses)}]) AS w FROM ev),
      vv AS (SELECT * FROM cx QUALIFY row_number() OVER (PARTITION BY component ORDER BY {norm.format('w')} DESC) = 1),
      u AS (SELECT *, list_transform(w, lambda x: x / sqrt({norm.format('w')})) AS v0 FROM vv),
      pc AS (SELECT *, list_transform(v0, lambda x: x * CASE WHEN list_max(v0) >= -list_min(v0) THEN 1 ELSE -1 END) AS v FROM u)"""


@query("x19_components_of_columns", f"""WITH {_pca_ctes()}
    SELECT component, {R('l', 8)} AS variance, {R('l / (saa + sbb + scc)', 8)} AS explained,
      {R('sum(l) OVER (ORDER BY component) / (saa + sbb + scc)', 8)} AS cumulative, {', '.join(f'{R(f"v[{i + 1}]")} AS w{i}' for i in range(3))} FROM pc""")
def _x19_columns(spark, sf):
    c = G.Components.fit(G.cross_moments(_pc_source(spark, sf), _PC))
    both = c.explained(spark, 3).join(c.loadings(spark, 3), "component")
    return both.select("component", *[rnd(x, 8).alias(x) for x in ("variance", "explained", "cumulative")],
                       *[rnd(F.col("weights")[i]).alias(f"w{i}") for i in range(3)])


@query("o3_contributors_of_columns", f"""WITH {_pca_ctes()},
    w AS (SELECT component, i AS pos, v[i + 1] AS w, list_sum(list_transform(v, lambda x: abs(x))) AS t FROM pc, range(0, 3) AS r(i))
    SELECT component, CAST(pos AS INTEGER) AS pos, {R('w')} AS w, [{', '.join(f"'{n}'" for n in _PC)}][pos + 1] AS feature, {R('abs(w) / t')} AS share,
      CAST(row_number() OVER (PARTITION BY component ORDER BY abs(w) / t DESC, pos) AS INTEGER) AS rank FROM w
    QUALIFY row_number() OVER (PARTITION BY component ORDER BY abs(w) / t DESC, pos) <= 2""")
def _o3_columns(spark, sf):
    c = G.Components.fit(G.cross_moments(_pc_source(spark, sf), _PC))
    return top_contributors(c.loadings(spark, 3), "component", "weights", _PC, 2).withColumns({"w": rnd("w"), "share": rnd("share")})


@query("x20_component_regression_of_columns", f"""WITH {_pca_ctes()},
    b AS (SELECT component, (v[1] * ya + v[2] * yb + v[3] * yc) / l AS coef, l, n, vy, my FROM pc WHERE component < 2),
    s AS (SELECT vy * (any_value(n) - 1) - sum(coef * coef * l) * (any_value(n) - 1) AS sse, any_value(n) - 3 AS df FROM b GROUP BY vy)
    SELECT 'pc' || (component + 1) AS term, {R('coef', 4)} AS coef, {R('sqrt(sse / df / (l * (n - 1)))', 4)} AS se, {R('1 - sse / (vy * (n - 1))')} AS r2 FROM b, s
    UNION ALL SELECT 'intercept', {R('any_value(my)', 4)}, {R('sqrt(any_value(sse) / any_value(df) / any_value(n))', 4)}, {R('1 - any_value(sse) / (any_value(vy) * (any_value(n) - 1))')} FROM b, s""")
def _x20_columns(spark, sf):
    src = _pc_source(spark, sf)
    scores = G.Components.fit(G.cross_moments(src, _PC)).scores(src, 2)
    return G.ols(scores, "l_extendedprice", ["pc1", "pc2"]).select("term", rnd("coef", 4).alias("coef"), rnd("se", 4).alias("se"), rnd("r2").alias("r2"))
