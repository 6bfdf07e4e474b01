"""

Test statistics come from Spark aggregates; p-values, quantiles and intervals
are native columns (``functions.special``) on the small result table (one row per
test or pair of groups). Statistics of degenerate data (one row, constant
values, exact fits) are NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import special as S
from quarry.operators.aggregates import group_quantiles
from quarry.operators.ordering import global_running_sum


# ---- X1 - X3 correlation ------------------------------------------------------------

CHUNK = 256


def correlation_long(df: DataFrame, cols: Sequence[str], method: str = "pearson") -> DataFrame:
    """Correlation matrix as a long table (var1, var2, corr), one aggregate.

    ``method='spearman'`` correlates average ranks (:func:`spearman_pairs`).
    Pairwise-complete: rows where either value is NULL don't count for a pair.
    """
    if len(cols) < 2:
        raise ValueError("need two or more columns")
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if method == "spearman":
        half = spearman_pairs(df, pairs)
        both = F.array(F.struct("var1", "var2", "corr"),
                       F.struct(F.col("var2").alias("var1"), F.col("var1").alias("var2"), "corr"))
        itself = F.array(*[F.struct(F.lit(c).alias("var1"), F.lit(c).alias("var2"), F.lit(1.0).alias("corr")) for c in cols])
        diagonal = df.sparkSession.range(1).select(F.explode(itself).alias("c"))
        return half.select(F.explode(both).alias("c")).unionByName(diagonal).select("c.*")
    src, out = df, None
    # long expression lists are chunked: at most CHUNK correlations per aggregate
    for start in range(0, len(pairs), CHUNK):
        chunk = pairs[start:start + CHUNK]
        wide = src.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in chunk])
        cells = []
        for a, b in chunk:
            v = F.col(f"{a}__{b}").cast("double")
            cells.append(F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), v.alias("corr")))
            cells.append(F.struct(F.lit(b).alias("var1"), F.lit(a).alias("var2"), v.alias("corr")))
        if start == 0:  # the diagonal rides along with the first chunk
            cells += [F.struct(F.lit(a).alias("var1"), F.lit(a).alias("var2"), F.lit(1.0).alias("corr")) for a in cols]
        part = wide.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
        out = part if out is None else out.unionByName(part)
    return out


def spearman_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(var1, var2, corr): rank correlation of every pair over the rows complete for it.

    All pairs go through one frequency table of (pair, a, b), so a hot value is
    pre-aggregated before anything is joined. The frequencies of each side get
    one distributed running count, which gives the average ranks; these are
    joined to the frequency table and correlated with its counts as weights.
    The mean rank of n rows is (n + 1) / 2, so ranks are centred exactly. NULL
    where a side is constant or no row is complete.
    """
    cells = F.array(*[
        F.struct(F.lit(i).alias("pair"), F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
        for i, (a, b) in enumerate(pairs)])
    joint = df.select(F.explode(cells).alias("c")).select("c.*").where("a IS NOT NULL AND b IS NOT NULL")
    joint = joint.groupBy("pair", "a", "b").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    sides = joint.select("pair", F.lit(0).alias("side"), F.col("a").alias("v"), "n").unionByName(
        joint.select("pair", F.lit(1).alias("side"), F.col("b").alias("v"), "n"))
    sides = sides.groupBy("pair", "side", "v").agg(F.sum("n").alias("n"))
    cum = global_running_sum(sides, ["pair", "side", "v"], "n", "cum")
    offsets = cum.groupBy("pair", "side").agg(F.min(F.col("cum") - F.col("n")).alias("off"), F.sum("n").alias("t"))
    place = F.col("cum") - F.col("off") - (F.col("n") - 1) / 2.0  # the middle of the value's positions
    # two rows a pair of columns are broadcast
    ranks = cum.join(F.broadcast(offsets), ["pair", "side"]).select("pair", "side", "v", (place - (F.col("t") + 1) / 2.0).alias("r"))
    ra = ranks.where("side = 0").select("pair", F.col("v").alias("a"), F.col("r").alias("ra"))
    rb = ranks.where("side = 1").select("pair", F.col("v").alias("b"), F.col("r").alias("rb"))
    n, x, y = F.col("n"), F.col("ra"), F.col("rb")
    corr = F.try_divide(F.sum(n * x * y), F.sqrt(F.sum(n * x * x)) * F.sqrt(F.sum(n * y * y)))
    found = joint.join(ra, ["pair", "a"]).join(rb, ["pair", "b"]).groupBy("pair").agg(corr.alias("corr"))
    names = F.array(*[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2")) for a, b in pairs])
    every = df.sparkSession.range(1).select(F.posexplode(names).alias("pair", "names"))
    return every.join(found, "pair", "left").select("names.var1", "names.var2", "corr")


def phi_coefficients(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """X2 without dummy columns: phi of every two levels that occur together, from their counts.

    (var1, level1, var2, level2, n, phi) for each two of ``cols``; one aggregate
    of the level pairs and one of the levels, any number of levels. Two levels
    that never occur together have phi = -sqrt(p1 p2 / ((1 - p1)(1 - p2))) and no
    row; levels held by no row or by all have NULL. NULL is not a level; the
    counts of a pair of columns are those of the rows complete for it.
    """
    pairs = [(x, y) for i, x in enumerate(cols) for y in cols[i + 1:]]
    cells = F.explode(F.array(*[F.struct(
        F.lit(x).alias("var1"), F.col(x).cast("string").alias("level1"), F.lit(y).alias("var2"), F.col(y).cast("string").alias("level2"))
        for x, y in pairs])).alias("c")
    joint = df.select(cells).select("c.*").where("level1 IS NOT NULL AND level2 IS NOT NULL").groupBy(
        "var1", "level1", "var2", "level2").agg(F.count(F.lit(1)).alias("n"))
    pair = ["var1", "var2"]
    total = joint.groupBy(*pair).agg(F.sum("n").cast("double").alias("t"))
    first = joint.groupBy(*pair, "level1").agg(F.sum("n").cast("double").alias("a"))
    second = joint.groupBy(*pair, "level2").agg(F.sum("n").cast("double").alias("b"))
    a, b, t = F.col("a"), F.col("b"), F.col("t")
    phi = F.try_divide(t * F.col("n") - a * b, F.sqrt(a * (t - a)) * F.sqrt(b * (t - b)))
    return joint.join(first, [*pair, "level1"]).join(second, [*pair, "level2"]).join(total, pair).select(
        "var1", "level1", "var2", "level2", "n", phi.alias("phi"))


# ---- X4 - X6 tests of means ------------------------------------------------------------

def welch_t(df: DataFrame, group: str, a, b, variables: Sequence[str], with_p: bool = False) -> DataFrame:
    """Welch two-sample t-test of several variables between groups ``a`` and ``b``.

    One aggregate gives (n, mean, var) per (variable, group); t and the
    Welch-Satterthwaite df are column arithmetic on the two-row pivot.
    """
    long = df.where(F.col(group).isin(a, b)).select(
        group, *[F.col(v).cast("double").alias(v) for v in variables]).unpivot(
        [group], list(variables), "variable", "x")
    m = long.where(F.col("x").isNotNull()).groupBy("variable").pivot(group, [a, b]).agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.var_samp("x").alias("var"))
    n1, n2 = F.col(f"{a}_n"), F.col(f"{b}_n")
    v1, v2 = F.try_divide(F.col(f"{a}_var"), n1.cast("double")), F.try_divide(F.col(f"{b}_var"), n2.cast("double"))
    t = F.try_divide(F.col(f"{a}_mean") - F.col(f"{b}_mean"), F.sqrt(v1 + v2))
    dof = F.try_divide((v1 + v2) ** 2, F.try_divide(v1 ** 2, (n1 - 1).cast("double")) + F.try_divide(v2 ** 2, (n2 - 1).cast("double")))
    out = m.select("variable", n1.alias("n1"), n2.alias("n2"), F.col(f"{a}_mean").alias("mean1"),
                   F.col(f"{b}_mean").alias("mean2"), F.sqrt(f"{a}_var").alias("sd1"),
                   F.sqrt(f"{b}_var").alias("sd2"), t.alias("t"), dof.alias("df"))
    return out.withColumn("p", S.t_two_sided("t", "df")) if with_p else out


def group_moments(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(group).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var"))


def anova_oneway(df: DataFrame, group: str, value: str, with_p: bool = False) -> DataFrame:
    """One-way ANOVA from per-group moments (k rows): F, df1, df2."""
    gm = group_moments(df, group, value)
    tot = gm.agg(F.sum("n").alias("N"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"),
                 F.count(F.lit(1)).alias("k"))
    g = tot.select(F.struct("*")).scalar()
    ss = gm.agg(F.sum(F.col("n") * (F.col("mean") - g.grand) ** 2).alias("ssb"),
                F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("ssw"))
    out = ss.select(g.k.alias("k"), g.N.alias("n"), "ssb", "ssw", (g.k - 1).alias("df1"), (g.N - g.k).alias("df2"),
                    F.try_divide(F.try_divide(F.col("ssb"), (g.k - 1).cast("double")), F.try_divide(F.col("ssw"), (g.N - g.k).cast("double"))).alias("f"))
    return out.withColumn("p", S.f_upper("f", "df1", "df2")) if with_p else out


def anova_report(df: DataFrame, group: str, values: Sequence[str], levels: Sequence | None = None) -> DataFrame:
    """X5 in full: per variable F, its degrees of freedom and p, with n, mean and sd of every level beside it.

    ``levels`` fixes the columns (default: the levels found, one row each on
    the driver); rows of other levels still count for F. One aggregate per
    (variable, level) serves all variables.
    """
    if levels is None:
        levels = [r[0] for r in df.select(group).where(F.col(group).isNotNull()).distinct().orderBy(group).collect()]
    long = df.where(F.col(group).isNotNull()).select(
        F.col(group).alias("__g"), *[F.col(v).cast("double").alias(v) for v in values]).unpivot(["__g"], list(values), "variable", "x")
    per = long.where(F.col("x").isNotNull()).groupBy("variable", "__g").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.var_samp("x").alias("var"))
    within = Window.partitionBy("variable")  # one row per level
    grand = F.sum(F.col("n") * F.col("mean")).over(within) / F.sum("n").over(within)
    sums = per.withColumn("__b", F.col("n") * (F.col("mean") - grand) ** 2).groupBy("variable").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("__b").alias("ssb"),
        F.sum((F.col("n") - 1) * F.coalesce("var", F.lit(0.0))).alias("ssw"),
        *[F.max(F.when(F.col("__g") == F.lit(x), e)).alias(f"{name}_{x}") for x in levels
          for name, e in (("n", F.col("n")), ("mean", F.col("mean")), ("sd", F.sqrt("var")))])
    df1, df2 = F.col("k") - 1, F.col("n") - F.col("k")
    f = F.try_divide(F.try_divide(F.col("ssb"), df1.cast("double")), F.try_divide(F.col("ssw"), df2.cast("double")))
    return sums.select("variable", f.alias("f"), df1.alias("df1"), df2.alias("df2"), S.f_upper(f, df1, df2).alias("p"),
                       *[f"{name}_{x}" for x in levels for name in ("n", "mean", "sd")])


def range_quantiles(settings: DataFrame, p: float, rounds: int = 4, points: int = 64, top: float = 256.0) -> DataFrame:
    """(k, dfw, crit): quantile of the studentised range for every (k, dfw).

    Each round evaluates the distribution at ``points`` places between the
    bounds, over an exploded grid of quadrature nodes, and keeps the interval
    that holds the quantile; the last one is interpolated.
    """
    now = settings.select("k", "dfw").where((F.col("dfw") > 0) & (F.col("k") > 1)).distinct().select(
        "k", "dfw", F.lit(0.0).alias("lo"), F.lit(top).alias("hi"))
    for _ in range(rounds):
        places = now.withColumn("step", (F.col("hi") - F.col("lo")) / points).withColumn(
            "q", F.explode(F.transform(F.sequence(F.lit(0), F.lit(points)), lambda i: F.col("lo") + F.col("step") * i)))
        values = _range_cdf(places, "q", ["k", "dfw", "q"])
        now = values.groupBy("k", "dfw").agg(
            F.max(F.when(F.col("cdf") < p, F.struct("q", "cdf"))).alias("a"), F.min(F.when(F.col("cdf") >= p, F.struct("q", "cdf"))).alias("b"),
        ).select("k", "dfw", F.coalesce("a.q", F.lit(0.0)).alias("lo"), F.col("b.q").alias("hi"),
                 F.coalesce("a.cdf", F.lit(0.0)).alias("at_lo"), F.col("b.cdf").alias("at_hi"))
    share = F.try_divide(F.lit(p) - F.col("at_lo"), F.col("at_hi") - F.col("at_lo"))
    return now.select("k", "dfw", (F.col("lo") + (F.col("hi") - F.col("lo")) * share).alias("crit"))


def _range_cdf(rows: DataFrame, q: str, by: Sequence[str]) -> DataFrame:
    """(by..., cdf): studentised range distribution, nodes exploded and summed in the tasks."""
    nodes = rows.select(*by, F.explode(F.sequence(F.lit(0), F.lit(S.Z_NODES - 1))).alias("__i")).select(
        *by, "__i", F.explode(F.sequence(F.lit(0), F.lit(S.S_NODES - 1))).alias("__j"))
    node = S.range_node(F.col(q), F.col("k").cast("double"), F.col("dfw").cast("double"), F.col("__i").cast("double"), F.col("__j").cast("double"))
    return nodes.groupBy(*by).agg(F.least(F.sum(node), F.lit(1.0)).alias("cdf"))


def tukey_hsd(df: DataFrame, group: str, value: str, with_p: bool = False, alpha: float = 0.05) -> DataFrame:
    """Tukey-Kramer all pairs of groups: mean difference, standard error, q;
    ``with_p`` adds the adjusted p, the confidence interval and the decision.

    Pairs of *groups* come from a k-row moment table (``group_pairs``), never
    pairs of rows. NULL where the groups have no spread or no degrees of freedom.
    """
    gm = group_moments(df, group, value)
    stats = gm.agg(F.try_divide(F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))),
                                (F.sum("n") - F.count(F.lit(1))).cast("double")).alias("msw"),
                   (F.sum("n") - F.count(F.lit(1))).alias("dfw"), F.count(F.lit(1)).alias("k"))
    s = stats.select(F.struct("*")).scalar()
    pairs = group_pairs(gm.select(group, "n", "mean"), group)
    se = F.sqrt(s.msw / 2.0 * (1.0 / F.col("l.n") + 1.0 / F.col("r.n")))
    out = pairs.select(F.col(f"l.{group}").alias("group1"), F.col(f"r.{group}").alias("group2"),
                       (F.col("r.mean") - F.col("l.mean")).alias("meandiff"), se.alias("se"),
                       F.try_divide(F.abs(F.col("r.mean") - F.col("l.mean")), se).alias("q"), s.k.alias("k"),
                       s.dfw.alias("dfw"))
    if not with_p:
        return out
    # one row per pair of groups and one per (k, dfw); both are cut so that nothing is worked out twice
    out = out.checkpoint()
    crit = range_quantiles(out, 1.0 - alpha).checkpoint()
    tail = _range_cdf(out.where("q IS NOT NULL AND dfw > 0"), "q", ["group1", "group2", "q", "k", "dfw"])
    tail = tail.select("group1", "group2", (1.0 - F.col("cdf")).alias("p_adj"))
    half = F.col("crit") * F.col("se")
    return (
        out.join(tail, ["group1", "group2"], "left").join(crit, ["k", "dfw"], "left")
        .select("group1", "group2", "meandiff", "se", "q", "k", "dfw", "p_adj", (F.col("meandiff") - half).alias("lo"),
                (F.col("meandiff") + half).alias("hi"), (F.col("p_adj") < alpha).alias("reject"))
    )


# ---- X7 - X9 distribution tests ---------------------------------------------------------

def ks_normal(df: DataFrame, col: str) -> DataFrame:
    """KS test of z-scores against N(0, 1) (``ml.stat.KolmogorovSmirnovTest``)."""
    from pyspark.ml.stat import KolmogorovSmirnovTest

    from quarry.operators.features import apply_zscore, fit_zscore

    z = apply_zscore(df.select(col).where(F.col(col).isNotNull()), fit_zscore(df, [col]), [col], "_z")
    return KolmogorovSmirnovTest.test(z, f"{col}_z", "norm", 0.0, 1.0)


def ks_shifted_poisson(df: DataFrame, col: str, shift: int = 1) -> DataFrame:
    """KS distance between an integer column and Poisson(mean - shift) shifted by ``shift``.

    For every distinct value x: D = max(F_n(x) - F(x), F(x) - F_n(x-)). The
    Poisson CDF is an incomplete gamma function at the distinct values, so a
    wide range of values costs nothing.
    """
    x = df.select(F.col(col).cast("long").alias("x")).where(F.col("x").isNotNull())
    s = x.agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("m")).first()  # two numbers
    if not s["n"]:
        return df.sparkSession.createDataFrame([(None, 0, None)], "d double, n long, lam double")
    n, lam = F.lit(s["n"]).cast("long"), F.lit(s["m"] - shift)
    freq = x.groupBy("x").agg(F.count(F.lit(1)).alias("c"))
    emp = global_running_sum(freq, [F.asc("x")], "c", "cum")
    j = emp.withColumn("cdf", S.poisson_cdf(F.col("x") - shift, lam))
    d = F.greatest(F.col("cum") / n - F.col("cdf"), F.col("cdf") - (F.col("cum") - F.col("c")) / n)
    return j.agg(F.max(d).alias("d"), F.first(n).alias("n"), F.first(lam).alias("lam"))


def ks_two_sample(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    """Two-sample KS distance max |F_a(x) - F_b(x)| over the distinct values.

    Per distinct value the step of F_a - F_b is ca/na - cb/nb; its running sum
    (distributed, see ``ordering``) is the difference of the two CDFs.
    """
    x = df.where(F.col(group).isin(a, b) & F.col(value).isNotNull())
    n = x.agg(F.struct(F.count_if(F.col(group) == a).alias("na"), F.count_if(F.col(group) == b).alias("nb"))).scalar()
    steps = x.groupBy(value).agg((F.count_if(F.col(group) == a) / n.na - F.count_if(F.col(group) == b) / n.nb)
                                 .alias("step"))
    cum = global_running_sum(steps, [F.asc(value)], "step", "diff")
    return cum.agg(F.max(F.abs("diff")).alias("d"), F.first(n.na).alias("n1"), F.first(n.nb).alias("n2"))


# ---- X10 intervals -------------------------------------------------------------------------

Z975 = 1.959963984540054  # fixed value: standard normal 97.5 % quantile


def wilson_hilferty(k: Column, z: float) -> Column:
    """Chi-square quantile approximation k (1 - 2/(9k) + z sqrt(2/(9k)))^3."""
    return k * F.pow(F.lit(1.0) - F.lit(2.0) / (9.0 * k) + F.lit(z) * F.sqrt(F.lit(2.0) / (9.0 * k)), 3)


def mean_sd_intervals(df: DataFrame, col: str, exact: bool = False) -> DataFrame:
    """Normal 95 % CI of the mean and chi-square 95 % CI of the sd.

    ``exact`` inverts the chi-square distribution instead of approximating it.
    One row has no sd: its bounds are NULL.
    """
    m = df.agg(F.count(col).alias("n"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("sd"))
    k = F.when(F.col("n") > 1, (F.col("n") - 1).cast("double"))
    se = F.try_divide(F.col("sd"), F.sqrt("n"))
    high, low = (S.chi2_quantile(p, k) if exact else wilson_hilferty(k, z) for p, z in ((0.975, Z975), (0.025, -Z975)))
    return m.select(
        "n", "mean", (F.col("mean") - Z975 * se).alias("mean_lo"), (F.col("mean") + Z975 * se).alias("mean_hi"), "sd",
        F.sqrt(F.try_divide(k * F.col("sd") ** 2, high)).alias("sd_lo"),
        F.sqrt(F.try_divide(k * F.col("sd") ** 2, low)).alias("sd_hi"))


# ---- X11 - X12 bootstrap --------------------------------------------------------------------

def bootstrap_ci(df: DataFrame, key: str, value: str, replicates: int, seed: int = 0) -> DataFrame:
    """X11: bootstrap estimate and 95 % percentile interval of the mean and sd."""
    from quarry.operators.sampling import bootstrap_moments

    reps = bootstrap_moments(df, key, value, replicates, seed)
    return reps.agg(F.avg("mean").alias("mean_est"), F.percentile("mean", 0.025).alias("mean_lo"),
                    F.percentile("mean", 0.975).alias("mean_hi"), F.avg("sd").alias("sd_est"),
                    F.percentile("sd", 0.025).alias("sd_lo"), F.percentile("sd", 0.975).alias("sd_hi"))


def bootstrap_t_test(df: DataFrame, key: str, value: str, group: str, a, b, replicates: int,
                     seed: int = 0) -> DataFrame:
    """Bootstrap Welch t under the null: both groups re-centred on the
    pooled mean, resampled (Poisson weights) R times; p = share of |t*| >= |t|."""
    from quarry.operators.sampling import bootstrap_moments

    x = df.where(F.col(group).isin(a, b) & F.col(value).isNotNull()).select(key, value, group)
    gm = x.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v"))
    obs = gm.agg(
        F.first(F.when(F.col(group) == a, F.col("m")), True).alias("ma"),
        F.first(F.when(F.col(group) == b, F.col("m")), True).alias("mb"),
        F.first(F.when(F.col(group) == a, F.col("v") / F.col("n")), True).alias("va"),
        F.first(F.when(F.col(group) == b, F.col("v") / F.col("n")), True).alias("vb"),
        (F.sum(F.col("m") * F.col("n")) / F.sum("n")).alias("grand"))
    o = obs.select(F.struct("*")).scalar()
    t_obs = (o.ma - o.mb) / F.sqrt(o.va + o.vb)
    # gm has exactly the two groups a and b: a proven bound, broadcast
    centred = x.join(F.broadcast(gm.select(group, "m")), group).withColumn(value, F.col(value) - F.col("m") + o.grand)
    reps = bootstrap_moments(centred.drop("m"), key, value, replicates, seed, by=[group])
    per = reps.groupBy("rep").agg(
        F.first(F.when(F.col(group) == a, F.col("mean")), True).alias("ma"),
        F.first(F.when(F.col(group) == b, F.col("mean")), True).alias("mb"),
        F.first(F.when(F.col(group) == a, F.col("sd") ** 2 / F.col("n")), True).alias("va"),
        F.first(F.when(F.col(group) == b, F.col("sd") ** 2 / F.col("n")), True).alias("vb"))
    t_star = (F.col("ma") - F.col("mb")) / F.sqrt(F.col("va") + F.col("vb"))
    return per.agg(F.first(t_obs).alias("t_obs"), F.avg((F.abs(t_star) >= F.abs(t_obs)).cast("double")).alias("p"),
                   F.count(F.lit(1)).alias("replicates"))


def bootstrap_frequency_ci(df: DataFrame, value: str, replicates: int, seed: int = 0, key: Column | None = None) -> DataFrame:
    """X11 on the frequency table: the cost follows the distinct values, so 10,000 replicates are affordable."""
    from quarry.operators.sampling import bootstrap_frequency_moments

    reps = bootstrap_frequency_moments(df, value, replicates, seed, key=key)  # one row per replicate from here on
    return reps.agg(F.count(F.lit(1)).alias("replicates"), *[e for c in ("mean", "sd") for e in (
        F.avg(c).alias(f"{c}_est"), F.percentile(c, 0.025).alias(f"{c}_lo"), F.percentile(c, 0.975).alias(f"{c}_hi"))])


def bootstrap_frequency_t_test(df: DataFrame, value: str, group: str, a, b, replicates: int, seed: int = 0,
                               key: Column | None = None) -> DataFrame:
    """X12 on the frequency table: |t*| of groups centred on a common mean against |t|.

    Centring moves a replicate's mean by a constant and leaves its sd alone, so
    the values are never rewritten. NULL where a group has no spread.
    """
    from quarry.operators.sampling import bootstrap_frequency_moments

    x = df.where(F.col(group).isin(a, b) & F.col(value).isNotNull())

    def of(g, c: str, f=F.max) -> Column:
        return f(F.when(F.col(group) == g, F.col(c)))

    seen = x.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))

    def both(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        return rows.groupBy(*by).agg(
            (of(a, "mean") - of(b, "mean")).alias("gap"),
            F.sqrt(F.try_divide(of(a, "sd") ** 2, of(a, "n").cast("double")) + F.try_divide(of(b, "sd") ** 2, of(b, "n").cast("double"))).alias("se"))

    observed = both(seen, []).select(F.struct("gap", F.try_divide(F.col("gap"), F.col("se")).alias("t"))).scalar()
    reps = both(bootstrap_frequency_moments(x, value, replicates, seed, [group], key), ["rep"])
    t_star = F.try_divide(F.col("gap") - observed.gap, F.col("se"))
    return reps.agg(F.first(observed.t).alias("t_obs"), F.avg((F.abs(t_star) >= F.abs(observed.t)).cast("double")).alias("p"),
                    F.count(F.lit(1)).alias("replicates"))


# ---- X13 - X15 grid posteriors -------------------------------------------------------------

def grid_posterior_mu_sigma(df: DataFrame, col: str, size: int = 1001, width: float = 5.0) -> DataFrame:
    """Posterior of (mu, sigma) on a size x size grid, uniform priors.

    The log-likelihood needs only (n, sum x, sum x^2): one aggregate over the
    data, then ``size^2`` grid rows (independent of the data size).
    Returns the MAP cell, its posterior mass and the posterior means.
    """
    s = df.agg(F.count(col).alias("n"), F.sum(col).alias("sx"), F.sum(F.col(col) ** 2).alias("sxx"),
               F.avg(col).alias("m"), F.stddev_samp(col).alias("sd")).select(F.struct("*")).scalar()
    spark = df.sparkSession
    se = s.sd / F.sqrt(s.n)
    mu = s.m - width * se + (F.floor(F.col("id") / size)) * (2 * width * se / (size - 1))
    sd_w = s.sd * width / F.sqrt(2 * s.n)
    sig = s.sd - sd_w + (F.col("id") % size) * (2 * sd_w / (size - 1))
    grid = spark.range(size * size).select(mu.alias("mu"), sig.alias("sigma"))
    ll = -s.n * F.ln("sigma") - (s.sxx - 2 * F.col("mu") * s.sx + s.n * F.col("mu") ** 2) / (2 * F.col("sigma") ** 2)
    g = grid.withColumn("ll", ll)
    top = g.agg(F.max("ll")).scalar()
    p = g.withColumn("w", F.exp(F.col("ll") - top))
    return p.agg(F.max_by("mu", "ll").alias("map_mu"), F.max_by("sigma", "ll").alias("map_sigma"),
                 (F.max("w") / F.sum("w")).alias("map_mass"),
                 (F.sum(F.col("w") * F.col("mu")) / F.sum("w")).alias("post_mu"),
                 (F.sum(F.col("w") * F.col("sigma")) / F.sum("w")).alias("post_sigma"))


def posterior_mu_interval(df: DataFrame, col: str, by: Sequence[str] = (), alpha: float = 0.05,
                          size: int = 1001, width: float = 5.0) -> DataFrame:
    """Posterior of mu with sigma taken as known (the sample sd),
    uniform prior on a ``size`` grid around the mean; equal-tail credible
    interval: lower = last grid point with CDF <= alpha/2, upper = first with
    CDF >= 1 - alpha/2. Per group when ``by`` is given.

    The grid is generated from the per-group moments (``explode(sequence)``):
    groups x size rows, no join; the CDF is a window per group over the grid.
    """
    s = df.groupBy(*by).agg(F.count(col).alias("n"), F.avg(col).alias("m"), F.stddev_samp(col).alias("sd"))
    g = s.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
    se = F.col("sd") / F.sqrt("n")
    g = g.withColumn("mu", F.col("m") - width * se + F.col("i") * (2 * width * se / (size - 1)))
    g = g.withColumn("w", F.exp(-(F.col("mu") - F.col("m")) ** 2 / (2 * se ** 2)))
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    run = part.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("cdf", F.sum("w").over(run) / F.sum("w").over(part.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)))
    return g.groupBy(*by).agg(
        F.max(F.when(F.col("cdf") <= alpha / 2, F.col("mu"))).alias("lo"),
        F.min(F.when(F.col("cdf") >= 1 - alpha / 2, F.col("mu"))).alias("hi"),
        F.max_by("mu", "w").alias("map_mu"))


PAIR_BLOCKS = 16


def group_pairs(table: DataFrame, key: str) -> DataFrame:
    """All unordered pairs of the rows of a per-group table (k rows -> k(k-1)/2).

    Rows are dealt into blocks; every row goes once to each block of partners,
    and an equi-join on the pair of blocks meets each two rows in one task of
    ``PAIR_BLOCKS``^2. Columns: ``l`` and ``r`` structs with the table's columns,
    l.key < r.key; a NULL key pairs with nothing.
    """
    columns = [key, *[c for c in table.columns if c != key]]
    block = F.pmod(F.xxhash64(key), F.lit(PAIR_BLOCKS))
    partner = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PAIR_BLOCKS - 1).cast("long")))
    left = table.select(F.struct(*columns).alias("l"), block.alias("__a"), partner.alias("__b"))
    right = table.select(F.struct(*columns).alias("r"), block.alias("__b"), partner.alias("__a"))
    return left.join(right, ["__a", "__b"]).where(F.col(f"l.{key}") < F.col(f"r.{key}")).select("l", "r")


def intervals_overlap(intervals: DataFrame, key: str) -> DataFrame:
    """For every pair of groups, do the credible intervals overlap?"""
    p = group_pairs(intervals.select(key, "lo", "hi"), key)
    return p.select(F.col(f"l.{key}").alias("group1"), F.col(f"r.{key}").alias("group2"),
                    ((F.col("l.lo") <= F.col("r.hi")) & (F.col("r.lo") <= F.col("l.hi"))).alias("overlap"))


# ---- X16 mutual information -------------------------------------------------------------------

def mutual_information(df: DataFrame, features: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """Mutual information of each feature (equal-width binned) with the label, ranked.

    A binned plug-in estimator: sum p(x,y) ln(p(x,y) / (p(x) p(y))). The
    ranking, not the exact value, is comparable with nearest-neighbour
    estimators.
    """
    rng = df.agg(*[F.min(f).alias(f"mn_{f}") for f in features], *[F.max(f).alias(f"mx_{f}") for f in features])
    r = rng.select(F.struct("*")).scalar()
    binned = df.select(label, *[
        F.least(F.floor((F.col(f) - r[f"mn_{f}"]) / F.greatest(r[f"mx_{f}"] - r[f"mn_{f}"], F.lit(1e-300)) * bins),
                F.lit(bins - 1)).cast("int").alias(f) for f in features])
    long = binned.unpivot([label], list(features), "feature", "bin")
    joint = long.groupBy("feature", "bin", label).agg(F.count(F.lit(1)).alias("nxy"))
    wf = Window.partitionBy("feature")
    j = joint.withColumn("n", F.sum("nxy").over(wf)).withColumn(
        "nx", F.sum("nxy").over(Window.partitionBy("feature", "bin"))).withColumn(
        "ny", F.sum("nxy").over(Window.partitionBy("feature", label)))
    term = F.col("nxy") / F.col("n") * F.ln(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    mi = j.groupBy("feature").agg(F.sum(term).alias("mi"))
    return mi.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mi"), "feature")))


# ---- X17 - X20 regression and components --------------------------------------------------------

def simple_ols(df: DataFrame, y: str, x: str) -> DataFrame:
    """X17 (one predictor): slope, intercept, R^2, slope t and n from SQL aggregates."""
    out = df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                 F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"),
                 F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"))
    sse = F.greatest(F.lit(1.0) - F.col("r2"), F.lit(0.0)) * F.col("syy")
    se_slope = F.sqrt(F.try_divide(F.try_divide(sse, (F.col("n") - 2).cast("double")), F.col("sxx")))
    return out.select("slope", "intercept", "r2", "n", F.try_divide(F.col("slope"), se_slope).alias("t_slope"))


def ols(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """X17 (many predictors): ``LinearRegression(solver='normal')`` summary as a table
    (term, coefficient, se, t, p) plus r2 / adjusted r2 columns."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    data = VectorAssembler(inputCols=list(xs), outputCol="features").transform(df.select(y, *xs).na.drop())
    model = LinearRegression(featuresCol="features", labelCol=y, solver="normal").fit(data)
    s = model.summary
    terms = list(xs) + ["intercept"]
    coefs = list(model.coefficients) + [model.intercept]
    rows = [(t, float(c), float(se), float(tv), float(pv), float(s.r2), float(s.r2adj))
            for t, c, se, tv, pv in zip(terms, coefs, s.coefficientStandardErrors, s.tValues, s.pValues)]
    return df.sparkSession.createDataFrame(rows, "term string, coef double, se double, t double, p double, "
                                                 "r2 double, r2adj double")


def residual_mse(df: DataFrame, y: str, x: str) -> DataFrame:
    """Residuals of the one-predictor fit (scalar subquery), MSE with n denominator."""
    fit = df.agg(F.struct(F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a"))).scalar()
    pred = fit.a + fit.b * F.col(x)
    e = F.col(y) - pred
    return df.agg(F.avg(e * e).alias("mse"), F.var_pop(e).alias("var_resid"), F.var_pop(y).alias("var_y"),
                  F.var_pop(pred).alias("var_pred")).withColumn(
        "explained_variance", F.lit(1.0) - F.try_divide(F.col("var_resid"), F.col("var_y")))


def pca(df: DataFrame, vector_col: str, k: int):
    """Centred PCA. Returns (scores DataFrame, loadings DataFrame, explained DataFrame).

    ``ml.feature.PCA`` does not centre at transform time, so the column
    means (one ``Summarizer`` aggregate) are subtracted first.
    """
    from pyspark.ml.feature import PCA, StandardScaler

    # centring only (withStd=False): the column means come from one aggregate
    centred = StandardScaler(inputCol=vector_col, outputCol="__centred", withMean=True, withStd=False).fit(
        df).transform(df)
    model = PCA(k=k, inputCol="__centred", outputCol="scores").fit(centred)
    scores = model.transform(centred).drop("__centred")
    spark = df.sparkSession
    pc = model.pc.toArray()  # d x k, bounded by the feature count
    loadings = spark.createDataFrame(
        [(j, [float(v) for v in pc[:, j]]) for j in range(pc.shape[1])], "component int, weights array<double>")
    ev = [float(v) for v in model.explainedVariance]
    cum = [sum(ev[: i + 1]) for i in range(len(ev))]
    explained = spark.createDataFrame([(i, ev[i], cum[i]) for i in range(len(ev))],
                                      "component int, explained double, cumulative double")
    return scores, loadings, explained


def principal_component_regression(df: DataFrame, vector_col: str, y: str, k: int) -> DataFrame:
    """Regress ``y`` on the first ``k`` component scores."""
    from pyspark.ml.functions import vector_to_array

    scores, _, _ = pca(df, vector_col, k)
    cols = [f"pc{i + 1}" for i in range(k)]
    arr = vector_to_array("scores")
    flat = scores.select(F.col(y).cast("double").alias(y), *[arr[i].alias(c) for i, c in enumerate(cols)])
    return ols(flat, y, cols)


# ---- X21 profile -----------------------------------------------------------------------------------

def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column: type, count, missing, distinct, moments, min/max,
    median, top value and its frequency (two passes: moments, value counts)."""
    from pyspark.sql.types import NumericType

    cols = list(cols) if cols else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for c in cols:
        num = isinstance(types[c], NumericType)
        x = F.col(c).cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("column"), F.lit(types[c].simpleString()).alias("type"),
            F.count(F.col(c)).alias("count"), F.count_if(F.col(c).isNull()).alias("missing"),
            F.count_distinct(F.col(c)).alias("distinct"),
            (F.avg(x) if num else F.lit(None).cast("double")).alias("mean"),
            (F.stddev_samp(x) if num else F.lit(None).cast("double")).alias("std"),
            (F.min(x) if num else F.lit(None).cast("double")).alias("min"),
            (F.max(x) if num else F.lit(None).cast("double")).alias("max")).alias(c))
    wide = df.agg(*aggs)
    stats = wide.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("s")).select("s.*")
    numeric = [c for c in cols if isinstance(types[c], NumericType)]
    if numeric:
        stats = stats.join(group_quantiles(df, [], numeric, [0.25, 0.5, 0.75]), "column", "left")
    else:
        stats = stats.withColumn("q", F.lit(None).cast("array<double>"))
    quartiles = [F.get("q", F.lit(i)).alias(n) for i, n in enumerate(["q25", "median", "q75"])]
    stats = stats.select(*[c for c in stats.columns if c not in ("q", "max")], *quartiles, "max")
    from quarry.operators.reshape import top_values_report

    top = top_values_report(df, cols, 1).select("column", F.col("value").alias("top"), F.col("n").alias("top_freq"))
    return stats.join(top, "column", "left")


def profile_histograms(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """X21 histogram part: (column, bin, lo, hi, count) of every numeric column in one pass.

    Each column has ``bins`` equal parts of its own range (one aggregate); empty
    bins have no row, a constant column has one bin.
    """
    r = df.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in cols]).select(F.struct(*cols)).scalar()
    cells = []
    for c in cols:
        width = (r[c]["hi"] - r[c]["lo"]) / bins
        place = F.when(width == 0, 0).otherwise(F.least(F.floor(F.try_divide(F.col(c).cast("double") - r[c]["lo"], width)), F.lit(bins - 1)))
        cells.append(F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("column"), place.cast("int").alias("bin"), r[c]["lo"].alias("low"), width.alias("width"))))
    long = df.select(F.explode(F.array(*cells)).alias("c")).where("c IS NOT NULL").select("c.*")
    out = long.groupBy("column", "bin", "low", "width").agg(F.count(F.lit(1)).alias("count"))
    return out.select("column", "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("lo"),
                      (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("hi"), "count")


def correlation_warnings(df: DataFrame, cols: Sequence[str], threshold: float = 0.9) -> DataFrame:
    """X21 warning part: pairs of numeric columns with |Pearson r| above ``threshold``."""
    c = correlation_long(df, cols)
    return c.where((F.col("var1") < F.col("var2")) & (F.abs("corr") > threshold))
