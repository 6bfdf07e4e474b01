"""Statistics (X), chart data (C) and evaluation (E) queries with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog.features import bootstrap_sql
from quarry.catalog.registry import query, round_doubles
from quarry.functions import distributions as D
from quarry.functions.rounding import rnd, rnd_sql as R
from quarry.operators import charts as CH
from quarry.operators import evaluation as E
from quarry.operators import sampling as B
from quarry.operators import stats as X
from quarry.operators.ordering import hash_unit_sql
from quarry.operators.sampling import bootstrap_frequency_sql
from quarry.session import table

LI4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql(cols, src, wrap=lambda c: c):
    parts = []
    for a in cols:
        for b in cols:
            if a == b:
                parts.append(f"SELECT '{a}' AS var1, '{b}' AS var2, 1.0::DOUBLE AS corr")
            else:
                parts.append(f"SELECT '{a}' AS var1, '{b}' AS var2, {R(f'corr({wrap(a)}, {wrap(b)})')} AS corr FROM {src}")
    return " UNION ALL ".join(parts)


@query("x1_correlation", _corr_sql(LI4, "lineitem"))
def _x1(spark, sf):
    return X.correlation_long(table(spark, sf, "lineitem"), LI4).withColumn("corr", rnd("corr"))


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("x2_phi_coefficients", _corr_sql([f"p_type_{t}" for t in _TYPES], "part",
                                        lambda c: f"CAST(p_type = '{c[7:]}' AS DOUBLE)"))
def _x2(spark, sf):
    from quarry.operators.features import fit_levels, one_hot

    p = table(spark, sf, "part")
    d = one_hot(p.select("p_type"), "p_type", fit_levels(p, "p_type"))
    cols = [c for c in d.columns]
    return X.correlation_long(d.select(*[F.col(c).cast("double") for c in cols]), cols).withColumn("corr", rnd("corr"))


_SP = ["l_quantity", "l_extendedprice", "l_discount"]


@query("x3_spearman", "WITH r AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in _SP) +
    " FROM lineitem) " + _corr_sql(_SP, "r"))
def _x3(spark, sf):
    return X.correlation_long(table(spark, sf, "lineitem"), _SP, method="spearman").withColumn("corr", rnd("corr"))


_WELCH_VARS = ["l_quantity", "l_discount", "l_extendedprice"]


def _welch_sql():
    parts = []
    for v in _WELCH_VARS:
        parts.append(f"""SELECT '{v}' AS variable,
          count({v}) FILTER (WHERE l_returnflag = 'A') AS n1, count({v}) FILTER (WHERE l_returnflag = 'R') AS n2,
          avg({v}) FILTER (WHERE l_returnflag = 'A') AS m1, avg({v}) FILTER (WHERE l_returnflag = 'R') AS m2,
          var_samp({v}) FILTER (WHERE l_returnflag = 'A') AS v1, var_samp({v}) FILTER (WHERE l_returnflag = 'R') AS v2
          FROM lineitem""")
    body = " UNION ALL ".join(parts)
    return f"""WITH m AS ({body})
      SELECT variable, n1, n2, {R('m1')} AS mean1, {R('m2')} AS mean2, {R('sqrt(v1)')} AS sd1, {R('sqrt(v2)')} AS sd2,
        {R('(m1 - m2) / sqrt(v1 / n1 + v2 / n2)')} AS t,
        {R('pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1))', 4)} AS df FROM m"""


@query("x4_welch_t", _welch_sql())
def _x4(spark, sf):
    w = X.welch_t(table(spark, sf, "lineitem"), "l_returnflag", "A", "R", _WELCH_VARS)
    return round_doubles(w).withColumn("df", rnd("df", 4))


@query("x4_welch_t_pvalues")
def _x4p(spark, sf):
    return X.welch_t(table(spark, sf, "lineitem"), "l_returnflag", "A", "R", _WELCH_VARS, with_p=True)


_ANOVA_SQL = f"""WITH g AS (SELECT p_brand, count(*) AS n, avg(p_retailprice) AS m, var_samp(p_retailprice) AS v FROM part GROUP BY 1),
    t AS (SELECT sum(n) AS big_n, sum(n * m) / sum(n) AS grand, count(*) AS k FROM g),
    s AS (SELECT sum(n * pow(m - grand, 2)) AS ssb, sum((n - 1) * coalesce(v, 0)) AS ssw FROM g, t)
    SELECT k, CAST(big_n AS BIGINT) AS n, {R('ssb', 4)} AS ssb, {R('ssw', 4)} AS ssw, k - 1 AS df1, CAST(big_n - k AS BIGINT) AS df2,
      {R('(ssb / (k - 1)) / (ssw / (big_n - k))')} AS f FROM s, t"""


@query("x5_anova", _ANOVA_SQL)
def _x5(spark, sf):
    a = X.anova_oneway(table(spark, sf, "part"), "p_brand", "p_retailprice")
    return a.select("k", "n", rnd("ssb", 4).alias("ssb"), rnd("ssw", 4).alias("ssw"), "df1", "df2", rnd("f").alias("f"))


@query("x5_anova_pvalue")
def _x5p(spark, sf):
    return X.anova_oneway(table(spark, sf, "part"), "p_brand", "p_retailprice", with_p=True)


@query("x6_tukey_hsd", f"""WITH g AS (SELECT p_type, count(*) AS n, avg(p_retailprice) AS m, var_samp(p_retailprice) AS v FROM part GROUP BY 1),
    s AS (SELECT sum((n - 1) * coalesce(v, 0)) / (sum(n) - count(*)) AS msw, sum(n) - count(*) AS dfw, count(*) AS k FROM g)
    SELECT a.p_type AS group1, b.p_type AS group2, {R('b.m - a.m')} AS meandiff,
      {R('sqrt(msw / 2.0 * (1.0 / a.n + 1.0 / b.n))')} AS se,
      {R('abs(b.m - a.m) / sqrt(msw / 2.0 * (1.0 / a.n + 1.0 / b.n))')} AS q, k, CAST(dfw AS BIGINT) AS dfw
    FROM g a JOIN g b ON a.p_type < b.p_type, s""")
def _x6(spark, sf):
    return round_doubles(X.tukey_hsd(table(spark, sf, "part"), "p_type", "p_retailprice"))


@query("x6_tukey_hsd_pvalues")
def _x6p(spark, sf):
    return X.tukey_hsd(table(spark, sf, "part"), "p_type", "p_retailprice", with_p=True)


@query("x7_ks_normality")
def _x7(spark, sf):
    return X.ks_normal(table(spark, sf, "customer"), "c_acctbal")


@query("x8_ks_shifted_poisson", f"""WITH x AS (SELECT CAST(p_size AS BIGINT) AS x FROM part WHERE p_size IS NOT NULL),
    s AS (SELECT count(*) AS n, avg(x) AS m, max(x) AS mx FROM x),
    g AS (SELECT generate_series AS k FROM s, generate_series(0, s.mx - 1)),
    pm AS (SELECT k, exp(k * ln(m - 1) - (m - 1) - sum(CASE WHEN k > 0 THEN ln(k) ELSE 0 END) OVER (ORDER BY k)) AS pmf FROM g, s),
    cdf AS (SELECT k + 1 AS x, sum(pmf) OVER (ORDER BY k) AS cdf FROM pm),
    f AS (SELECT x, count(*) AS c FROM x GROUP BY x),
    e AS (SELECT x, c, sum(c) OVER (ORDER BY x) AS cum FROM f)
    SELECT {R('max(greatest(cum / n - coalesce(cdf, 1.0), coalesce(cdf, 1.0) - (cum - c) / n))')} AS d, n,
      {R('m - 1')} AS lam FROM e LEFT JOIN cdf USING (x), s GROUP BY n, m""")
def _x8(spark, sf):
    out = X.ks_shifted_poisson(table(spark, sf, "part"), "p_size")
    return out.select(rnd("d").alias("d"), "n", rnd("lam").alias("lam"))


@query("x9_ks_two_sample", f"""WITH x AS (SELECT o_totalprice AS v, o_orderstatus AS g FROM orders WHERE o_orderstatus IN ('F', 'O')),
    n AS (SELECT count(*) FILTER (WHERE g = 'F') AS na, count(*) FILTER (WHERE g = 'O') AS nb FROM x),
    st AS (SELECT v, count(*) FILTER (WHERE g = 'F') / na - count(*) FILTER (WHERE g = 'O') / nb AS step FROM x, n GROUP BY v, na, nb),
    c AS (SELECT sum(step) OVER (ORDER BY v) AS diff FROM st)
    SELECT {R('max(abs(diff))')} AS d, na AS n1, nb AS n2 FROM c, n GROUP BY na, nb""")
def _x9(spark, sf):
    out = X.ks_two_sample(table(spark, sf, "orders"), "o_totalprice", "o_orderstatus", "F", "O")
    return out.withColumn("d", rnd("d"))


def _wh(k, z):
    return f"({k} * pow(1 - 2 / (9.0 * {k}) + {z!r} * sqrt(2 / (9.0 * {k})), 3))"


@query("x10_mean_sd_intervals", f"""WITH m AS (SELECT count(l_extendedprice) AS n, avg(l_extendedprice) AS mean,
      stddev_samp(l_extendedprice) AS sd FROM lineitem)
    SELECT n, {R('mean')} AS mean, {R(f'mean - {X.Z975!r} * sd / sqrt(n)')} AS mean_lo, {R(f'mean + {X.Z975!r} * sd / sqrt(n)')} AS mean_hi,
      {R('sd')} AS sd, {R(f'sqrt((n - 1) * sd * sd / {_wh("(n - 1)", X.Z975)})')} AS sd_lo,
      {R(f'sqrt((n - 1) * sd * sd / {_wh("(n - 1)", -X.Z975)})')} AS sd_hi FROM m""")
def _x10(spark, sf):
    return round_doubles(X.mean_sd_intervals(table(spark, sf, "lineitem"), "l_extendedprice"))


@query("x11_bootstrap_ci", f"""WITH b AS ({bootstrap_sql('c_custkey', 'c_acctbal', 'customer', 200, 11).replace(R('sx / n'), 'sx / n').replace(R('sqrt(greatest((sxx - sx * sx / n) / (n - 1), 0))'), 'sqrt(greatest((sxx - sx * sx / n) / (n - 1), 0))')})
    SELECT {R('avg(mean)', 4)} AS mean_est, {R('quantile_cont(mean, 0.025)', 4)} AS mean_lo, {R('quantile_cont(mean, 0.975)', 4)} AS mean_hi,
      {R('avg(sd)', 4)} AS sd_est, {R('quantile_cont(sd, 0.025)', 4)} AS sd_lo, {R('quantile_cont(sd, 0.975)', 4)} AS sd_hi FROM b""")
def _x11(spark, sf):
    return round_doubles(X.bootstrap_ci(table(spark, sf, "customer"), "c_custkey", "c_acctbal", 200, seed=11), 4)


_BT_SRC = """(SELECT c_custkey, c_mktsegment, c_acctbal - avg(c_acctbal) OVER (PARTITION BY c_mktsegment)
      + (SELECT avg(c_acctbal) FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')) AS c_acctbal
      FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE'))"""


@query("x12_bootstrap_t_test", f"""WITH g AS (SELECT c_mktsegment, count(*) AS n, avg(c_acctbal) AS m, var_samp(c_acctbal) AS v
      FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE') GROUP BY 1),
    o AS (SELECT (max(m) FILTER (WHERE c_mktsegment = 'BUILDING') - max(m) FILTER (WHERE c_mktsegment = 'AUTOMOBILE'))
      / sqrt(max(v / n) FILTER (WHERE c_mktsegment = 'BUILDING') + max(v / n) FILTER (WHERE c_mktsegment = 'AUTOMOBILE')) AS t FROM g),
    b AS ({bootstrap_sql('c_custkey', 'c_acctbal', _BT_SRC, 200, 13, by='c_mktsegment').replace(R('sx / n'), 'sx / n').replace(R('sqrt(greatest((sxx - sx * sx / n) / (n - 1), 0))'), 'sqrt(greatest((sxx - sx * sx / n) / (n - 1), 0))')}),
    p AS (SELECT rep, (max(mean) FILTER (WHERE c_mktsegment = 'BUILDING') - max(mean) FILTER (WHERE c_mktsegment = 'AUTOMOBILE'))
      / sqrt(max(sd * sd / n) FILTER (WHERE c_mktsegment = 'BUILDING') + max(sd * sd / n) FILTER (WHERE c_mktsegment = 'AUTOMOBILE')) AS ts FROM b GROUP BY rep)
    SELECT {R('max(t)')} AS t_obs, {R('avg(CAST(abs(ts) >= abs(t) AS DOUBLE))')} AS p, count(*) AS replicates FROM p, o""")
def _x12(spark, sf):
    out = X.bootstrap_t_test(table(spark, sf, "customer"), "c_custkey", "c_acctbal", "c_mktsegment", "BUILDING",
                             "AUTOMOBILE", 200, seed=13)
    return out.select(rnd("t_obs").alias("t_obs"), rnd("p").alias("p"), "replicates")


@query("x13_grid_posterior", f"""WITH s AS (SELECT count(l_quantity) AS n, sum(l_quantity) AS sx, sum(l_quantity * l_quantity) AS sxx,
      avg(l_quantity) AS m, stddev_samp(l_quantity) AS sd FROM lineitem),
    g AS (SELECT m - 5 * sd / sqrt(n) + floor(range / 1001) * (2 * 5 * sd / sqrt(n) / 1000) AS mu,
      sd - sd * 5 / sqrt(2 * n) + (range % 1001) * (2 * (sd * 5 / sqrt(2 * n)) / 1000) AS sigma, n, sx, sxx FROM range(1002001), s),
    l AS (SELECT mu, sigma, -n * ln(sigma) - (sxx - 2 * mu * sx + n * mu * mu) / (2 * sigma * sigma) AS ll FROM g),
    w AS (SELECT mu, sigma, ll, exp(ll - (SELECT max(ll) FROM l)) AS w FROM l)
    SELECT {R('arg_max(mu, ll)')} AS map_mu, {R('arg_max(sigma, ll)')} AS map_sigma, {R('max(w) / sum(w)', 9)} AS map_mass,
      {R('sum(w * mu) / sum(w)')} AS post_mu, {R('sum(w * sigma) / sum(w)')} AS post_sigma FROM w""")
def _x13(spark, sf):
    out = X.grid_posterior_mu_sigma(table(spark, sf, "lineitem"), "l_quantity")
    return out.select(rnd("map_mu").alias("map_mu"), rnd("map_sigma").alias("map_sigma"),
                      rnd("map_mass", 9).alias("map_mass"), rnd("post_mu").alias("post_mu"),
                      rnd("post_sigma").alias("post_sigma"))


def _posterior_sql(by: str | None):
    by_sel = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""WITH s AS (SELECT {by_sel}count(l_quantity) AS n, avg(l_quantity) AS m, stddev_samp(l_quantity) AS sd FROM lineitem {grp}),
      g AS (SELECT {by_sel}i, m - 5 * sd / sqrt(n) + i * (2 * 5 * sd / sqrt(n) / 1000) AS mu, m, sd / sqrt(n) AS se
        FROM s, generate_series(0, 1000) AS t(i)),
      w AS (SELECT {by_sel}i, mu, exp(-pow(mu - m, 2) / (2 * se * se)) AS w FROM g),
      c AS (SELECT {by_sel}mu, w, sum(w) OVER ({part} ORDER BY i ROWS UNBOUNDED PRECEDING) / sum(w) OVER ({part}) AS cdf FROM w)
      SELECT {by_sel}max(mu) FILTER (WHERE cdf <= 0.025) AS lo, min(mu) FILTER (WHERE cdf >= 0.975) AS hi,
        arg_max(mu, w) AS map_mu FROM c {grp}"""


@query("x14_posterior_interval", f"SELECT {R('lo')} AS lo, {R('hi')} AS hi, {R('map_mu')} AS map_mu FROM ({_posterior_sql(None)})")
def _x14(spark, sf):
    return round_doubles(X.posterior_mu_interval(table(spark, sf, "lineitem"), "l_quantity"))


@query("x15_posterior_groups_overlap", f"""WITH iv AS ({_posterior_sql('l_returnflag')})
    SELECT a.l_returnflag AS group1, b.l_returnflag AS group2, (a.lo <= b.hi AND b.lo <= a.hi) AS overlap
    FROM iv a JOIN iv b ON a.l_returnflag < b.l_returnflag""")
def _x15(spark, sf):
    iv = X.posterior_mu_interval(table(spark, sf, "lineitem"), "l_quantity", by=["l_returnflag"])
    return X.intervals_overlap(iv, "l_returnflag")


def _mi_sql(feats, label, bins=10, src="lineitem"):
    rng = ", ".join(f"min({f}) AS mn_{f}, max({f}) AS mx_{f}" for f in feats)
    binned = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST(least(floor(({f} - mn_{f}) / greatest(mx_{f} - mn_{f}, 1e-300) * {bins}), {bins - 1}) AS INTEGER)"
        f" AS bin, {label} AS y FROM {src}, r" for f in feats)
    return f"""WITH r AS (SELECT {rng} FROM {src}), b AS ({binned}),
      j AS (SELECT feature, bin, y, count(*) AS nxy FROM b GROUP BY ALL),
      m AS (SELECT *, sum(nxy) OVER (PARTITION BY feature) AS n, sum(nxy) OVER (PARTITION BY feature, bin) AS nx,
        sum(nxy) OVER (PARTITION BY feature, y) AS ny FROM j),
      mi AS (SELECT feature, sum(nxy / n * ln(nxy * n / (nx * ny))) AS mi FROM m GROUP BY feature)
      SELECT feature, {R('mi', 9)} AS mi, CAST(row_number() OVER (ORDER BY mi DESC, feature) AS INTEGER) AS rank FROM mi"""


@query("x16_mutual_information", _mi_sql(LI4, "l_returnflag"))
def _x16(spark, sf):
    out = X.mutual_information(table(spark, sf, "lineitem"), LI4, "l_returnflag")
    return out.withColumn("mi", rnd("mi", 9))


@query("x17_simple_ols", f"""SELECT {R('regr_slope(l_extendedprice, l_quantity)')} AS slope,
    {R('regr_intercept(l_extendedprice, l_quantity)', 4)} AS intercept, {R('regr_r2(l_extendedprice, l_quantity)')} AS r2,
    CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n,
    {R('regr_slope(l_extendedprice, l_quantity) / sqrt((1 - regr_r2(l_extendedprice, l_quantity)) * regr_syy(l_extendedprice, l_quantity) / (regr_count(l_extendedprice, l_quantity) - 2) / regr_sxx(l_extendedprice, l_quantity))', 4)} AS t_slope
    FROM lineitem""")
def _x17(spark, sf):
    o = X.simple_ols(table(spark, sf, "lineitem"), "l_extendedprice", "l_quantity")
    return o.select(rnd("slope").alias("slope"), rnd("intercept", 4).alias("intercept"), rnd("r2").alias("r2"), "n",
                    rnd("t_slope", 4).alias("t_slope"))


@query("x17_multiple_ols")
def _x17m(spark, sf):
    return X.ols(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])


_FIT = ("(SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)")


@query("x18_residual_mse", f"""WITH p AS (SELECT l_extendedprice AS y, a + b * l_quantity AS yhat FROM lineitem, {_FIT})
    SELECT {R('avg(pow(y - yhat, 2))', 2)} AS mse, {R('var_pop(y - yhat)', 2)} AS var_resid, {R('var_pop(y)', 2)} AS var_y,
      {R('var_pop(yhat)', 2)} AS var_pred, {R('1 - var_pop(y - yhat) / var_pop(y)')} AS explained_variance FROM p""")
def _x18(spark, sf):
    m = X.residual_mse(table(spark, sf, "lineitem"), "l_extendedprice", "l_quantity")
    return m.select(rnd("mse", 2).alias("mse"), rnd("var_resid", 2).alias("var_resid"), rnd("var_y", 2).alias("var_y"),
                    rnd("var_pred", 2).alias("var_pred"), rnd("explained_variance").alias("explained_variance"))


def _embeddings(spark, sf):
    from pyspark.ml.functions import array_to_vector

    e = table(spark, sf, "embeddings")
    return e.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))


@query("x19_pca_explained")
def _x19(spark, sf):
    _, _, explained = X.pca(_embeddings(spark, sf), "v", 8)
    return explained


@query("o3_component_top_contributors")
def _o3(spark, sf):
    from quarry.operators.windows import top_contributors

    _, loadings, _ = X.pca(_embeddings(spark, sf), "v", 4)
    return top_contributors(loadings, "component", "weights", [f"dim{i}" for i in range(64)], 5)


@query("x20_principal_component_regression")
def _x20(spark, sf):
    return X.principal_component_regression(_embeddings(spark, sf), "v", "label", 4)


_PROF_COLS = ["o_orderstatus", "o_orderpriority", "o_custkey", "o_totalprice"]


def _profile_sql():
    parts = []
    for c in _PROF_COLS:
        num = c in ("o_custkey", "o_totalprice")
        typ = {"o_custkey": "bigint", "o_totalprice": "double"}.get(c, "string")
        stats = (f"{R(f'avg(CAST({c} AS DOUBLE))', 4)}, {R(f'stddev_samp(CAST({c} AS DOUBLE))', 4)}, "
                 f"CAST(min({c}) AS DOUBLE), {R(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)', 4)}, {R(f'median(CAST({c} AS DOUBLE))', 4)}, "
                 f"{R(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)', 4)}, CAST(max({c}) AS DOUBLE)") if num else \
            "NULL, NULL, NULL, NULL, NULL, NULL, NULL"
        parts.append(f"""SELECT '{c}' AS "column", '{typ}' AS type, count({c}) AS count, count(*) FILTER (WHERE {c} IS NULL) AS missing,
          count(DISTINCT {c}) AS "distinct", {stats},
          (SELECT CAST({c} AS VARCHAR) FROM orders GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) NULLS LAST LIMIT 1) AS top,
          (SELECT count(*) FROM orders GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS top_freq FROM orders""")
    u = " UNION ALL ".join(parts)
    return (f'SELECT "column", type, count, missing, "distinct", col5 AS mean, col6 AS std, col7 AS min, c_q25 AS q25, '
            f'col8 AS median, c_q75 AS q75, col9 AS max, top, top_freq FROM ({u}) AS t("column", type, count, missing, '
            f'"distinct", col5, col6, col7, c_q25, col8, c_q75, col9, top, top_freq)')


@query("x21_profile", _profile_sql())
def _x21(spark, sf):
    p = X.profile(table(spark, sf, "orders"), _PROF_COLS)
    return p.select("column", "type", "count", "missing", "distinct", rnd("mean", 4).alias("mean"),
                    rnd("std", 4).alias("std"), "min", rnd("q25", 4).alias("q25"), rnd("median", 4).alias("median"),
                    rnd("q75", 4).alias("q75"), "max", "top", "top_freq")


_WARN_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "revenue"]


@query("x21_correlation_warnings", "WITH li AS (SELECT *, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem) "
       "SELECT * FROM (" + " UNION ALL ".join(
           f"SELECT '{a}' AS var1, '{b}' AS var2, {R(f'corr({a}, {b})')} AS corr FROM li"
           for a in _WARN_COLS for b in _WARN_COLS if a < b) + ") WHERE abs(corr) > 0.9")
def _x21w(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("revenue", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return X.correlation_warnings(li, _WARN_COLS, 0.9).withColumn("corr", rnd("corr"))


# ---- C: chart data ---------------------------------------------------------------------

@query("c1_histogram", f"""WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(l_extendedprice) AS n FROM lineitem),
    b AS (SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin FROM lineitem, r)
    SELECT bin, {R('lo + bin * ((hi - lo) / 20)', 4)} AS lo, {R('lo + (bin + 1) * ((hi - lo) / 20)', 4)} AS hi, count(*) AS count,
      {R('count(*) / (n * ((hi - lo) / 20))', 12)} AS density FROM b, r GROUP BY bin, lo, hi, n""")
def _c1(spark, sf):
    h = CH.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 20)
    return h.select("bin", rnd("lo", 4).alias("lo"), rnd("hi", 4).alias("hi"), "count", rnd("density", 12).alias("density"))


@query("c2_box_stats", f"""WITH q AS (SELECT p_type, quantile_cont(p_retailprice, 0.25) AS q1, quantile_cont(p_retailprice, 0.5) AS median,
      quantile_cont(p_retailprice, 0.75) AS q3 FROM part GROUP BY 1),
    j AS (SELECT p.p_type, p_retailprice AS v, q1, median, q3, (p_retailprice >= q1 - 1.5 * (q3 - q1) AND p_retailprice <= q3 + 1.5 * (q3 - q1)) AS inside
      FROM part p JOIN q USING (p_type))
    SELECT p_type, {R('q1')} AS q1, {R('median')} AS median, {R('q3')} AS q3, min(v) FILTER (WHERE inside) AS whisker_lo,
      max(v) FILTER (WHERE inside) AS whisker_hi, count(*) FILTER (WHERE NOT inside) AS n_outliers, count(v) AS n FROM j
    GROUP BY p_type, q1, median, q3""")
def _c2(spark, sf):
    return round_doubles(CH.box_stats(table(spark, sf, "part"), "p_type", "p_retailprice"))


@query("c3_grid_counts", """WITH r AS (SELECT min(l_quantity) AS x0, max(l_quantity) AS x1, min(l_extendedprice) AS y0, max(l_extendedprice) AS y1 FROM lineitem)
    SELECT CAST(least(floor((l_quantity - x0) / ((x1 - x0) / 10)), 9) AS INTEGER) AS bx,
      CAST(least(floor((l_extendedprice - y0) / ((y1 - y0) / 10)), 9) AS INTEGER) AS "by", count(*) AS count FROM lineitem, r GROUP BY 1, 2""")
def _c3(spark, sf):
    return CH.grid_counts(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 10)


_QQ_P = [(i - 0.5) / 100 for i in range(1, 101)]
_QQ_Z = [D.normal_ppf(p) for p in _QQ_P]


@query("c4_qq_points", f"""WITH s AS (SELECT quantile_cont(c_acctbal, CAST({_QQ_P!r} AS DOUBLE[])) AS q, avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS sd FROM customer),
    z AS (SELECT unnest(CAST({_QQ_Z!r} AS DOUBLE[])) AS theoretical, unnest(range(100)) AS i)
    SELECT CAST(i AS INTEGER) AS i, {R('theoretical')} AS theoretical, {R('q[i + 1]', 3)} AS sample, {R('m + sd * theoretical', 2)} AS line FROM z, s""")
def _c4(spark, sf):
    q = CH.qq_points(table(spark, sf, "customer"), "c_acctbal")
    return q.select("i", rnd("theoretical").alias("theoretical"), rnd("sample", 3).alias("sample"), rnd("line", 2).alias("line"))


@query("c5_bars", f"""SELECT o_orderstatus, o_orderpriority, {R('avg(o_totalprice)', 4)} AS mean, count(*) AS count FROM orders GROUP BY 1, 2""")
def _c5(spark, sf):
    b = CH.bars(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", "o_totalprice")
    return b.withColumn("mean", rnd("mean", 4))


@query("c6_kde", f"""WITH g AS (SELECT l_returnflag, min(l_quantity) AS lo, max(l_quantity) AS hi, stddev_samp(l_quantity) AS sd,
      count(l_quantity) AS n FROM lineitem GROUP BY 1),
    v AS (SELECT l_returnflag, lo + (least(floor((l_quantity - lo) / ((hi - lo) / 1024)), 1023) + 0.5) * (hi - lo) / 1024 AS centre,
      count(*) AS c FROM lineitem JOIN g USING (l_returnflag) GROUP BY l_returnflag, least(floor((l_quantity - lo) / ((hi - lo) / 1024)), 1023), lo, hi),
    gg AS (SELECT l_returnflag, i, lo + i * (hi - lo) / 63 AS x, sd * pow(n, -0.2) AS h, n FROM g, generate_series(0, 63) AS t(i))
    SELECT gg.l_returnflag, CAST(i AS INTEGER) AS i, {R('x', 4)} AS x, {R('sum(c * exp(-0.5 * pow((x - centre) / h, 2))) / (n * h * 2.5066282746310002)', 9)} AS density
    FROM gg JOIN v USING (l_returnflag) GROUP BY gg.l_returnflag, i, x, n, h""")
def _c6(spark, sf):
    k = CH.kde(table(spark, sf, "lineitem"), "l_quantity", "l_returnflag")
    return k.select("l_returnflag", F.col("i").cast("int").alias("i"), rnd("x", 4).alias("x"), rnd("density", 9).alias("density"))


@query("c7_scatter_sample", f"""SELECT o_orderkey, o_totalprice, CAST(o_totalprice > 400000 AS INTEGER) AS highlight FROM orders
    WHERE {hash_unit_sql('o_orderkey', 21)} < 0.05""")
def _c7(spark, sf):
    return CH.scatter_sample(table(spark, sf, "orders"), "o_orderkey", ["o_totalprice"], 0.05,
                             F.col("o_totalprice") > 400000, seed=21)


@query("c8_time_series", f"""SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS t, count(*) AS n, {R('avg(value)')} AS mean_value
    FROM events GROUP BY 1, 2""")
def _c8(spark, sf):
    ts = CH.time_series(table(spark, sf, "events"), "event_type", F.to_date("ts").cast("string"), ["value"])
    return ts.withColumn("mean_value", rnd("mean_value"))


@query("c9_fitted_line", f"""WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a,
      min(l_quantity) AS x0, max(l_quantity) AS x1 FROM lineitem)
    SELECT x0 AS x, {R('a + b * x0', 4)} AS y FROM f UNION ALL SELECT x1, {R('a + b * x1', 4)} FROM f""")
def _c9(spark, sf):
    return CH.fitted_line(table(spark, sf, "lineitem"), "l_extendedprice", "l_quantity").withColumn("y", rnd("y", 4))


# ---- E: evaluation (scores from documents, labels from labels) -----------------------------

def scored(spark, sf):
    """labels x documents: y = quality, score = n_chars, pred = n_chars >= 1000."""
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    doc = table(spark, sf, "documents").select("doc_id", F.col("n_chars").alias("score"),
                                               F.size(F.split("text", r"\s+")).alias("words"))
    return lab.join(doc, "doc_id").withColumn("pred", (F.col("score") >= 1000).cast("int"))


_SCORED = """(SELECT l.doc_id, quality AS y, n_chars AS score, len(string_split_regex(text, '\\s+')) AS words,
    CAST(n_chars >= 1000 AS INTEGER) AS pred FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


@query("e1_accuracy", f"SELECT {R('avg(CAST(y = pred AS DOUBLE))')} AS accuracy, count(*) AS n FROM {_SCORED}")
def _e1(spark, sf):
    return E.accuracy(scored(spark, sf), "y", "pred").withColumn("accuracy", rnd("accuracy"))


@query("e2_confusion_matrix", f"""SELECT y AS actual, pred AS predicted, count(*) AS n, {R('count(*) / sum(count(*)) OVER ()')} AS share,
    {R('100.0 * count(*) / sum(count(*)) OVER (PARTITION BY y)')} AS row_pct FROM {_SCORED} GROUP BY y, pred""")
def _e2(spark, sf):
    return round_doubles(E.confusion(scored(spark, sf), "y", "pred"))


@query("e3_binary_metrics", f"""WITH c AS (SELECT count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y <> 1 AND pred = 1) AS fp,
      count(*) FILTER (WHERE y <> 1 AND pred <> 1) AS tn, count(*) FILTER (WHERE y = 1 AND pred <> 1) AS fn FROM {_SCORED})
    SELECT tp, fp, tn, fn, {R('tp / (tp + fn)')} AS sensitivity, {R('tn / (tn + fp)')} AS specificity, {R('tp / (tp + fp)')} AS precision,
      {R('2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn)))')} AS f1,
      {R('(tp + tn) / (tp + tn + fp + fn)')} AS accuracy FROM c""")
def _e3(spark, sf):
    return round_doubles(E.binary_metrics(scored(spark, sf), "y", "pred"))


_ROC_SQL = f"""WITH per AS (SELECT score AS threshold, sum(CAST(y = 1 AS BIGINT)) AS pos, sum(1 - CAST(y = 1 AS BIGINT)) AS neg FROM {_SCORED} GROUP BY 1),
    c AS (SELECT threshold, CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp, CAST(sum(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp,
      sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM per)"""


@query("e4_roc_table", _ROC_SQL + f" SELECT threshold, tp, fp, {R('fp / N')} AS fpr, {R('tp / P')} AS tpr FROM c")
def _e4(spark, sf):
    return round_doubles(E.roc_table(scored(spark, sf), "y", "score"))


@query("e5_auc", f"""WITH r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM {_SCORED})
    SELECT {R('(sum(rk) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2) / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y <> 1))')} AS auc FROM r""")
def _e5(spark, sf):
    return E.auc(scored(spark, sf), "y", "score").withColumn("auc", rnd("auc"))


@query("e6_best_thresholds", _ROC_SQL + f""", r AS (SELECT threshold, tp / P AS tpr, 1 - fp / N AS spec FROM c),
    b AS (SELECT * FROM r ORDER BY tpr + spec DESC, threshold DESC LIMIT 1),
    hs AS (SELECT * FROM r WHERE tpr >= 0.85 AND spec >= 0.5 ORDER BY tpr DESC LIMIT 1),
    hp AS (SELECT * FROM r WHERE tpr >= 0.85 AND spec >= 0.5 ORDER BY spec DESC LIMIT 1)
    SELECT b.threshold AS best_threshold, {R('b.tpr')} AS best_sensitivity, {R('b.spec')} AS best_specificity,
      hs.threshold AS hi_sens_threshold, {R('hs.tpr')} AS hi_sens_sensitivity, {R('hs.spec')} AS hi_sens_specificity,
      hp.threshold AS hi_spec_threshold, {R('hp.tpr')} AS hi_spec_sensitivity, {R('hp.spec')} AS hi_spec_specificity
    FROM b LEFT JOIN hs ON true LEFT JOIN hp ON true""")
def _e6(spark, sf):
    return round_doubles(E.best_thresholds(E.roc_table(scored(spark, sf), "y", "score")))


@query("e7_regression_metrics", f"""WITH p AS (SELECT l_extendedprice AS y, l_quantity * (SELECT sum(l_extendedprice) / sum(l_quantity) FROM lineitem) AS yhat FROM lineitem)
    SELECT {R('avg(pow(y - yhat, 2))', 2)} AS mse, {R('1 - var_pop(y - yhat) / var_pop(y)')} AS explained_variance,
      {R('var_pop(yhat)', 2)} AS var_pred, {R('var_pop(y)', 2)} AS var_label FROM p""")
def _e7(spark, sf):
    li = table(spark, sf, "lineitem")
    unit = li.agg(F.sum("l_extendedprice") / F.sum("l_quantity")).scalar()
    m = E.regression_metrics(li.withColumn("yhat", F.col("l_quantity") * unit), "l_extendedprice", "yhat")
    return m.select(rnd("mse", 2).alias("mse"), rnd("explained_variance").alias("explained_variance"),
                    rnd("var_pred", 2).alias("var_pred"), rnd("var_label", 2).alias("var_label"))


def _auc_sql(score):
    return f"""(SELECT (sum(rk) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2)
      / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y <> 1)) FROM
      (SELECT y, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS rk FROM {_SCORED}))"""


@query("e8_model_comparison", f"""SELECT 'chars' AS model, 'auc' AS metric, {R(_auc_sql('score'))} AS value
    UNION ALL SELECT 'words', 'auc', {R(_auc_sql('words'))}
    UNION ALL SELECT 'chars', 'accuracy', {R('(SELECT avg(CAST(y = pred AS DOUBLE)) FROM ' + _SCORED + ')')}
    UNION ALL SELECT 'words', 'accuracy', {R('(SELECT avg(CAST(y = CAST(words >= 150 AS INTEGER) AS DOUBLE)) FROM ' + _SCORED + ')')}""")
def _e8(spark, sf):
    s = scored(spark, sf)
    a1 = E.auc(s, "y", "score")
    a2 = E.auc(s, "y", "words")
    acc1 = E.accuracy(s, "y", "pred").select("accuracy")
    acc2 = E.accuracy(s.withColumn("pw", (F.col("words") >= 150).cast("int")), "y", "pw").select("accuracy")
    t = E.comparison_table({"chars": a1, "words": a2}).unionByName(
        E.comparison_table({"chars": acc1, "words": acc2}))
    return t.withColumn("value", rnd("value"))


# ---- X2, B5, X11, X12 from frequency tables ------------------------------------------------------

_PHI = ["l_returnflag", "l_linestatus", "l_linenumber"]


def _phi_sql():
    parts = []
    for i, x in enumerate(_PHI):
        for y in _PHI[i + 1:]:
            parts.append(f"""SELECT '{x}' AS var1, CAST(a.v AS VARCHAR) AS level1, '{y}' AS var2, CAST(b.v AS VARCHAR) AS level2, count(*) FILTER (WHERE {x} = a.v AND {y} = b.v) AS n,
              corr(CAST({x} = a.v AS INTEGER), CAST({y} = b.v AS INTEGER)) AS phi
              FROM lineitem, (SELECT DISTINCT {x} AS v FROM lineitem) a, (SELECT DISTINCT {y} AS v FROM lineitem) b GROUP BY a.v, b.v HAVING count(*) FILTER (WHERE {x} = a.v AND {y} = b.v) > 0""")
    return f"SELECT var1, level1, var2, level2, n, {R('phi')} AS phi FROM ({' UNION ALL '.join(parts)})"


@query("x2_phi_of_levels", _phi_sql())
def _x2_levels(spark, sf):
    return X.phi_coefficients(table(spark, sf, "lineitem"), _PHI).withColumn("phi", rnd("phi"))


def _qty():
    return F.col("__v").cast("int").cast("string")

_FREQ_SQL = bootstrap_frequency_sql("lineitem", "l_quantity", "CAST(l_quantity AS INTEGER)", 1000, 19, ["l_returnflag"])


@query("b5_bootstrap_frequencies", f"""SELECT l_returnflag, CAST(rep AS INTEGER) AS rep, CAST(n AS BIGINT) AS n, {R('mean')} AS mean, {R('sd', 5)} AS sd FROM ({_FREQ_SQL})""")
def _b5_frequencies(spark, sf):
    b = B.bootstrap_frequency_moments(table(spark, sf, "lineitem"), "l_quantity", 1000, 19, ["l_returnflag"], key=_qty())
    return b.withColumns({"mean": rnd("mean"), "sd": rnd("sd", 5)})


@query("x11_bootstrap_ci_10000", f"""WITH b AS ({bootstrap_frequency_sql('lineitem', 'l_quantity', 'CAST(l_quantity AS INTEGER)', 10000, 23)})
    SELECT count(*) AS replicates, {', '.join(f"{R(f'avg({c})', 5)} AS {c}_est, {R(f'quantile_cont({c}, 0.025)', 5)} AS {c}_lo, {R(f'quantile_cont({c}, 0.975)', 5)} AS {c}_hi" for c in ('mean', 'sd'))} FROM b""")
def _x11_many(spark, sf):
    return round_doubles(X.bootstrap_frequency_ci(table(spark, sf, "lineitem"), "l_quantity", 10000, 23, key=_qty()), 5)


@query("x12_bootstrap_t_10000", f"""WITH b AS ({bootstrap_frequency_sql("(SELECT * FROM lineitem WHERE l_returnflag IN ('A', 'R'))", 'l_quantity', 'CAST(l_quantity AS INTEGER)', 10000, 29, ['l_returnflag'])}),
    g AS (SELECT l_returnflag AS f, count(*) AS n, avg(l_quantity) AS m, var_samp(l_quantity) AS v FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1),
    o AS (SELECT a.m - b.m AS gap, (a.m - b.m) / sqrt(a.v / a.n + b.v / b.n) AS t FROM g a, g b WHERE a.f = 'A' AND b.f = 'R'),
    s AS (SELECT x.rep, (x.mean - y.mean - gap) / sqrt(x.sd * x.sd / x.n + y.sd * y.sd / y.n) AS ts FROM b x JOIN b y ON x.rep = y.rep AND x.l_returnflag = 'A' AND y.l_returnflag = 'R', o)
    SELECT {R('any_value(t)')} AS t_obs, {R('avg(CASE WHEN abs(ts) >= abs(t) THEN 1.0 ELSE 0.0 END)')} AS p, count(*) AS replicates FROM s, o""")
def _x12_many(spark, sf):
    return round_doubles(X.bootstrap_frequency_t_test(table(spark, sf, "lineitem"), "l_quantity", "l_returnflag", "A", "R", 10000, 29, key=_qty()))


_HIST = ["l_quantity", "l_extendedprice", "l_discount"]


@query("x21_profile_histograms", " UNION ALL ".join(f"""SELECT '{c}' AS "column", CAST(least(floor(({c} - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin,
      {R('lo + bin * ((hi - lo) / 10)', 4)} AS lo, {R('lo + (bin + 1) * ((hi - lo) / 10)', 4)} AS hi, count(*) AS count
      FROM lineitem, (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM lineitem) r GROUP BY ALL""" for c in _HIST))
def _x21_histograms(spark, sf):
    h = X.profile_histograms(table(spark, sf, "lineitem"), _HIST)
    return h.withColumns({"lo": rnd("lo", 4), "hi": rnd("hi", 4)})


@query("w5_rank_of_all_rows", "SELECT o_orderkey, CAST(rank() OVER (ORDER BY o_orderpriority DESC, o_orderdate) AS INTEGER) AS rank FROM orders")
def _w5_all(spark, sf):
    from quarry.operators.windows import global_rank

    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return global_rank(o, [("o_orderpriority", False), ("o_orderdate", True)]).select("o_orderkey", "rank")
