"""Native p-values, moments, trees and validation: against other code, and on degenerate data."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from quarry.functions import distributions as D
from quarry.functions import special as S
from quarry.operators import charts as CH
from quarry.operators import crossval as C
from quarry.operators import features as T
from quarry.operators import gram as G
from quarry.operators import joins as J
from quarry.operators import nulls as N
from quarry.operators import reshape as RS
from quarry.operators import sampling as B
from quarry.operators import stats as X
from quarry.operators import trees
from quarry.session import table
from quarry.sources import delimited


def test_special_functions_against_other_code(spark):
    d = spark.createDataFrame([(0.1, 3.0), (2.0, 7.5), (2.0, 15000.3), (5.0, 1.0), (40.0, 30.0), (0.0, 4.0)], "t double, df double")
    for r in d.select("*", S.t_two_sided("t", "df").alias("p")).collect():
        assert r.p == pytest.approx(D.t_sf_two_sided(r.t, r.df), rel=1e-9)
    d = spark.createDataFrame([(1.5, 4.0, 1000.0), (0.3, 2.0, 10.0), (8.0, 1.0, 50000.0)], "f double, a double, b double")
    for r in d.select("*", S.f_upper("f", "a", "b").alias("p")).collect():
        assert r.p == pytest.approx(D.f_sf(r.f, r.a, r.b), rel=1e-9)
    d = spark.createDataFrame([(k,) for k in (1.0, 2.0, 5.0, 30.0, 1000.0, 60000.0)], "k double")
    for r in d.select("*", S.chi2_quantile(0.025, "k").alias("a"), S.chi2_quantile(0.975, "k").alias("b")).collect():
        assert r.a == pytest.approx(D.chi2_ppf(0.025, r.k), rel=1e-8) and r.b == pytest.approx(D.chi2_ppf(0.975, r.k), rel=1e-8)
    d = spark.createDataFrame([(x,) for x in (-9.0, -3.0, -0.5, 0.0, 1.96, 7.2)], "x double")
    for r in d.select("*", S.normal_cdf("x").alias("p"), S.ln_gamma(F.abs("x") + 0.3).alias("g")).collect():
        assert r.p == pytest.approx(0.5 * math.erfc(-r.x / math.sqrt(2)), rel=1e-7, abs=1e-16)
        assert r.g == pytest.approx(math.lgamma(abs(r.x) + 0.3), abs=1e-12)
    d = spark.createDataFrame([(3, 2.5), (0, 2.5), (-1, 2.5), (40, 25.0), (5, 0.0)], "k int, m double")
    for r in d.select("*", S.poisson_cdf(F.col("k"), F.col("m")).alias("p")).collect():
        want = sum(math.exp(-r.m) * r.m**i / math.factorial(i) for i in range(r.k + 1))
        assert r.p == pytest.approx(want, abs=1e-12)


def test_arguments_outside_the_domain_give_null(spark):
    d = spark.createDataFrame([(None, 3.0), (1.0, 0.0), (1.0, None)], "t double, df double")
    assert [r[0] for r in d.select(S.t_two_sided("t", "df")).collect()] == [None] * 3
    assert [r[0] for r in d.select(S.f_upper("t", "df", "df")).collect()] == [None] * 3
    assert d.select(S.chi2_quantile(0.5, F.col("df") - 3.0)).first()[0] is None


def test_range_distribution_of_two_groups_is_students_t(spark):
    d = spark.createDataFrame([(1.0, 2, 2), (3.0, 2, 7), (4.5, 2, 5000)], "q double, k int, dfw int")
    for r in X._range_cdf(d, "q", ["q", "k", "dfw"]).collect():
        assert 1 - r["cdf"] == pytest.approx(D.t_sf_two_sided(r.q / math.sqrt(2), r.dfw), abs=1e-9)
    crit = X.range_quantiles(d, 0.95).collect()
    for r in crit:
        assert D.t_sf_two_sided(r.crit / math.sqrt(2), r.dfw) == pytest.approx(0.05, abs=1e-8)


@pytest.fixture(scope="module")
def groups(spark):
    rows = [("a", 1.0), ("a", 1.0), ("a", 1.0), ("b", 5.0), (None, 2.0), (None, 4.0), ("c", None)]
    return spark.createDataFrame(rows, "g string, x double")


def test_degenerate_statistics_are_null(spark, groups):
    constant = spark.createDataFrame([("a", 2.0), ("a", 2.0), ("b", 2.0), ("b", 2.0)], "g string, x double")
    r = X.tukey_hsd(constant, "g", "x", with_p=True).first()
    assert (r.meandiff, r.se, r.q, r.p_adj, r.reject) == (0.0, 0.0, None, None, None)
    single = spark.createDataFrame([("a", 2.0), ("b", 3.0)], "g string, x double")
    r = X.tukey_hsd(single, "g", "x", with_p=True).first()
    assert r.se is None and r.lo is None
    assert X.anova_oneway(single, "g", "x", with_p=True).first().p is None
    r = X.mean_sd_intervals(single.where("g = 'a'"), "x", exact=True).first()
    assert (r.n, r["mean"], r.sd, r.sd_lo, r.mean_lo) == (1, 2.0, None, None, None)
    line = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(5)], "x double, y double")
    assert X.simple_ols(line, "y", "x").first().t_slope is None
    assert X.simple_ols(line.limit(2), "y", "x").first().t_slope is None
    assert X.residual_mse(line.withColumn("y", F.lit(3.0)), "y", "x").first().explained_variance is None
    w = X.welch_t(constant, "g", "a", "b", ["x"], with_p=True).first()
    assert w.t is None and w.p is None


def test_null_and_constant_groups_in_charts(groups):
    box = {r.g: r for r in CH.box_stats(groups, "g", "x").collect()}
    assert set(box) == {"a", "b", None} and box[None].median == 3.0 and box["a"].n == 3
    density = CH.kde(groups, "x", "g", points=4).collect()
    assert {r.g for r in density} == {"a", "b", None}
    assert all(r.density is None for r in density if r.g in ("a", "b")) and all(r.density > 0 for r in density if r.g is None)


def test_poisson_distance_of_wide_values(spark):
    x = spark.createDataFrame([(v,) for v in (1, 2, 2, 3, 3_000_000_000, None)], "x long")
    r = X.ks_shifted_poisson(x, "x").first()
    assert r.n == 5 and 0 < r.d <= 1
    assert X.ks_shifted_poisson(x.limit(0), "x").first().d is None


def test_values_outside_the_levels_are_counted(spark):
    df = spark.createDataFrame([("r", "a"), ("r", "b"), ("r", None), ("s", "a"), ("s", "a"), ("t", None)], "row string, v string")
    got = {r.row: (r.a, r.other) for r in RS.pivot_counts(df, "row", "v", ["a"], other="other").collect()}
    assert got == {"r": (1, 2), "s": (2, 0), "t": (0, 1)}
    wide = RS.pivot_stats(df.withColumn("x", F.lit(2.0)), "row", "v", "x", ["a"], other="rest").collect()
    assert {r.row: r.rest_n for r in wide} == {"r": 2, "s": None, "t": 1}


def test_only_leading_lines_are_skipped(spark, tmp_path):
    from pyspark.sql.types import IntegerType, StructField, StructType

    schema = StructType([StructField("a", IntegerType()), StructField("b", IntegerType())])
    for name, lines in (("x.txt", ["# banner", "# 9,9", "1,2", "# 3,4", "5,six", "7,8"]), ("y.txt", ["10,11", "# 12,13"])):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    out = delimited.read_skipping(spark, str(tmp_path), schema, "^#", corrupt="bad")
    rows = {(r.a, r.b, r.bad) for r in out.collect()}
    assert rows == {(1, 2, None), (None, 4, "# 3,4"), (5, None, "5,six"), (7, 8, None), (10, 11, None), (None, 13, "# 12,13")}
    assert delimited.malformed_rows(out, "bad").first() == (6, 3)
    two = delimited.read_after_lines(spark, str(tmp_path / "x.txt"), schema, 2)
    assert [(r.a, r.b) for r in two.collect()] == [(1, 2), (None, 4), (5, None), (7, 8)]
    csv = delimited.read_csv(spark, str(tmp_path / "x.txt"), schema, header=False, comment="#", corrupt="bad")
    assert sorted((r.a, r.bad) for r in csv.collect()) == [(1, None), (5, "5,six"), (7, None)]


def test_only_flagged_rows_meet_the_donors(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, -1.0).otherwise(F.col("id").cast("double")).alias("x"))
    out = N.hot_deck(df, "k", "x", F.col("x") < 0, seed=3)
    assert out.columns == ["k", "x"] and out.count() == 100 and out.where("x < 0").count() == 0
    assert out.where("k % 10 <> 0 AND x <> k").count() == 0
    unknown = N.hot_deck(df.withColumn("f", F.lit(None).cast("boolean")), "k", "x", F.col("f")).where("x < 0").count()
    assert unknown == 10  # a NULL flag is no flag


def test_lookup_is_broadcast_only_if_small(spark, monkeypatch):
    df, dim = spark.range(10).withColumnRenamed("id", "k"), spark.range(20).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert "ResolvedHint" in str(J.lookup(df, dim, "k", bounded=True)._jdf.queryExecution().analyzed())
    monkeypatch.setattr(J, "BROADCAST_ROWS", 19)
    assert "ResolvedHint" not in str(J.lookup(df, dim, "k", bounded=True)._jdf.queryExecution().analyzed())


# --- moments -----------------------------------------------------------------


def test_least_squares_against_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 3.0, (400, 3))
    y = x @ [0.5, -2.0, 1.0] + rng.normal(size=400)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    got = {r.term: r for r in G.ols(df, "y", ["a", "b", "c"]).collect()}
    design = np.column_stack([x - x.mean(axis=0), np.ones(400)])
    beta, sse, _, _ = np.linalg.lstsq(design, y, rcond=None)
    for name, b in zip("abc", beta):
        assert got[name].coef == pytest.approx(b, rel=1e-6)
    se = np.sqrt(sse[0] / 396 * np.diag(np.linalg.inv(design.T @ design)))
    assert got["b"].se == pytest.approx(se[1], rel=1e-6) and got["b"].p == pytest.approx(D.t_sf_two_sided(got["b"].t, 396), abs=1e-12)


def test_determined_columns_and_exact_fits(spark):
    rows = [(float(i), 2.0 * i, float(i * i % 7), 3.0 * i + 1.0) for i in range(30)] + [(None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, twice double, c double, y double")
    got = {r.term: r for r in G.ols(df, "y", ["a", "twice", "c"]).collect()}
    assert got["twice"].determined and got["twice"].coef is None
    assert got["a"].coef == pytest.approx(3.0) and got["a"].t is None and got["a"].r2 == 1.0
    assert G.ols(df.limit(0), "y", ["a"]).count() == 1
    flat = G.ols(df.withColumn("y", F.lit(2.0)), "y", ["a"]).collect()
    assert all(r.r2 is None for r in flat)


def test_components_against_eigh(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6)) + 50.0
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, v array<double>")
    fitted = G.Components.fit(G.vector_moments(df, "v", 6))
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert fitted.values == pytest.approx(values[::-1], rel=1e-9)
    for k in range(6):
        assert abs(fitted.vectors[:, k] @ vectors[:, 5 - k]) == pytest.approx(1.0, abs=1e-9)
        assert fitted.vectors[np.argmax(np.abs(fitted.vectors[:, k])), k] > 0
    scores = fitted.scores(df, 2, "v").orderBy("id").select("pc1", "pc2").toPandas().to_numpy()
    assert scores == pytest.approx((x - x.mean(axis=0)) @ fitted.vectors[:, :2], abs=1e-8)
    wide = df.select(*[F.col("v")[i].alias(f"c{i}") for i in range(6)])
    assert G.Components.fit(G.cross_moments(wide, wide.columns)).values == pytest.approx(fitted.values, rel=1e-9)
    reg = {r.term: r.coef for r in G.component_regression(df.withColumn("y", F.col("v")[0]), "v", 6, "y", 6).collect()}
    assert [reg[f"pc{i + 1}"] for i in range(6)] == pytest.approx(fitted.vectors[0], abs=1e-8)


# --- trees and validation ------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    o = table(spark, SMALL, "orders")
    df = o.select("o_orderkey", F.col("o_totalprice").alias("p"), F.month("o_orderdate").alias("m"),
                  F.when(F.col("o_orderkey") % 11 == 0, None).otherwise(F.col("o_orderkey") % 7).alias("r"),
                  ((F.col("o_totalprice") > 150000) & (F.month("o_orderdate") < 7)).cast("int").alias("y"))
    df = df.withColumn("y", F.when(F.col("o_orderkey") % 13 == 0, 1 - F.col("y")).otherwise(F.col("y")))
    return B.stratified_folds(df, "o_orderkey", "y", 3, seed=5)


def test_tree_limits_hold_and_scores_follow_the_nodes(spark, labelled):
    tree = trees.fit_tree(labelled, ["p", "m", "r"], "y", impurity="gini", max_depth=4, min_leaf=20, min_split=100)
    nodes = {r.node: r for r in tree.node_table(spark).collect()}
    assert nodes[1].n == labelled.count() and max(r.depth for r in nodes.values()) <= 4
    for r in nodes.values():
        if r.feature is not None:
            assert r.n >= 100 and nodes[2 * r.node].n >= 20 and nodes[2 * r.node + 1].n >= 20
            assert nodes[2 * r.node].n + nodes[2 * r.node + 1].n == r.n and r.gain > 0
    leaves = labelled.groupBy(tree.predict().alias("p")).count().collect()
    want = {}
    for r in nodes.values():
        if r.feature is None:
            want[int(r.prediction)] = want.get(int(r.prediction), 0) + r.n
    assert {r.p: r["count"] for r in leaves} == want
    accuracy = labelled.agg(F.avg((tree.predict() == F.col("y")).cast("double"))).first()[0]
    assert accuracy > 0.85
    stump = trees.fit_tree(labelled, ["p"], "y", max_depth=0)
    assert len(stump.nodes) == 1


def test_trees_without_rows_or_choice(spark, labelled):
    none = trees.fit_tree(labelled.limit(0), ["p", "m"], "y")
    assert none.nodes == {} and labelled.select(none.predict().alias("z")).first().z is None
    pure = trees.fit_tree(labelled.withColumn("y", F.lit("yes")), ["p", "m"], "y")
    assert len(pure.nodes) == 1 and labelled.select(pure.predict().alias("z")).first().z == "yes"
    same = trees.fit_tree(labelled.withColumn("p", F.lit(1.0)), ["p"], "y")
    assert len(same.nodes) == 1


def test_grid_search_equals_separate_fits(spark, labelled):
    grids = [{"impurity": ["gini", "entropy"], "max_depth": [1, 3]}, {"min_split": [2, 300], "max_depth": [3]}]
    features = ["p", "m", "r"]
    results, best, refitted = trees.grid_search(labelled, features, "y", "fold", 3, grids, refit="accuracy")
    points = trees.combinations(grids)
    rows = {r.combo: r for r in results.collect()}
    assert len(points) == 5 and sorted(rows) == list(range(5))  # one combination stands in both grids
    edges = trees.fit_edges(labelled, features)
    for i, point in enumerate(points):
        values = []
        for f in range(3):
            counts = trees.binned_counts(labelled.where(F.col("fold") != f), features, "y", edges)
            nodes, _ = trees.grow(counts, [point], [None], [0, 1])
            tree = trees.Tree(nodes, features, edges, point["impurity"])
            values.append(labelled.where(F.col("fold") == f).agg(F.avg((tree.predict() == F.col("y")).cast("double"))).first()[0])
        assert rows[i].mean_accuracy == pytest.approx(np.mean(values)) and rows[i].sd_accuracy == pytest.approx(np.std(values, ddof=1))
    top = min(rows.values(), key=lambda r: r["rank"])
    assert best == points[top.combo] and top.mean_accuracy == max(r.mean_accuracy for r in rows.values())
    alone = trees.fit_tree(labelled, features, "y", **best)
    assert [(n["node"], n["n"], n["feature"], n["bin"]) for n in alone.nodes.values()] == [(n["node"], n["n"], n["feature"], n["bin"]) for n in refitted.nodes.values()]


def test_folds_by_complement_equal_separate_fits(labelled):
    from quarry.operators import models as M

    df = labelled.withColumn("m", F.col("m").cast("double")).select("o_orderkey", "p", "m", "y", "fold")
    got = {r.o_orderkey: r.prediction for r in C.nb_cross_predict(df, ["p", "m"], "y", "fold", 3).collect()}
    for f in range(3):
        params = M.fit_gaussian_nb(df.where(F.col("fold") != f), ["p", "m"], "y")
        for r in M.predict_gaussian_nb(df.where(F.col("fold") == f), params, ["p", "m"], "y").collect():
            assert got[r.o_orderkey] == r.prediction
    coefs = C.ols_fold_models(df, "p", ["m", "y"], "fold", 3)
    for f in range(3):
        own = {r.term: r.coef for r in G.ols(df.where(F.col("fold") != f), "p", ["m", "y"]).collect()}
        assert coefs[f] == pytest.approx(own)
    folds = C.cross_validate_nb(df, ["p", "m"], "y", "fold", 3)
    summary = {r.metric: r for r in C.metric_summary(folds).collect()}
    assert set(summary) == {"accuracy", "precision", "recall", "f1"} and summary["accuracy"].folds == 3
    same = {r.metric: r for r in C.compare_models({"a": folds, "b": folds}, "a", "b").collect()}
    assert same["accuracy"].t == 0.0 and same["accuracy"].p == pytest.approx(1.0)
    assert C.cross_validate_nb(df.limit(0), ["p", "m"], "y", "fold", 3).count() == 0


# --- frequencies ---------------------------------------------------------------


def test_weights_of_counts_have_poisson_moments(spark):
    df = spark.createDataFrame([(v,) for v, c in ((1, 1), (2, 3), (3, 31), (4, 77), (5, 700)) for _ in range(c)], "x int")
    freq = df.groupBy("x").agg(F.count(F.lit(1)).alias("c"))
    x = freq.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(4000))))
    from quarry.operators.ordering import hash_unit

    draw = {t: hash_unit("x", "rep", F.lit(t)) for t in (*range(5), "a", "b")}
    w = x.withColumn("w", B.poisson_of_count(F.col("c"), draw.__getitem__, (draw["a"], draw["b"])))
    for r in w.groupBy("c").agg(F.avg("w").alias("m"), F.var_samp("w").alias("v"), F.skewness("w").alias("s")).collect():
        assert r.m == pytest.approx(r.c, abs=5 * math.sqrt(r.c / 4000)) and r.v == pytest.approx(r.c, rel=0.12)
        assert r.s == pytest.approx(1 / math.sqrt(r.c), abs=0.2)


def test_frequency_bootstrap_follows_theory(spark):
    df = spark.createDataFrame([(i % 20, "ab"[i % 2]) for i in range(2000)], "x int, g string")
    r = X.bootstrap_frequency_ci(df, "x", 2000, seed=1).first()
    sd = math.sqrt((20**2 - 1) / 12)
    assert r.mean_est == pytest.approx(9.5, abs=0.02) and r.mean_hi - r.mean_lo == pytest.approx(2 * 1.96 * sd / math.sqrt(2000), rel=0.1)
    assert X.bootstrap_frequency_t_test(df.withColumn("x", F.floor(F.col("x") / 2)), "x", "g", "a", "b", 1000).first().p > 0.5
    assert X.bootstrap_frequency_ci(df.limit(0), "x", 100).first().mean_est is None


def test_a_hundred_thousand_levels(spark):
    df = spark.range(100_000).select("id", F.concat(F.lit("level "), F.col("id")).alias("c")).union(spark.createDataFrame([(-1, None)], "id long, c string"))
    codes = T.fit_codes(df, "c")
    v = T.one_hot_sparse(df, codes, "c", reference="level 7")
    entries = T.sparse_entries(v, "id", "c_vec")
    assert entries.count() == 99_999 and entries.select("position").distinct().count() == 99_999
    assert entries.where("id IN (-1, 7)").count() == 0 and v.count() == 100_001
    phi = X.phi_coefficients(df.withColumn("d", F.substring("c", 1, 7)), ["c", "d"])
    assert phi.count() == 100_000


# --- kernels and small operators -------------------------------------------------


def test_nystroem_features_give_the_kernel(spark):
    from quarry.operators.kernels import Kernel, Nystroem

    rng = np.random.default_rng(2)
    x = rng.normal(size=(12, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)] + [(99, None, 1.0, 1.0)], "id int, a double, b double, c double")
    for kernel in (Kernel("rbf", 0.7), Kernel("poly", 0.5, 2, 1.0), Kernel("poly", 1.0, 1, 0.0)):
        model = Nystroem.fit(df, ["a", "b", "c"], "id", kernel, m=12)
        rows = model.apply(df).orderBy("id").collect()
        phi = np.array([r.phi for r in rows[:12]])
        assert phi @ phi.T == pytest.approx(kernel.matrix(x, x), abs=1e-6)
        assert rows[12].phi is None


def test_kernel_machines_converge(spark, labelled):
    from quarry.operators.kernels import Kernel, Nystroem, fit_classifier, fit_regressor, minimise

    df = labelled.select("o_orderkey", (F.col("p") / 100000).alias("p"), (F.col("m") / 6).alias("m"), "y")
    features = Nystroem.fit(df, ["p", "m"], "o_orderkey", Kernel("rbf", 1.0), 10)
    mapped = features.apply(df).checkpoint()
    data = mapped.select("phi", "y", "p").collect()
    phi, y, p = np.array([r.phi for r in data]), np.array([2.0 * r.y - 1 for r in data]), np.array([r.p for r in data])

    def hinge(w):
        short = np.maximum(1 - y * (phi @ w[:-1] + w[-1]), 0)
        g = -2 * y * short
        return (short**2).mean() + 5e-4 * w[:-1] @ w[:-1], np.append(phi.T @ g / len(y) + 1e-3 * w[:-1], g.mean())

    _, best, _ = minimise(hinge, np.zeros(phi.shape[1] + 1), most=5000, tolerance=1e-9)
    model = fit_classifier(mapped, "phi", F.col("y") == 1)
    assert best <= model.objective <= 1.01 * best and model.evaluations < 100
    right = mapped.agg(F.avg(((model.score() > 0) == (F.col("y") == 1)).cast("double"))).first()[0]
    assert right > 0.85

    def tube(w):
        gap = p - phi @ w[:-1] - w[-1]
        over = np.maximum(np.abs(gap) - 0.1, 0)
        value = np.where(over < 0.1, over**2 / 0.2, over - 0.05).mean()
        g = -np.sign(gap) * np.minimum(over / 0.1, 1)
        return value + 5e-4 * w[:-1] @ w[:-1], np.append(phi.T @ g / len(p) + 1e-3 * w[:-1], g.mean())

    _, best, _ = minimise(tube, np.zeros(phi.shape[1] + 1), most=5000, tolerance=1e-9)
    assert best <= fit_regressor(mapped, "phi", "p").objective <= 1.01 * best
    assert fit_classifier(mapped.limit(0), "phi", F.col("y") == 1).evaluations == 0


def test_minimise_finds_the_bottom_of_a_valley():
    from quarry.operators.kernels import minimise

    def valley(x):
        a, b = x
        return (1 - a) ** 2 + 100 * (b - a * a) ** 2, np.array([-2 * (1 - a) - 400 * a * (b - a * a), 200 * (b - a * a)])

    x, value, _ = minimise(valley, np.array([-1.2, 1.0]), most=500, tolerance=1e-9)
    assert x == pytest.approx([1.0, 1.0], abs=1e-5) and value < 1e-9


def test_small_operators_on_nulls_and_constants(spark):
    from quarry.operators import windows as W

    df = spark.createDataFrame([("a", "x", 1.0, 1.0), ("a", "y", 1.0, None), (None, "x", 3.0, 5.0), ("b", None, None, None)], "c string, y string, u double, v double")
    enc = T.fit_class_encoding(df, "c", "y", ["x", "y"])
    out = {r.c: (r.c_x, r.c_y) for r in T.apply_class_encoding(spark.createDataFrame([("a",), ("new",), (None,)], "c string"), enc, "c", ["x", "y"]).collect()}
    assert out["new"] == pytest.approx((2 / 3, 1 / 3)) and out[None] == pytest.approx((2 / 3, 1 / 3)) and sum(out["a"]) == pytest.approx(1.0)
    rows = [(r.u, r.v) for r in T.scale_rows(df.select("u", "v"), ["u", "v"]).collect()]
    assert rows == [(0.0, 0.0), (0.0, None), (-1.0, 1.0), (None, None)]
    ranks = sorted((str(r.c), r["rank"]) for r in W.global_rank(df.select("c"), [("c", True)]).collect())
    assert ranks == [("None", 4), ("a", 1), ("a", 1), ("b", 3)]
    hist = {(r.column, r.bin): (r.lo, r.hi, r["count"]) for r in X.profile_histograms(df, ["u", "v"], 2).collect()}
    assert hist == {("u", 0): (1.0, 2.0, 2), ("u", 1): (2.0, 3.0, 1), ("v", 0): (1.0, 3.0, 1), ("v", 1): (3.0, 5.0, 1)}
    assert X.profile_histograms(df.where("c = 'a'"), ["u"], 4).first()["count"] == 2
