"""Model queries (L1-L14, K3). Library estimators get the rows-only check;
the SQL form of Gaussian naive Bayes has an exact DuckDB twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog.registry import query
from quarry.functions.rounding import rnd, rnd_sql as R
from quarry.operators import crossval as C
from quarry.operators import evaluation as E
from quarry.operators import models as M
from quarry.operators import trees as T
from quarry.operators.features import ordinal
from quarry.operators.ordering import hash_unit, hash_unit_sql
from quarry.operators.sampling import hash_split, stratified_folds
from quarry.session import table
from quarry.sources.stage import stage_path

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
ORDER_FEATURES = ["o_totalprice", "priority", "month", "weekday"]


def order_features(spark, sf):
    """orders -> numeric features, 3-class status label (F=0, O=1, P=2), hash split."""
    o = table(spark, sf, "orders")
    x = o.select("o_orderkey", "o_totalprice", ordinal("o_orderpriority", PRIORITIES).alias("priority"),
                 F.month("o_orderdate").alias("month"), F.weekday("o_orderdate").alias("weekday"),
                 ordinal("o_orderstatus", ["F", "O", "P"]).alias("status"))
    return hash_split(x, "o_orderkey", 0.2, seed=17)


def _fit_eval(spark, sf, estimator, binary=False):
    data = order_features(spark, sf)
    lab = (F.col("status") == 0).cast("int") if binary else F.col("status")
    v = M.vectorize(data.withColumn("y", lab), ORDER_FEATURES, "y")
    model = estimator.fit(v.where(F.col("split") == "train"))
    return M.predictions(model, v.where(F.col("split") == "test"), "o_orderkey")


@query("l1_decision_tree")
def _l1(spark, sf):
    return _fit_eval(spark, sf, M.decision_tree("entropy", 6, 10), binary=True)


@query("l2_random_forest")
def _l2(spark, sf):
    return _fit_eval(spark, sf, M.random_forest(20, "gini", 5), binary=True)


@query("l3_naive_bayes_ml")
def _l3ml(spark, sf):
    return _fit_eval(spark, sf, M.gaussian_nb())


NB_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_CUT = "TIMESTAMP '1998-01-01'"


def _nb_sql(classes=("A", "N", "R")):
    """Twin of the SQL-form naive Bayes; the class list of the test tables is fixed (A, N, R)."""
    f = NB_FEATURES
    mus = ", ".join(f"avg({c}) AS mu_{c}, var_pop({c}) + e AS var_{c}" for c in f)
    wide = ", ".join(
        [f"max(ln(prior)) FILTER (WHERE c = '{k}') AS lp_{k}" for k in classes]
        + [f"max(mu_{c}) FILTER (WHERE c = '{k}') AS mu_{c}_{k}, max(var_{c}) FILTER (WHERE c = '{k}') AS var_{c}_{k}"
           for k in classes for c in f])
    score = {k: f"lp_{k} + " + " + ".join(
        f"(-0.5 * ln(2 * pi() * var_{c}_{k}) - pow({c} - mu_{c}_{k}, 2) / (2.0 * var_{c}_{k}))" for c in f)
        for k in classes}
    a, n, r = classes
    return f"""WITH tr AS (SELECT * FROM lineitem WHERE l_shipdate < {_CUT}),
      eps AS (SELECT greatest({', '.join(f'var_pop({c})' for c in f)}) * 1e-9 AS e FROM tr),
      cnt AS (SELECT count(*) AS n FROM tr),
      p AS (SELECT l_returnflag AS c, count(*) / n AS prior, {mus} FROM tr, eps, cnt GROUP BY l_returnflag, n, e),
      w AS (SELECT {wide} FROM p),
      s AS (SELECT l_orderkey, l_linenumber, {score[a]} AS s_{a}, {score[n]} AS s_{n}, {score[r]} AS s_{r}
        FROM lineitem, w WHERE NOT (l_shipdate < {_CUT}))
      SELECT l_orderkey, l_linenumber, CASE WHEN s_{a} >= s_{n} AND s_{a} >= s_{r} THEN '{a}'
        WHEN s_{n} >= s_{r} THEN '{n}' ELSE '{r}' END AS prediction FROM s"""


@query("l3_naive_bayes_sql", _nb_sql())
def _l3sql(spark, sf):
    li = table(spark, sf, "lineitem")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    params = M.fit_gaussian_nb(li.where(F.col("l_shipdate") < cut), NB_FEATURES, "l_returnflag")
    test = li.where(~(F.col("l_shipdate") < cut)).select("l_orderkey", "l_linenumber", *NB_FEATURES)
    return M.predict_gaussian_nb(test, params, NB_FEATURES, "l_returnflag").select(
        "l_orderkey", "l_linenumber", "prediction")


@query("l4_logistic_regression")
def _l4(spark, sf):
    return _fit_eval(spark, sf, M.logistic(50))


@query("l5_linear_svc_weighted")
def _l5(spark, sf):
    from quarry.operators.features import apply_zscore, fit_zscore

    data = order_features(spark, sf)
    data = apply_zscore(data, fit_zscore(data.where(F.col("split") == "train"), ORDER_FEATURES), ORDER_FEATURES)
    v = M.vectorize(data, ORDER_FEATURES, "status")
    train = M.class_weights(v.where(F.col("split") == "train"), "status")
    model = M.linear_svc(10, 0.01, weight_col="weight").fit(train)
    return M.predictions(model, v.where(F.col("split") == "test"), "o_orderkey")


@query("l5_svc_rbf_features")
def _l5r(spark, sf):
    data = order_features(spark, sf)
    from quarry.operators.features import apply_zscore, fit_zscore

    z = apply_zscore(data, fit_zscore(data.where(F.col("split") == "train"), ORDER_FEATURES), ORDER_FEATURES)
    rff, names = M.random_fourier_features(z, ORDER_FEATURES, 32, gamma=0.5, seed=3)
    v = M.vectorize(rff.withColumn("y", (F.col("status") == 0).cast("int")), names, "y")
    from pyspark.ml.classification import LinearSVC

    model = LinearSVC(maxIter=30, regParam=0.01).fit(v.where(F.col("split") == "train"))
    return M.predictions(model, v.where(F.col("split") == "test"), "o_orderkey")


@query("l5_svc_polynomial")
def _l5p(spark, sf):
    data = order_features(spark, sf)
    v = M.polynomial(M.vectorize(data.withColumn("y", (F.col("status") == 0).cast("int")), ORDER_FEATURES, "y"), 2)
    from pyspark.ml.classification import LinearSVC

    model = LinearSVC(maxIter=30, regParam=0.01, featuresCol="poly").fit(v.where(F.col("split") == "train"))
    return M.predictions(model, v.where(F.col("split") == "test"), "o_orderkey")


@query("l6_svr_subgradient")
def _l6(spark, sf):
    li = table(spark, sf, "lineitem")
    from quarry.operators.features import apply_zscore, fit_zscore

    cols = ["l_quantity", "l_discount", "l_tax"]
    z = apply_zscore(li, fit_zscore(li, cols), cols)
    rff, names = M.random_fourier_features(z, cols, 16, gamma=0.5, seed=5)
    y = (F.col("l_extendedprice") / 10000.0).alias("y")
    return M.svr_subgradient(rff.select(*names, y), names, "y", epsilon=0.1, iterations=20)


@query("l7_neural_net")
def _l7(spark, sf):
    return _fit_eval(spark, sf, M.mlp([len(ORDER_FEATURES), 5, 3], step=0.1, max_iter=50))


@query("l8_predictions_vs_actuals")
def _l8(spark, sf):
    return _fit_eval(spark, sf, M.decision_tree("gini", 4, 5), binary=True)


def _cv_folds(spark, sf):
    """The folds are dealt once; every pass of every fit reads them from the checkpoint."""
    data = order_features(spark, sf).withColumn("y", (F.col("status") == 0).cast("int"))
    return stratified_folds(data, "o_orderkey", "y", 5, seed=2).select(*ORDER_FEATURES, "y", "fold").checkpoint()


def _cv_scores(folds, impurity):
    def fit_predict(train, test):
        from quarry.operators.features import apply_zscore, fit_zscore

        params = fit_zscore(train, ["o_totalprice"])  # fitted inside the fold
        tr = M.vectorize(apply_zscore(train, params, ["o_totalprice"]), ORDER_FEATURES, "y")
        te = M.vectorize(apply_zscore(test, params, ["o_totalprice"]), ORDER_FEATURES, "y")
        model = M.decision_tree(impurity, 4, 5).fit(tr)
        return model.transform(te).select(F.col("label").cast("int").alias("y"),
                                          F.col("prediction").cast("int").alias("pred"))

    def metrics(scored):
        return E.binary_metrics(scored, "y", "pred").select("sensitivity", "specificity", "precision", "f1",
                                                            "accuracy")

    return M.fold_metrics(folds, "fold", 5, fit_predict, metrics)


@query("l9_cross_validation")
def _l9(spark, sf):
    return _cv_scores(_cv_folds(spark, sf), "gini")


@query("l10_compare_fold_scores")
def _l10(spark, sf):
    folds = _cv_folds(spark, sf)
    g = _cv_scores(folds, "gini").withColumn("model", F.lit("gini"))
    e = _cv_scores(folds, "entropy").withColumn("model", F.lit("entropy"))
    return M.compare_fold_scores(g.unionByName(e), "model", "gini", "entropy", "accuracy")


@query("l11_grid_search")
def _l11(spark, sf):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import ParamGridBuilder

    data = order_features(spark, sf).withColumn("y", (F.col("status") == 0).cast("int"))
    v = M.vectorize(stratified_folds(data, "o_orderkey", "y", 3, seed=4), ORDER_FEATURES, "y")
    est = M.decision_tree()
    grid = ParamGridBuilder().addGrid(est.impurity, ["gini", "entropy"]).addGrid(est.maxDepth, [3, 6]).build()
    return M.grid_search(est, grid, BinaryClassificationEvaluator(metricName="areaUnderROC"), v, "fold", 4)


def _stepwise(spark, sf, direction):
    from quarry.functions.rounding import rnd

    li = table(spark, sf, "lineitem")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    path = M.stepwise_select(li.where(F.col("l_shipdate") < cut), li.where(~(F.col("l_shipdate") < cut)),
                             NB_FEATURES, "l_returnflag", direction)
    return path.withColumn("accuracy", rnd("accuracy"))


def _stepwise_sql(direction):
    """Every subset of the features (a bit mask) is scored; the path then follows the best neighbour."""
    from quarry.functions.rounding import rnd_sql

    n, forward = len(NB_FEATURES), direction == "forward"
    feats = list(enumerate(NB_FEATURES))
    ll = " + ".join(
        f"CASE WHEN mask & {1 << i} > 0 THEN -0.5 * ln(2 * pi() * (var_{f} + eps)) - ({f} - mu_{f}) * ({f} - mu_{f}) / (2 * (var_{f} + eps)) ELSE 0 END"
        for i, f in feats)
    eps = ", ".join(f"CASE WHEN mask & {1 << i} > 0 THEN v_{f} ELSE 0 END" for i, f in feats)
    names = ", ".join(f"({1 << i}, {i}, '{f}')" for i, f in feats)
    start = "0" if forward else str(2**n - 1)
    move = "p.mask & f.bit = 0" if forward else "p.mask & f.bit > 0 AND p.size > 1"
    first = "" if forward else f"SELECT 0 AS step, 'start' AS action, '*' AS feature, {n} AS n_features, acc FROM scored WHERE mask = {start} UNION ALL"
    return f"""WITH RECURSIVE tr AS (SELECT * FROM lineitem WHERE l_shipdate < {_CUT}),
      va AS (SELECT row_number() OVER () AS id, * FROM lineitem WHERE l_shipdate >= {_CUT}),
      cls AS (SELECT l_returnflag AS c, ln(count(*) / (SELECT count(*) FROM tr)) AS lp,
        {', '.join(f'avg({f}) AS mu_{f}, var_pop({f}) AS var_{f}' for _, f in feats)} FROM tr GROUP BY l_returnflag),
      spread AS (SELECT {', '.join(f'var_pop({f}) AS v_{f}' for _, f in feats)} FROM tr),
      masks AS (SELECT mask, 1e-9 * greatest({eps}) AS eps FROM range(1, {2**n}) AS r(mask), spread),
      pred AS (SELECT mask, id, any_value(l_returnflag) AS y, arg_max(c, (score, rank_c)) AS p FROM (
        SELECT mask, id, l_returnflag, c, lp + {ll} AS score, -dense_rank() OVER (PARTITION BY mask, id ORDER BY c) AS rank_c
        FROM va, cls, masks) AS s GROUP BY mask, id),
      scored AS (SELECT mask, avg(CASE WHEN p = y THEN 1.0 ELSE 0.0 END) AS acc FROM pred GROUP BY mask),
      feats(bit, pos, feature) AS (VALUES {names}),
      moves AS (SELECT p.mask, xor(p.mask, f.bit) AS next, f.pos, f.feature, s.acc,
          row_number() OVER (PARTITION BY p.mask ORDER BY s.acc DESC, f.pos) AS rk
        FROM (SELECT mask, bit_count(mask::BIGINT) AS size FROM range(0, {2**n}) AS r(mask)) AS p
        JOIN feats AS f ON {move} JOIN scored AS s ON s.mask = xor(p.mask, f.bit)),
      path AS (SELECT 0 AS step, {start}::BIGINT AS mask, '*' AS feature, 0.0::DOUBLE AS acc
        UNION ALL SELECT path.step + 1, m.next, m.feature, m.acc FROM path JOIN moves AS m ON m.mask = path.mask AND m.rk = 1),
      steps AS ({first} SELECT step, '{"add" if forward else "remove"}' AS action, feature,
        bit_count(mask::BIGINT) AS n_features, acc FROM path WHERE step > 0)
      SELECT step::INT AS step, action, feature, n_features::INT AS n_features, {rnd_sql('acc')} AS accuracy,
        row_number() OVER (ORDER BY acc DESC, n_features) = 1 AS best FROM steps"""


@query("l12_forward_selection", _stepwise_sql("forward"))
def _l12(spark, sf):
    return _stepwise(spark, sf, "forward")


@query("l13_backward_elimination", _stepwise_sql("backward"))
def _l13(spark, sf):
    return _stepwise(spark, sf, "backward")


def _l14_sql():
    from quarry.catalog.stats import _mi_sql
    from quarry.functions.rounding import rnd_sql

    src = "(SELECT *, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem) AS li"
    feats = [*NB_FEATURES, "revenue"]
    pairs = " UNION ALL ".join(f"SELECT '{a}' AS var1, '{b}' AS var2, corr({a}, {b}) AS c FROM {src}"
                               for i, a in enumerate(feats) for b in feats[i + 1:] if a < b)
    pairs += " UNION ALL " + " UNION ALL ".join(f"SELECT '{b}' AS var1, '{a}' AS var2, corr({a}, {b}) AS c FROM {src}"
                                                 for i, a in enumerate(feats) for b in feats[i + 1:] if b < a)
    return f"""WITH mi AS ({_mi_sql(feats, 'l_returnflag', src=src)}), p AS ({pairs})
      SELECT CASE WHEN m1.mi >= m2.mi THEN var1 ELSE var2 END AS kept, CASE WHEN m1.mi >= m2.mi THEN var2 ELSE var1 END AS dropped,
        {rnd_sql('c')} AS corr FROM p JOIN mi m1 ON m1.feature = var1 JOIN mi m2 ON m2.feature = var2 WHERE abs(c) > 0.8"""


@query("l14_correlation_pruning", _l14_sql())
def _l14(spark, sf):
    from quarry.functions.rounding import rnd

    li = table(spark, sf, "lineitem").withColumn("revenue", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    out = M.correlation_pruning(li, [*NB_FEATURES, "revenue"], "l_returnflag", 0.8)
    return out.withColumn("corr", rnd("corr"))


@query("k3_tree_structure")
def _k3(spark, sf):
    data = order_features(spark, sf)
    v = M.vectorize(data.withColumn("y", (F.col("status") == 0).cast("int")), ORDER_FEATURES, "y")
    model = M.decision_tree("gini", 3, 5).fit(v)
    return M.tree_nodes(model, stage_path(spark, "tree"), ORDER_FEATURES)


# ---- trees grown from histograms: L1, K3, L8, L11 ------------------------------------------

_ORDERS_SQL = f"""SELECT o_orderkey AS rid, o_totalprice, list_position([{', '.join(f"'{p}'" for p in PRIORITIES)}], o_orderpriority) - 1 AS priority,
  month(o_orderdate) AS month, (dayofweek(o_orderdate) + 6) % 7 AS weekday, CAST(o_orderstatus = 'F' AS INTEGER) AS y0,
  {hash_unit_sql('o_orderkey', 17)} AS u FROM orders"""
_TREE = {"impurity": "entropy", "max_depth": 4, "min_leaf": 10, "min_split": 60}
_TREE_CTES = T.tree_ctes(
    f"SELECT rid, {', '.join(ORDER_FEATURES)}, y0, CASE WHEN u >= 0.2 THEN y0 END AS y, NULL::INTEGER AS fold FROM ({_ORDERS_SQL})",
    ORDER_FEATURES, [_TREE], [None], [0, 1])


def _fitted_tree(spark, sf):
    data = order_features(spark, sf).withColumn("y", (F.col("status") == 0).cast("int"))
    return data, T.fit_tree(data.where(F.col("split") == "train"), ORDER_FEATURES, "y", **_TREE)


@query("l1_tree_split_limits", f"""WITH {_TREE_CTES}
  SELECT w.rid AS o_orderkey, src.y0 AS actual, pr.prediction AS predict FROM w JOIN src USING (rid) JOIN pr ON pr.node = w.node WHERE src.y IS NULL""")
def _l1_limits(spark, sf):
    data, tree = _fitted_tree(spark, sf)
    return data.where(F.col("split") == "test").select("o_orderkey", F.col("y").alias("actual"), tree.predict().alias("predict"))


@query("k3_tree_node_table", f"""WITH {_TREE_CTES},
  th AS (SELECT f, e FROM ed)
  SELECT pr.node, pr.depth, CASE sp.f {' '.join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(ORDER_FEATURES))} END AS feature,
    th.e[sp.b + 1] AS threshold, c0 + c1 AS n, c0, c1, {R('-(CASE WHEN c0 > 0 THEN c0 / (c0 + c1) * ln(c0 / (c0 + c1)) ELSE 0 END + CASE WHEN c1 > 0 THEN c1 / (c0 + c1) * ln(c1 / (c0 + c1)) ELSE 0 END)', 8)} AS impurity,
    {R('sp.gain', 8)} AS gain, CAST(pr.prediction AS VARCHAR) AS prediction
  FROM pr LEFT JOIN sp ON sp.node = pr.node LEFT JOIN th ON th.f = sp.f""")
def _k3_native(spark, sf):
    _, tree = _fitted_tree(spark, sf)
    return tree.node_table(spark).select(
        "node", "depth", "feature", "threshold", "n", F.col("counts")[0].alias("c0"), F.col("counts")[1].alias("c1"),
        (rnd("impurity", 8) + 0.0).alias("impurity"), rnd("gain", 8).alias("gain"), "prediction")


_GRIDS = [{"impurity": ["gini", "entropy"], "max_depth": [2, 3], "min_leaf": [5]}, {"max_depth": [3], "min_split": [2, 400]}]
_POINTS = T.combinations(_GRIDS)
_GRID_CTES = T.tree_ctes(
    f"""SELECT rid, {', '.join(ORDER_FEATURES)}, y0, y0 AS y, CAST((row_number() OVER (PARTITION BY y0 ORDER BY {hash_unit_sql('rid', 23)}, rid) - 1) % 3 AS INTEGER) AS fold
    FROM ({_ORDERS_SQL})""", ORDER_FEATURES, [p for p in _POINTS for _ in range(3)], [0, 1, 2] * len(_POINTS), [0, 1])


def _grid_sql():
    points = ", ".join(f"({i}, '{p['impurity']}', {p['max_depth']}, {p['min_leaf']}, {p['min_split']})" for i, p in enumerate(_POINTS))
    rates = {"accuracy": "(tp + tn) / n", "precision": "tp / nullif(tp + fp, 0)", "recall": "tp / nullif(tp + fn, 0)",
             "f1": "2 * tp / nullif(2 * tp + fp + fn, 0)", "specificity": "tn / nullif(tn + fp, 0)"}
    means = ", ".join(f"{R(f'avg({m})')} AS mean_{m}, {R(f'stddev_samp({m})')} AS sd_{m}" for m in rates)
    return f"""WITH {_GRID_CTES},
      cf AS (SELECT w.tree, count(*)::DOUBLE AS n, {', '.join(f"count(*) FILTER (WHERE y0 = {y} AND prediction = {p})::DOUBLE AS {c}"
             for c, y, p in (('tp', 1, 1), ('fp', 0, 1), ('fn', 1, 0), ('tn', 0, 0)))}
        FROM w JOIN src USING (rid) JOIN tr USING (tree) JOIN pr ON pr.tree = w.tree AND pr.node = w.node WHERE src.fold = tr.held GROUP BY w.tree),
      m AS (SELECT tree // 3 AS combo, {', '.join(f'{e} AS {m}' for m, e in rates.items())} FROM cf),
      r AS (SELECT combo, {means}, ROUND(avg(f1) * 1e10) AS score FROM m GROUP BY combo),
      p(combo, impurity, max_depth, min_leaf, min_split) AS (VALUES {points})
      SELECT p.*, {', '.join(f'mean_{m}, sd_{m}' for m in rates)}, CAST(row_number() OVER (ORDER BY score DESC, combo) AS INTEGER) AS rank FROM p JOIN r USING (combo)"""


@query("l11_grid_search_trees", _grid_sql())
def _l11_trees(spark, sf):
    data = order_features(spark, sf).withColumn("y", (F.col("status") == 0).cast("int"))
    data = stratified_folds(data, "o_orderkey", "y", 3, seed=23)
    results, _, _ = T.grid_search(data, ORDER_FEATURES, "y", "fold", 3, _GRIDS, refit="f1")
    return results.withColumns({f"{p}_{m}": rnd(f"{p}_{m}") for m in T.METRICS for p in ("mean", "sd")})


# ---- cross-validation by complement: L9, L10 -------------------------------------------------

_CV = [("wide", NB_FEATURES), ("narrow", ["l_discount", "l_tax"])]
_FOLD_SQL = f"CAST(floor({hash_unit_sql(['l_orderkey', 'l_linenumber'], 31)} * 4) AS INTEGER)"


def _folded(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", *NB_FEATURES)
    return li.withColumn("fold", F.floor(hash_unit("l_orderkey", "l_linenumber", seed=31) * 4).cast("int"))


def _cv_ctes(features, tag):
    """Separate fits: every training set is grouped by itself."""
    stats = ", ".join(f"avg({f}) AS mu_{f}, var_pop({f}) AS var_{f}" for f in features)
    ll = " + ".join(f"(-0.5 * ln(2 * pi() * (var_{f} + eps)) - ({f} - mu_{f}) * ({f} - mu_{f}) / (2 * (var_{f} + eps)))" for f in features)
    return f"""tr{tag} AS (SELECT f.fold AS held, b.* FROM b JOIN (SELECT DISTINCT fold FROM b) f ON b.fold <> f.fold),
      e{tag} AS (SELECT held, count(*) AS n, 1e-9 * greatest({', '.join(f'var_pop({f})' for f in features)}) AS eps FROM tr{tag} GROUP BY held),
      c{tag} AS (SELECT held, l_returnflag AS c, count(*) AS nc, {stats} FROM tr{tag} GROUP BY held, l_returnflag),
      p{tag} AS (SELECT b.rid, b.fold, any_value(b.l_returnflag) AS y, arg_max(c, (ln(nc / n) + {ll}, -ascii(c))) AS p
        FROM b JOIN c{tag} ON c{tag}.held = b.fold JOIN e{tag} ON e{tag}.held = b.fold GROUP BY ALL),
      q{tag} AS (SELECT fold, c, count(*) FILTER (WHERE y = c) AS a, count(*) FILTER (WHERE p = c) AS s, count(*) FILTER (WHERE y = c AND p = c) AS h
        FROM p{tag}, (SELECT DISTINCT l_returnflag AS c FROM b) GROUP BY fold, c HAVING count(*) FILTER (WHERE y = c OR p = c) > 0),
      m{tag} AS (UNPIVOT (SELECT fold, sum(h) / sum(a)::DOUBLE AS accuracy, avg(coalesce(h / nullif(s, 0), 0)) AS precision, avg(coalesce(h / nullif(a, 0), 0)) AS recall,
        avg(2 * h / (s + a)) AS f1 FROM q{tag} GROUP BY fold) ON accuracy, precision, recall, f1 INTO NAME metric VALUE value)"""


_CV_SRC = f"b AS (SELECT *, row_number() OVER () AS rid, {_FOLD_SQL} AS fold FROM lineitem)"


@query("l9_naive_bayes_folds", f"WITH {_CV_SRC}, {_cv_ctes(NB_FEATURES, 0)} SELECT fold, metric, {R('value', 9)} AS value FROM m0")
def _l9_folds(spark, sf):
    return C.cross_validate_nb(_folded(spark, sf), NB_FEATURES, "l_returnflag", "fold", 4).withColumn("value", rnd("value", 9))


@query("l9_metric_means", f"""WITH {_CV_SRC}, {_cv_ctes(NB_FEATURES, 0)}
    SELECT metric, count(*) AS folds, {R('avg(value)', 9)} AS mean, {R('stddev_samp(value)', 9)} AS sd, {R('min(value)', 9)} AS min, {R('max(value)', 9)} AS max FROM m0 GROUP BY metric""")
def _l9_means(spark, sf):
    s = C.metric_summary(C.cross_validate_nb(_folded(spark, sf), NB_FEATURES, "l_returnflag", "fold", 4))
    return s.withColumns({c: rnd(c, 9) for c in ("mean", "sd", "min", "max")})


def _l10_sql():
    from quarry.catalog.inference import t_p_sql

    return f"""WITH {_CV_SRC}, {_cv_ctes(_CV[0][1], 0)}, {_cv_ctes(_CV[1][1], 1)},
      s AS (SELECT metric, avg(m0.value) AS a, avg(m1.value) AS b, var_samp(m0.value) / 4 AS va, var_samp(m1.value) / 4 AS vb FROM m0 JOIN m1 USING (fold, metric) GROUP BY metric),
      t AS (SELECT metric, a, b, (a - b) / sqrt(va + vb) AS t, pow(va + vb, 2) / (pow(va, 2) / 3 + pow(vb, 2) / 3) AS df FROM s)
      SELECT metric, {R('a', 9)} AS mean1, {R('b', 9)} AS mean2, {R('t', 4)} AS t, {R('df', 4)} AS df, {R(t_p_sql('t', 'df'), 7)} AS p FROM t"""


@query("l10_compare_naive_bayes", _l10_sql())
def _l10_nb(spark, sf):
    rows = _folded(spark, sf)
    folds = {n: C.cross_validate_nb(rows, fs, "l_returnflag", "fold", 4) for n, fs in _CV}
    t = C.compare_models(folds, "wide", "narrow")
    return t.withColumns({"mean1": rnd("mean1", 9), "mean2": rnd("mean2", 9), "t": rnd("t", 4), "df": rnd("df", 4), "p": rnd("p", 7)})


_CV_Y, _CV_X = "l_extendedprice", "l_quantity"


@query("l9_regression_folds", f"""WITH {_CV_SRC},
    f AS (SELECT t.fold AS held, regr_slope({_CV_Y}, {_CV_X}) AS s, regr_intercept({_CV_Y}, {_CV_X}) AS i FROM b JOIN (SELECT DISTINCT fold FROM b) t ON b.fold <> t.fold GROUP BY held),
    e AS (SELECT fold, {_CV_Y} AS y, {_CV_Y} - i - s * {_CV_X} AS e FROM b JOIN f ON f.held = b.fold),
    w AS (SELECT fold, avg(e * e) AS mse, avg(abs(e)) AS mae, 1 - avg(e * e) / var_pop(y) AS r2, 1 - var_pop(e) / var_pop(y) AS explained_variance FROM e GROUP BY fold)
    SELECT fold, metric, {R('value', 3)} AS value FROM (UNPIVOT w ON mse, mae, r2, explained_variance INTO NAME metric VALUE value)""")
def _l9_regression(spark, sf):
    return C.cross_validate_ols(_folded(spark, sf), _CV_Y, [_CV_X], "fold", 4).withColumn("value", rnd("value", 3))


# ---- kernel machines: L5, L6 -----------------------------------------------------------------


def _scaled_orders(spark, sf):
    from quarry.operators.features import apply_zscore, fit_zscore

    data = order_features(spark, sf).withColumn("y", (F.col("status") == 0).cast("int"))
    data = apply_zscore(data, fit_zscore(data.where(F.col("split") == "train"), ORDER_FEATURES), ORDER_FEATURES).checkpoint()
    return data.where(F.col("split") == "train"), data.where(F.col("split") == "test")


@query("l5_kernel_table")
def _l5_table(spark, sf):
    """Polynomial kernels of degree 1 to 4 and RBF, each with and without class weights."""
    from quarry.operators.kernels import Kernel, kernel_table

    train, test = _scaled_orders(spark, sf)
    kernels = [Kernel("poly", 0.25, d, 1.0) for d in (1, 2, 3, 4)] + [Kernel("rbf", 0.25)]
    return kernel_table(train, test, ORDER_FEATURES, "o_orderkey", "y", kernels, m=10, tolerance=1e-2)


@query("l6_kernel_regression")
def _l6_kernel(spark, sf):
    from quarry.operators.kernels import Kernel, Nystroem, fit_regressor

    train, test = _scaled_orders(spark, sf)
    features = Nystroem.fit(train, ["priority", "month", "weekday"], "o_orderkey", Kernel("rbf", 0.5), 10)
    model = fit_regressor(features.apply(train), "phi", "o_totalprice", epsilon=0.1, tolerance=1e-2)
    return features.apply(test).select("o_orderkey", F.col("o_totalprice").alias("actual"), model.score().alias("predict"))
