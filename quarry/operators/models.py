"""

Library models are ``pyspark.ml`` estimators (distributed training); the
Gaussian naive Bayes also has a SQL form (class moments -> log-likelihood
columns) so that it can be checked exactly and so that stepwise selection
(L12, L13) scores every candidate feature of a round in ONE aggregate.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.stats import welch_t


# ---- L1 - L7: library estimators ---------------------------------------------------

def vectorize(df: DataFrame, features: Sequence[str], label: str | None = None, out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    v = VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip").transform(df)
    return v.withColumn("label", F.col(label).cast("double")) if label else v


def decision_tree(impurity: str = "gini", max_depth: int = 5, min_leaf: int = 1, seed: int = 0):
    """L1: ``minInstancesPerNode`` is the min-leaf limit; Spark has no min-split parameter."""
    from pyspark.ml.classification import DecisionTreeClassifier

    return DecisionTreeClassifier(impurity=impurity, maxDepth=max_depth, minInstancesPerNode=min_leaf, seed=seed)


def random_forest(num_trees: int = 20, impurity: str = "gini", max_depth: int = 5, seed: int = 0):
    """L2."""
    from pyspark.ml.classification import RandomForestClassifier

    return RandomForestClassifier(numTrees=num_trees, impurity=impurity, maxDepth=max_depth, seed=seed)


def gaussian_nb():
    """L3 (library form)."""
    from pyspark.ml.classification import NaiveBayes

    return NaiveBayes(modelType="gaussian")


def logistic(max_iter: int = 100):
    """L4: multinomial logistic regression."""
    from pyspark.ml.classification import LogisticRegression

    return LogisticRegression(family="multinomial", maxIter=max_iter)


def linear_svc(max_iter: int = 50, reg: float = 0.01, weight_col: str | None = None):
    """Linear SVM; one-vs-rest for several classes; optional class weights."""
    from pyspark.ml.classification import LinearSVC, OneVsRest

    svc = LinearSVC(maxIter=max_iter, regParam=reg)
    if weight_col:
        svc = svc.setWeightCol(weight_col)
    return OneVsRest(classifier=svc, weightCol=weight_col) if weight_col else OneVsRest(classifier=svc)


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """L5 ``class_weight='balanced'``: n / (k * n_class), joined on the label (k rows)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    tot = counts.agg(F.struct(F.sum("__nc").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    w = counts.select(label, (tot.n / (tot.k * F.col("__nc"))).alias(name))
    from quarry.operators.ordering import join_null_safe

    # one row per class: never the rows themselves are dealt out by a label with few values
    return join_null_safe(df, F.broadcast(w), [label])


def polynomial(df: DataFrame, degree: int, in_col: str = "features", out: str = "poly"):
    """L5 polynomial kernel of a given degree as an explicit feature expansion."""
    from pyspark.ml.feature import PolynomialExpansion

    return PolynomialExpansion(degree=degree, inputCol=in_col, outputCol=out).transform(df)


def random_fourier_features(df: DataFrame, cols: Sequence[str], n_components: int, gamma: float,
                            seed: int = 0, prefix: str = "rff") -> tuple[DataFrame, list[str]]:
    """L5 / L6 RBF kernel approximation (Rahimi & Recht 2007): sqrt(2/D) cos(W x + b),
    W ~ N(0, 2 gamma), b ~ U(0, 2 pi); W and b are drawn once from ``seed``
    (D x d numbers, independent of the data) and inlined as column maths."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, len(cols)))
    b = rng.uniform(0.0, 2 * math.pi, size=n_components)
    scale = math.sqrt(2.0 / n_components)
    names = [f"{prefix}{j}" for j in range(n_components)]
    exprs = []
    for j in range(n_components):
        dot = F.lit(float(b[j]))
        for i, c in enumerate(cols):
            dot = dot + F.lit(float(w[j, i])) * F.col(c)
        exprs.append((F.lit(scale) * F.cos(dot)).alias(names[j]))
    return df.select("*", *exprs), names


def svr_subgradient(df: DataFrame, features: Sequence[str], label: str, epsilon: float = 0.1, reg: float = 1e-3,
                    step: float = 0.5, iterations: int = 50) -> DataFrame:
    """Epsilon-insensitive linear regression on (kernel) features by full-batch
    sub-gradient descent. Each iteration is ONE aggregate over the data (the
    gradient, d numbers); the weights stay on the driver (d numbers).
    Returns the weight table (term, weight) with the intercept last."""
    d = len(features)
    w = np.zeros(d + 1)
    x = df.select(*[F.col(c).cast("double") for c in features], F.col(label).cast("double").alias("__y")).cache()
    n = x.count()
    for it in range(iterations):
        pred = F.lit(float(w[-1]))
        for i, c in enumerate(features):
            pred = pred + F.lit(float(w[i])) * F.col(c)
        r = F.col("__y") - pred
        g = F.when(r > epsilon, F.lit(-1.0)).when(r < -epsilon, F.lit(1.0)).otherwise(F.lit(0.0))
        grads = x.agg(*[F.sum(g * F.col(c)).alias(c) for c in features], F.sum(g).alias("__b")).first()
        gv = np.array([grads[c] for c in features] + [grads["__b"]]) / n
        gv[:-1] += reg * w[:-1]
        w -= step / math.sqrt(it + 1) * gv
    x.unpersist()
    spark = df.sparkSession
    return spark.createDataFrame([(t, float(v)) for t, v in zip(list(features) + ["intercept"], w)],
                                 "term string, weight double")


def mlp(layers: Sequence[int], step: float = 0.1, max_iter: int = 200, seed: int = 0):
    """Feed-forward network (sigmoid hidden layers, softmax output);
    a network without hidden layers is logistic regression."""
    if len(layers) == 2:
        from pyspark.ml.classification import LogisticRegression

        return LogisticRegression(family="multinomial", maxIter=max_iter)
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    return MultilayerPerceptronClassifier(layers=list(layers), stepSize=step, maxIter=max_iter, seed=seed,
                                          solver="gd")


def predictions(model, test: DataFrame, key: str) -> DataFrame:
    """Predictions beside actuals."""
    return model.transform(test).select(key, F.col("label").alias("actual"), F.col("prediction").alias("predict"))


# ---- L9 - L11: validation ------------------------------------------------------------

def fold_metrics(df: DataFrame, fold_col: str, k: int, fit_predict, metrics) -> DataFrame:
    """For each fold: fit on the other folds (including any encoder /
    scaler fitted inside ``fit_predict``), score the held-out fold, and stack
    one-row metric frames into (fold, metric, value)."""
    from quarry.operators.evaluation import comparison_table

    out = None
    for f in range(k):
        train = df.where(F.col(fold_col) != f)
        test = df.where(F.col(fold_col) == f)
        scored = fit_predict(train, test)
        m = comparison_table({str(f): metrics(scored)}).withColumnRenamed("model", "fold")
        out = m if out is None else out.unionByName(m)
    return out


def compare_fold_scores(scores: DataFrame, model_col: str, a: str, b: str, metric: str) -> DataFrame:
    """Welch t-test between two models' fold scores of one metric."""
    s = scores.where(F.col("metric") == metric)
    return welch_t(s, model_col, a, b, ["value"], with_p=True)


def grid_search(estimator, grid, evaluator, data: DataFrame, fold_col: str, parallelism: int = 4) -> DataFrame:
    """Exhaustive grid search with cross-validation on a fold column;
    one row per parameter combination with the mean metric and its rank."""
    from pyspark.ml.tuning import CrossValidator

    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, foldCol=fold_col,
                        parallelism=parallelism)
    model = cv.fit(data)
    rows = []
    larger = evaluator.isLargerBetter()
    for i, (pm, m) in enumerate(zip(grid, model.avgMetrics)):
        rows.append((i, ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name)),
                     float(m)))
    res = data.sparkSession.createDataFrame(rows, "combo int, params string, mean_metric double")
    from pyspark.sql import Window

    order = F.desc("mean_metric") if larger else F.asc("mean_metric")
    return res.withColumn("rank", F.rank().over(Window.orderBy(order)))


# ---- L3 SQL form, L12 - L13 stepwise, L14 pruning -----------------------------------------

def fit_gaussian_nb(df: DataFrame, features: Sequence[str], label: str, var_smoothing: float = 1e-9) -> DataFrame:
    """L3 SQL form, fit: per class prior and per (class, feature) mean and
    population variance + var_smoothing * (largest feature variance)."""
    eps = df.agg(F.greatest(*[F.var_pop(f) for f in features]) if len(features) > 1 else F.var_pop(features[0])
                 ).scalar() * F.lit(var_smoothing)
    n = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(label).agg(
        (F.count(F.lit(1)) / n).alias("prior"),
        *[F.avg(f).alias(f"mu_{f}") for f in features],
        *[(F.var_pop(f) + eps).alias(f"var_{f}") for f in features])


def nb_loglik_columns(df: DataFrame, params: DataFrame, features: Sequence[str], label: str) -> tuple[DataFrame, list]:
    """Per-row log-likelihood terms ``__ll_{i}_{f}`` and log priors ``__lp_{i}``.

    The fitted parameters are model-sized (k classes x f features), like the
    coefficients of any fitted ``pyspark.ml`` model: they are collected once
    and inlined as literals, which keeps the row expressions small and free
    of subqueries."""
    rows = params.orderBy(label).collect()
    classes = [r[label] for r in rows]
    cols = {}
    for i, p in enumerate(rows):
        cols[f"__lp_{i}"] = F.lit(math.log(p["prior"]))
        for f in features:
            mu, var = float(p[f"mu_{f}"]), float(p[f"var_{f}"])
            cols[f"__ll_{i}_{f}"] = F.lit(-0.5 * math.log(2 * math.pi * var)) - \
                (F.col(f) - F.lit(mu)) ** 2 / F.lit(2.0 * var)
    return df.withColumns(cols), classes


def _argmax_class(scores: Sequence[Column], classes: Sequence) -> Column:
    best = F.greatest(*[F.struct(s.alias("s"), F.lit(-i).alias("neg_i")) for i, s in enumerate(scores)]) \
        if len(scores) > 1 else F.struct(scores[0].alias("s"), F.lit(0).alias("neg_i"))
    lab = F.array(*[F.lit(c) for c in classes])
    return F.element_at(lab, -best["neg_i"] + 1)


def predict_gaussian_nb(df: DataFrame, params: DataFrame, features: Sequence[str], label: str,
                        name: str = "prediction") -> DataFrame:
    """L3 SQL form, apply: argmax over classes of log prior + sum of log-likelihoods
    (ties go to the first class)."""
    ll, classes = nb_loglik_columns(df, params, features, label)
    scores = [F.col(f"__lp_{i}") + sum((F.col(f"__ll_{i}_{f}") for f in features), F.lit(0.0))
              for i in range(len(classes))]
    out = ll.withColumn(name, _argmax_class(scores, classes))
    return out.drop(*[c for c in out.columns if c.startswith("__l")])


def _class_moments(df: DataFrame, features: Sequence[str], label: str) -> tuple[list, dict[str, float]]:
    """Unsmoothed moments per class (model-sized: classes x features) and the variance of every feature."""
    rows = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f).alias(f"mu_{f}") for f in features], *[F.var_pop(f).alias(f"var_{f}") for f in features],
    ).orderBy(label).collect()
    return rows, df.agg(*[F.var_pop(f).alias(f) for f in features]).first().asDict()


def _subset_accuracy(moments: tuple[list, dict[str, float]], features: Sequence[str], label: str,
                     var_smoothing: float) -> Column:
    """Aggregate: accuracy of the naive Bayes model fitted on ``features`` alone, its own smoothing included."""
    rows, spread = moments
    total = sum(r["n"] for r in rows)
    eps = var_smoothing * max(spread[f] for f in features)
    scores = []
    for r in rows:
        score = F.lit(math.log(r["n"] / total))
        for f in features:
            var = max(r[f"var_{f}"] + eps, sys.float_info.min)
            score += F.lit(-0.5 * math.log(2 * math.pi * var)) - (F.col(f) - F.lit(r[f"mu_{f}"])) ** 2 / F.lit(2 * var)
        scores.append(score)
    return F.avg((_argmax_class(scores, [r[label] for r in rows]) == F.col(label)).cast("double"))


def stepwise_select(train: DataFrame, valid: DataFrame, features: Sequence[str], label: str,
                    direction: str = "forward", var_smoothing: float = 1e-9) -> DataFrame:
    """Forward selection / backward elimination for Gaussian naive
    Bayes by validation accuracy, over all sizes.

    The class moments are fitted once; the model of a subset follows from
    them, with the smoothing term of that subset. Each round scores all
    candidates in one aggregate. The path goes on to the last feature also
    when a round does not improve; ``best`` marks its highest accuracy (the
    fewest features among equals). Of candidates that tie, the first in
    ``features`` is taken. Returns (step, action, feature, n_features,
    accuracy, best); step 0 of the elimination is the set of all features.
    """
    moments = _class_moments(train, features, label)
    rows = valid.select(label, *features)

    def scores(sets: Mapping[str, Sequence[str]]) -> dict[str, float]:
        return rows.agg(*[_subset_accuracy(moments, fs, label, var_smoothing).alias(name)
                          for name, fs in sets.items()]).first().asDict()

    forward = direction == "forward"
    kept: list[str] = [] if forward else list(features)
    steps = [] if forward else [(0, "start", "*", len(kept), scores({"*": kept})["*"])]
    while len(kept) < len(features) if forward else len(kept) > 1:
        sets = {c: [f for f in features if (f in kept) != (f == c)] for c in features if (c in kept) != forward}
        found = scores(sets)
        pick = max(found, key=lambda c: (found[c], -features.index(c)))
        kept = sets[pick]
        steps.append((len(kept) if forward else len(features) - len(kept), "add" if forward else "remove",
                      pick, len(kept), found[pick]))
    top = max(steps, key=lambda s: (s[4], -s[3]))
    return train.sparkSession.createDataFrame(
        [(*s, s is top) for s in steps],
        "step int, action string, feature string, n_features int, accuracy double, best boolean")


def correlation_pruning(df: DataFrame, features: Sequence[str], label: str, threshold: float = 0.8) -> DataFrame:
    """For every pair of features with |corr| > threshold, drop the one with
    the lower mutual information with the label. Returns (kept, dropped, corr)."""
    from quarry.operators.stats import correlation_long, mutual_information

    c = correlation_long(df, features).where((F.col("var1") < F.col("var2")) & (F.abs("corr") > threshold))
    mi = mutual_information(df, features, label).select("feature", "mi")
    j = c.join(mi.select(F.col("feature").alias("var1"), F.col("mi").alias("mi1")), "var1").join(
        mi.select(F.col("feature").alias("var2"), F.col("mi").alias("mi2")), "var2")
    keep1 = F.col("mi1") >= F.col("mi2")
    return j.select(F.when(keep1, F.col("var1")).otherwise(F.col("var2")).alias("kept"),
                    F.when(keep1, F.col("var2")).otherwise(F.col("var1")).alias("dropped"), "corr")


# ---- K3: tree structure ------------------------------------------------------------------

def tree_nodes(model, path: str, feature_names: Sequence[str]) -> DataFrame:
    """K3: node table of a fitted decision tree (id, feature, threshold,
    impurity, gain, samples per class, prediction, children), read back from
    the saved model's data files under a stage folder (shared storage)."""
    model.write().overwrite().save(path)
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    nodes = spark.read.parquet(f"{path}/data")
    names = F.array(*[F.lit(n) for n in feature_names])
    split = F.col("split")
    return nodes.select(
        "id", F.when(F.col("leftChild") >= 0, F.element_at(names, split["featureIndex"] + 1)).alias("feature"),
        F.when(F.col("leftChild") >= 0, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        "impurity", "gain", F.col("impurityStats").alias("class_counts"), "prediction",
        "leftChild", "rightChild")
