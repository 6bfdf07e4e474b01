"""Cross-validation by complement (L9, L10): every training set is the total minus its fold.

Models whose fit needs only sums (Gaussian naive Bayes, least squares) take one
scan for the sums of every fold and one to score all folds, however many folds
there are. The sums are counts, means and centred moments, so taking a fold
away loses no digits to large means. Metrics come from one small table per model
and are reported per fold and as means and standard deviations.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.special import t_two_sided
from quarry.operators.gram import Moments, least_squares


def _without(n: float, mean: np.ndarray, m2: np.ndarray, n_f: float, mean_f: np.ndarray, m2_f: np.ndarray) -> tuple:
    """(n, mean, centred products) of all rows but those of a fold."""
    left = n - n_f
    if left <= 0:
        return 0, np.zeros_like(mean), np.zeros_like(m2)
    rest = (n * mean - n_f * mean_f) / left
    gap = mean_f - rest
    products = np.outer(gap, gap) if m2.ndim == 2 else gap * gap
    return left, rest, m2 - m2_f - products * (left * n_f / n)


def _merged(parts: Sequence[tuple]) -> tuple:
    """(n, mean, centred products) of several disjoint sets of rows."""
    n = sum(p[0] for p in parts)
    if not n:
        return 0, np.zeros_like(parts[0][1]), np.zeros_like(parts[0][2])
    mean = sum(p[0] * p[1] for p in parts) / n
    m2 = 0
    for size, m, s in parts:
        gap = m - mean
        m2 = m2 + s + size * (np.outer(gap, gap) if s.ndim == 2 else gap * gap)
    return n, mean, m2


def _pick(values: Sequence[float | None], fold: str) -> Column:
    """The value of a row's fold."""
    return F.element_at(F.array(*[F.lit(None if v is None else float(v)).cast("double") for v in values]), F.col(fold) + 1)


# ---- naive Bayes -----------------------------------------------------------------------------


def nb_fold_models(df: DataFrame, features: Sequence[str], label: str, fold: str, folds: int,
                   var_smoothing: float = 1e-9) -> tuple[list, list[list[dict | None]]]:
    """(classes, per fold and class: log prior, means, variances) of the models without each fold.

    One aggregate per (fold, class); a class that only its own fold holds has no model there.
    """
    rows = df.where(F.col(label).isNotNull() & F.col(fold).isNotNull()).groupBy(fold, label).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f"m_{i}") for i, f in enumerate(features)],
        *[F.var_pop(f).alias(f"v_{i}") for i, f in enumerate(features)]).collect()  # folds x classes
    d = len(features)
    classes = sorted({r[label] for r in rows})
    if not classes:
        return [], []
    empty = (0, np.zeros(d), np.zeros(d))
    part = {(r[fold], r[label]): (r["n"], np.array([r[f"m_{i}"] for i in range(d)], float),
                                  r["n"] * np.array([r[f"v_{i}"] for i in range(d)], float)) for r in rows}
    whole = {c: _merged([part.get((f, c), empty) for f in range(folds)]) for c in classes}
    models = []
    for f in range(folds):
        train = {c: _without(*whole[c], *part.get((f, c), empty)) for c in classes}
        n, _, spread = _merged(list(train.values()))
        eps = var_smoothing * float(np.max(spread)) / n if n else 0.0
        models.append([
            {"prior": math.log(train[c][0] / n), "mean": train[c][1],
             "var": np.maximum(train[c][2] / train[c][0] + eps, sys.float_info.min)} if train[c][0] else None for c in classes])
    return classes, models


def nb_cross_predict(df: DataFrame, features: Sequence[str], label: str, fold: str, folds: int,
                     var_smoothing: float = 1e-9, name: str = "prediction") -> DataFrame:
    """Every row scored by the model that has not seen its fold; ties go to the first class."""
    classes, models = nb_fold_models(df, features, label, fold, folds, var_smoothing)
    if not classes:
        return df.withColumn(name, F.lit(None).cast(df.schema[label].dataType))
    best = None
    for i in range(len(classes)):
        of = [m[i] for m in models]
        score = _pick([None if m is None else m["prior"] - 0.5 * float(np.log(2 * math.pi * m["var"]).sum()) for m in of], fold)
        for j, f in enumerate(features):
            gap = F.col(f) - _pick([None if m is None else m["mean"][j] for m in of], fold)
            score = score - gap * gap / _pick([None if m is None else 2.0 * m["var"][j] for m in of], fold)
        place = F.when(score.isNotNull(), F.struct(score.alias("s"), F.lit(-i).alias("i")))
        best = place if best is None else F.greatest(best, place)
    found = F.element_at(F.array(*[F.lit(c) for c in classes]), 1 - best["i"])
    return df.withColumn(name, found)


def class_metrics(scored: DataFrame, label: str, pred: str, fold: str) -> DataFrame:
    """(fold, metric, value): accuracy, and precision, recall and F1 averaged over the classes of a fold."""
    cells = scored.where(F.col(label).isNotNull() & F.col(pred).isNotNull()).groupBy(
        F.col(fold).alias("fold"), F.col(label).alias("y"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    long = cells.select("fold", F.explode(F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("actual"), F.lit(0).alias("said"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("p").alias("c"), F.lit(0).alias("actual"), F.col("n").alias("said"), F.lit(0).alias("hit")))).alias("x"))
    per = long.select("fold", "x.*").groupBy("fold", "c").agg(F.sum("actual").alias("actual"), F.sum("said").alias("said"), F.sum("hit").alias("hit"))

    def rate(top: Column, bottom: Column) -> Column:  # 0 where a class was never there or never said
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    wide = per.groupBy("fold").agg(
        F.try_divide(F.sum("hit").cast("double"), F.sum("actual").cast("double")).alias("accuracy"),
        F.avg(rate(F.col("hit"), F.col("said"))).alias("precision"), F.avg(rate(F.col("hit"), F.col("actual"))).alias("recall"),
        F.avg(rate(2 * F.col("hit"), F.col("said") + F.col("actual"))).alias("f1"))
    return wide.unpivot(["fold"], ["accuracy", "precision", "recall", "f1"], "metric", "value")


def cross_validate_nb(df: DataFrame, features: Sequence[str], label: str, fold: str, folds: int,
                      var_smoothing: float = 1e-9) -> DataFrame:
    """(fold, metric, value) of naive Bayes over all folds, two scans."""
    scored = nb_cross_predict(df, features, label, fold, folds, var_smoothing, "__p")
    return class_metrics(scored, label, "__p", fold)


# ---- least squares ---------------------------------------------------------------------------


def ols_fold_models(df: DataFrame, y: str, xs: Sequence[str], fold: str, folds: int) -> list[dict | None]:
    """Coefficients (by term) of the regression without each fold; NULL for terms that others determine."""
    columns = [y, *xs]
    d = len(columns)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    rows = df.select(F.col(fold).alias("__f"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]).na.drop().groupBy("__f").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(d)],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in pairs]).collect()  # one row per fold
    part = {}
    for r in rows:
        cross = np.zeros((d, d))
        for i, j in pairs:
            cross[i, j] = cross[j, i] = r[f"c{i}_{j}"] * r["n"]
        part[r["__f"]] = (r["n"], np.array([r[f"m{i}"] for i in range(d)]), cross)
    empty = (0, np.zeros(d), np.zeros((d, d)))
    whole = _merged([part.get(f, empty) for f in range(folds)])
    out = []
    for f in range(folds):
        n, mean, cross = _without(*whole, *part.get(f, empty))
        out.append({t[0]: t[1] for t in least_squares(Moments(columns, n, mean, cross), y, xs)} if n else None)
    return out


def cross_validate_ols(df: DataFrame, y: str, xs: Sequence[str], fold: str, folds: int) -> DataFrame:
    """L9 for regression: (fold, metric, value) with mse, mae, r2 and explained variance, two scans."""
    models = ols_fold_models(df, y, xs, fold, folds)
    pred = _pick([None if m is None else m["intercept"] for m in models], fold)
    for x in xs:
        pred = pred + F.col(x) * _pick([None if m is None else m[x] or 0.0 for m in models], fold)
    e = F.col(y) - pred
    wide = df.where(F.col(fold).isNotNull()).groupBy(F.col(fold).alias("fold")).agg(
        F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.avg(e * e), F.var_pop(F.when(e.isNotNull(), F.col(y))))).alias("r2"),
        (F.lit(1.0) - F.try_divide(F.var_pop(e), F.var_pop(F.when(e.isNotNull(), F.col(y))))).alias("explained_variance"))
    return wide.unpivot(["fold"], ["mse", "mae", "r2", "explained_variance"], "metric", "value")


# ---- reports -----------------------------------------------------------------------------------


def metric_summary(folds: DataFrame) -> DataFrame:
    """Per metric the mean, sd, least and largest value over the folds."""
    return folds.groupBy("metric").agg(F.count("value").alias("folds"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"),
                                       F.min("value").alias("min"), F.max("value").alias("max"))


def compare_models(models: Mapping[str, DataFrame], a: str, b: str) -> DataFrame:
    """Welch t-test of two models' fold values, for every metric: means, t, df and p.

    NULL where the folds of both models do not vary.
    """
    both = models[a].withColumn("m", F.lit(0)).unionByName(models[b].withColumn("m", F.lit(1)))

    def of(m: int, f) -> Column:
        return f(F.when(F.col("m") == m, F.col("value")))

    s = both.groupBy("metric").agg(*[of(m, f).alias(f"{n}{m}") for m in (0, 1) for n, f in (("n", F.count), ("mean", F.avg), ("v", F.var_samp))])
    v0, v1 = (F.try_divide(F.col(f"v{m}"), F.col(f"n{m}").cast("double")) for m in (0, 1))
    t = F.try_divide(F.col("mean0") - F.col("mean1"), F.sqrt(v0 + v1))
    df = F.try_divide((v0 + v1) ** 2, F.try_divide(v0 ** 2, (F.col("n0") - 1).cast("double")) + F.try_divide(v1 ** 2, (F.col("n1") - 1).cast("double")))
    out = s.select("metric", F.col("mean0").alias("mean1"), F.col("mean1").alias("mean2"), t.alias("t"), df.alias("df"))
    return out.withColumn("p", t_two_sided("t", "df"))
