
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ordering import global_running_sum, global_running_sums


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    """E1."""
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Counts per (actual, predicted), share of total and row percent (windows
    over the k x k table)."""
    c = df.groupBy(F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    total = Window.partitionBy(F.lit(1))
    row = Window.partitionBy("actual")
    return c.withColumn("share", F.col("n") / F.sum("n").over(total)).withColumn(
        "row_pct", 100.0 * F.col("n") / F.sum("n").over(row))


def binary_metrics(df: DataFrame, label: str, pred: str, positive=1) -> DataFrame:
    """Sensitivity (recall), specificity, precision, F1 for a chosen positive label."""
    y, p = F.col(label) == F.lit(positive), F.col(pred) == F.lit(positive)
    c = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(~y & ~p).alias("tn"),
               F.count_if(y & ~p).alias("fn"))
    # try_divide: an empty cell (no predicted positives, ...) gives NULL, not an error
    sens = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    spec = F.try_divide(F.col("tn"), F.col("tn") + F.col("fp"))
    prec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    acc = F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))
    return c.select("*", sens.alias("sensitivity"), spec.alias("specificity"), prec.alias("precision"),
                    F.try_divide(2 * prec * sens, prec + sens).alias("f1"), acc.alias("accuracy"))


def roc_table(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """One row per distinct score (descending): threshold, fpr, tpr.

    Positive / negative counts per distinct score, then distributed running
    sums in descending score order (no single-partition window).
    """
    y = (F.col(label) == F.lit(positive)).cast("long")
    per = df.groupBy(F.col(score).alias("threshold")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    tot = per.agg(F.struct(F.sum("pos").alias("P"), F.sum("neg").alias("N"))).scalar()
    b = global_running_sums(per, [F.desc("threshold")], {"pos": "tp", "neg": "fp"})
    return b.select("threshold", "tp", "fp", F.try_divide(F.col("fp").cast("double"), tot.N.cast("double")).alias("fpr"), F.try_divide(F.col("tp").cast("double"), tot.P.cast("double")).alias("tpr"))


def auc(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """E5: AUC by the rank-sum (Mann-Whitney) statistic, ties count half.

    Worked out from the counts per distinct score: every negative is below the
    positives of higher scores and level with half of those of its own score.
    Rows without a score or a label don't count; NULL with one class only.
    """
    y = (F.col(label) == F.lit(positive)).cast("long")
    per = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    r = global_running_sum(per, [F.desc("threshold")], "pos", "tp")
    wins = F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2)
    return r.agg(F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def best_thresholds(roc: DataFrame, min_sens: float = 0.85, min_spec: float = 0.5) -> DataFrame:
    """Threshold maximising sensitivity + specificity (first wins: highest
    threshold), and the extremes of the constrained region sens >= a, spec >= b."""
    spec = F.lit(1.0) - F.col("fpr")
    r = roc.withColumn("spec", spec).withColumn("j", F.col("tpr") + F.col("spec"))
    ok = (F.col("tpr") >= min_sens) & (F.col("spec") >= min_spec)
    return r.agg(
        F.max_by(F.struct("threshold", "tpr", "spec"), F.struct("j", "threshold")).alias("best"),
        F.max_by(F.struct("threshold", "tpr", "spec"), F.when(ok, F.struct("tpr", "threshold"))).alias("max_sens"),
        F.max_by(F.struct("threshold", "tpr", "spec"), F.when(ok, F.struct("spec", "threshold"))).alias("max_spec"),
    ).select(F.col("best.threshold").alias("best_threshold"), F.col("best.tpr").alias("best_sensitivity"),
             F.col("best.spec").alias("best_specificity"),
             F.col("max_sens.threshold").alias("hi_sens_threshold"), F.col("max_sens.tpr").alias("hi_sens_sensitivity"),
             F.col("max_sens.spec").alias("hi_sens_specificity"),
             F.col("max_spec.threshold").alias("hi_spec_threshold"), F.col("max_spec.tpr").alias("hi_spec_sensitivity"),
             F.col("max_spec.spec").alias("hi_spec_specificity"))


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """MSE, explained variance, prediction and label variance (population)."""
    e = F.col(label) - F.col(pred)
    return df.agg(F.avg(e * e).alias("mse"), (F.lit(1.0) - F.try_divide(F.var_pop(e), F.var_pop(label))).alias("explained_variance"),
                  F.var_pop(pred).alias("var_pred"), F.var_pop(label).alias("var_label"))


def comparison_table(metrics: Mapping[str, DataFrame]) -> DataFrame:
    """Long (model, metric, value) table from one-row metric frames."""
    out = None
    for model, m in metrics.items():
        cols = [c for c, t in m.dtypes if t in ("double", "float", "bigint", "int")]
        long = m.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "metric", "value")
        long = long.select(F.lit(model).alias("model"), "metric", "value")
        out = long if out is None else out.unionByName(long)
    return out
