"""

Drawing is left to any plotting tool; what leaves Spark is a table whose
size depends on the chart (bins, grid points, groups), not on the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import distributions as D
from quarry.operators.aggregates import group_quantiles
from quarry.operators.ordering import join_null_safe
from quarry.operators.sampling import hash_sample


def equal_width_bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Bin index 0..bins-1 of ``x`` in [lo, hi]; the maximum falls in the last bin."""
    w = (hi - lo) / bins
    return F.least(F.floor((x - lo) / F.when(w == 0, F.lit(1.0)).otherwise(w)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, col: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram (range from one min/max scalar subquery): bin,
    lo, hi, count, density = count / (N * width)."""
    r = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("n"))).scalar()
    w = (r.hi - r.lo) / bins
    b = equal_width_bin(F.col(col), r.lo, r.hi, bins)
    out = df.where(F.col(col).isNotNull()).groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return out.select(*by, "bin", (r.lo + F.col("bin") * w).alias("lo"), (r.lo + (F.col("bin") + 1) * w).alias("hi"),
                      "count", F.try_divide(F.col("count").cast("double"), (r.n * w).cast("double")).alias("density"))


def box_stats(df: DataFrame, group: str, value: str, exact: bool = True) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (most extreme data inside the fences) and outlier count per group."""
    quart = group_quantiles(df, [group], [value], [0.25, 0.5, 0.75], exact).select(
        group, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    # value frequencies, not raw rows, meet the quartiles: a hot group is pre-aggregated
    freq = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("__n"))
    j = join_null_safe(freq, quart, [group])
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    inside = (F.col(value) >= lo_f) & (F.col(value) <= hi_f)
    return j.groupBy(group, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_lo"),
        F.max(F.when(inside, F.col(value))).alias("whisker_hi"),
        F.sum(F.when(inside, 0).otherwise(F.col("__n"))).alias("n_outliers"), F.sum("__n").alias("n"))


def grid_counts(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """2-D bin counts (square cells on a bins x bins grid)."""
    r = df.agg(F.struct(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"),
                        F.max(y).alias("y1"))).scalar()
    bx = equal_width_bin(F.col(x), r.x0, r.x1, bins)
    by = equal_width_bin(F.col(y), r.y0, r.y1, bins)
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(bx.alias("bx"), by.alias("by")).agg(
        F.count(F.lit(1)).alias("count"))


def qq_points(df: DataFrame, col: str, points: int = 100) -> DataFrame:
    """C4: sample quantiles at p_i = (i - 0.5) / m against the normal
    quantiles of the fitted line (mean + sd * z_i)."""
    probs = [(i - 0.5) / points for i in range(1, points + 1)]
    z = [D.normal_ppf(p) for p in probs]
    q = group_quantiles(df, [], [col], probs).select("q").scalar()
    s = df.agg(F.struct(F.avg(col).alias("m"), F.stddev_samp(col).alias("sd"))).scalar()
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("i"))
    zarr = F.array(*[F.lit(v) for v in z])
    return grid.select("i", F.element_at(zarr, F.col("i") + 1).alias("theoretical"),
                       F.element_at(q, F.col("i") + 1).alias("sample"),
                       (s.m + s.sd * F.element_at(zarr, F.col("i") + 1)).alias("line"))


def bars(df: DataFrame, cat: str, hue: str, value: str) -> DataFrame:
    """Mean and count bars per category and hue."""
    return df.groupBy(cat, hue).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("count"))


def kde(df: DataFrame, col: str, group: str, points: int = 64, bins: int = 1024) -> DataFrame:
    """Gaussian kernel density per group on an evenly spaced grid (binned KDE).

    Values are first reduced to (group, bin centre, count) on ``bins`` equal
    bins of the group's range; the grid (``points`` per group, generated with
    ``explode(sequence)``) is joined to that table on the group, so the work
    is groups x points x bins whatever the row count. Bandwidth: Scott's rule
    sd * n^(-1/5). Frequencies of values, not raw rows, meet the group table; a
    NULL group is a group; the density of a constant or one-row group is NULL.
    """
    g = df.groupBy(group).agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.stddev_samp(col).alias("sd"),
                              F.count(col).alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    freq = df.where(F.col(col).isNotNull()).groupBy(group, col).agg(F.count(F.lit(1)).alias("__c"))
    x = join_null_safe(freq, g.select(group, "lo", "hi"), [group])
    b = F.least(F.floor((F.col(col) - F.col("lo")) / F.when(width == 0, F.lit(1.0)).otherwise(width)),
                F.lit(bins - 1))
    vals = x.groupBy(group, b.alias("__bin"), "lo", "hi").agg(F.sum("__c").alias("c")).select(
        group, (F.col("lo") + (F.col("__bin") + 0.5) * (F.col("hi") - F.col("lo")) / bins).alias("__centre"), "c")
    g = g.withColumn("h", F.col("sd") * F.pow(F.col("n"), -0.2)).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    g = g.withColumn("x", F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / (points - 1))
    j = join_null_safe(g, vals, [group])
    k = F.col("c") * F.exp(-0.5 * F.try_divide(F.col("x") - F.col("__centre"), F.col("h")) ** 2)
    return j.groupBy(group, "i", "x").agg(F.try_divide(F.sum(k), F.first("n") * F.first("h") * F.lit(2.5066282746310002))
                                          .alias("density"))


def scatter_sample(df: DataFrame, key: str, cols: Sequence[str], fraction: float, highlight: Column,
                   seed: int = 0) -> DataFrame:
    """Bounded reproducible sample for point charts plus a highlight flag."""
    return hash_sample(df, key, fraction, seed).select(key, *cols, highlight.cast("int").alias("highlight"))


def time_series(df: DataFrame, key: str, ts: Column, measures: Sequence[str]) -> DataFrame:
    """Measures per (facet key, time step)."""
    return df.groupBy(key, ts.alias("t")).agg(F.count(F.lit(1)).alias("n"),
                                              *[F.avg(m).alias(f"mean_{m}") for m in measures])


def fitted_line(df: DataFrame, y: str, x: str) -> DataFrame:
    """Two points of the least-squares line at the x range ends."""
    f = df.agg(F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a"), F.min(x).alias("x0"),
               F.max(x).alias("x1"))
    return f.select(F.explode(F.array(F.col("x0"), F.col("x1"))).alias("x"), "a", "b").select(
        "x", (F.col("a") + F.col("b") * F.col("x")).alias("y"))
