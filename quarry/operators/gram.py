"""Regression and components from one table of cross moments.

One aggregate over the data gives n, the means and the centred cross products
of every two columns; they merge, so partial sums are what is shuffled. All
that follows works on that d x d result, like any fitted model's coefficients:
Cholesky for least squares, Jacobi rotations for components. Rows with a NULL in
any of the columns don't count. Nothing divides by zero: a column that others
determine is reported (``determined``) with a NULL coefficient, an exact fit has
NULL t and p.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.special import t_two_sided

CHUNK = 200  # products per aggregate expression list
SINGULAR = 1e-10  # pivot, as a share of the column's own sum of squares


@dataclass
class Moments:
    names: list[str]
    n: int
    mean: np.ndarray
    cross: np.ndarray  # centred sums of products


def cross_moments(df: DataFrame, columns: Sequence[str]) -> Moments:
    """n, means and centred cross products of the complete rows, one scan per ``CHUNK`` products."""
    x = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]).na.drop()
    d = len(columns)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    cross, mean, n = np.zeros((d, d)), np.zeros(d), 0
    for start in range(0, len(pairs), CHUNK):
        part = pairs[start : start + CHUNK]
        means = [F.avg(f"x{i}").alias(f"m{i}") for i in range(d)] if start == 0 else []
        row = x.agg(F.count(F.lit(1)).alias("n"), *means, *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in part]).first()
        n = row["n"]
        if not n:
            break
        if start == 0:
            mean = np.array([row[f"m{i}"] for i in range(d)])
        for i, j in part:
            cross[i, j] = cross[j, i] = row[f"c{i}_{j}"] * n
    return Moments(list(columns), n, mean, cross)


def vector_moments(df: DataFrame, array_col: str, d: int) -> Moments:
    """The same for an array column of ``d`` numbers: products are summed position by
    position, (i, j) -> value, so no wide expression is compiled."""
    x = df.select(F.col(array_col).cast("array<double>").alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") == d) & ~F.exists("v", lambda e: e.isNull()))
    head = x.agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(F.col("v")[i]) for i in range(d)]).alias("m")).first()
    if not head["n"]:
        return Moments([f"dim{i}" for i in range(d)], 0, np.zeros(d), np.zeros((d, d)))
    centre = F.array(*[F.lit(float(m)) for m in head["m"]])
    centred = x.select(F.zip_with("v", centre, lambda a, m: a - m).alias("v"))
    rows = centred.select(F.posexplode("v").alias("i", "a"), "v")
    products = [F.sum(F.col("a") * F.col("v")[j]).alias(f"c{j}") for j in range(d)]
    cross = np.zeros((d, d))
    for r in rows.groupBy("i").agg(*products).collect():  # d rows of d sums
        cross[r["i"]] = [r[f"c{j}"] for j in range(d)]
    return Moments([f"dim{i}" for i in range(d)], head["n"], np.array(head["m"]), (cross + cross.T) / 2)


def cholesky(a: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """(lower factor of the independent columns, their positions), columns in order."""
    kept: list[int] = []
    rows: list[np.ndarray] = []
    for k in range(len(a)):
        row = np.zeros(len(kept) + 1)
        for m, j in enumerate(kept):
            row[m] = (a[k, j] - row[:m] @ rows[m][:m]) / rows[m][m]
        pivot = a[k, k] - row[:-1] @ row[:-1]
        if a[k, k] > 0 and pivot > SINGULAR * a[k, k]:
            row[-1] = np.sqrt(pivot)
            kept.append(k)
            rows.append(row)
    low = np.zeros((len(kept), len(kept)))
    for i, row in enumerate(rows):
        low[i, : len(row)] = row
    return low, kept


def least_squares(m: Moments, y: str, xs: Sequence[str]) -> list[tuple]:
    """(term, coef, se, t, determined, r2, r2adj, df) of the regression of ``y`` on ``xs``, intercept last."""
    at = [m.names.index(x) for x in xs]
    t = m.names.index(y)
    low, kept = cholesky(m.cross[np.ix_(at, at)])
    inverse = np.linalg.inv(low) if len(kept) else np.zeros((0, 0))
    inverse = inverse.T @ inverse  # of the cross products of the kept columns
    used = [at[k] for k in kept]
    beta = inverse @ m.cross[used, t]
    syy = float(m.cross[t, t])
    sse = max(0.0, float(syy - beta @ m.cross[used, t]))
    if sse <= 1e-13 * syy:
        sse = 0.0  # an exact fit
    df = m.n - len(kept) - 1
    variance = sse / df if df > 0 else None
    r2 = 1.0 - sse / syy if syy > 0 else None
    r2adj = 1.0 - (1.0 - r2) * (m.n - 1) / df if r2 is not None and df > 0 else None

    def line(term: str, coef: float, spread: float) -> tuple:
        se = float(np.sqrt(variance * spread)) if variance is not None else None
        return term, float(coef), se, float(coef / se) if se else None, False, r2, r2adj, max(df, 0)

    out = []
    for k, x in enumerate(xs):
        if k in kept:
            i = kept.index(k)
            out.append(line(x, beta[i], inverse[i, i]))
        else:
            out.append((x, None, None, None, True, r2, r2adj, max(df, 0)))
    centre = m.mean[used]
    if m.n:
        out.append(line("intercept", m.mean[t] - beta @ centre, 1.0 / m.n + centre @ inverse @ centre))
    return out


def ols(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """(term, coef, se, t, p, determined, r2, r2adj, df), one scan."""
    rows = least_squares(cross_moments(df, [y, *xs]), y, xs)
    fitted = df.sparkSession.createDataFrame(
        rows, "term string, coef double, se double, t double, determined boolean, r2 double, r2adj double, df long")
    return fitted.select("term", "coef", "se", "t", t_two_sided("t", "df").alias("p"), "determined", "r2", "r2adj", "df")


def jacobi(a: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and eigenvectors in columns, by rotations.

    Signs are fixed: the entry of a vector with the largest absolute value (the
    first among equals, to nine digits) is positive.
    """
    a, n = a.astype(float).copy(), len(a)
    v = np.eye(n)
    for _ in range(sweeps):
        off = np.sqrt(np.sum(np.tril(a, -1) ** 2))
        if off <= 1e-14 * max(1e-300, np.sqrt(np.sum(a**2))):
            break
        for p in range(n - 1):
            for q in range(p + 1, n):
                if a[p, q] == 0.0:
                    continue
                theta = (a[q, q] - a[p, p]) / (2.0 * a[p, q])
                t = (1.0 if theta >= 0 else -1.0) / (abs(theta) + np.hypot(theta, 1.0))
                c = 1.0 / np.hypot(t, 1.0)
                s = t * c
                a[:, [p, q]] = np.column_stack([c * a[:, p] - s * a[:, q], s * a[:, p] + c * a[:, q]])
                a[[p, q], :] = np.vstack([c * a[p, :] - s * a[q, :], s * a[p, :] + c * a[q, :]])
                v[:, [p, q]] = np.column_stack([c * v[:, p] - s * v[:, q], s * v[:, p] + c * v[:, q]])
    order = np.argsort(-np.diag(a), kind="stable")
    values, v = np.diag(a)[order], v[:, order]
    for k in range(n):
        size = np.round(np.abs(v[:, k]), 9)
        if v[int(np.argmax(size)), k] < 0:
            v[:, k] = -v[:, k]
    return values, v


@dataclass
class Components:
    """Principal components of a set of columns or of an array column."""

    moments: Moments
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def fit(cls, moments: Moments) -> Components:
        values, vectors = jacobi(moments.cross / max(1, moments.n - 1))
        return cls(moments, np.maximum(values, 0.0), vectors)

    def explained(self, spark, k: int) -> DataFrame:
        """(component, variance, explained, cumulative); shares are NULL if nothing varies."""
        total = float(self.values.sum())
        share = self.values / total if total > 0 else None
        rows = [(i, float(self.values[i]), None if share is None else float(share[i]), None if share is None else float(share[: i + 1].sum()))
                for i in range(min(k, len(self.values)))]
        return spark.createDataFrame(rows, "component int, variance double, explained double, cumulative double")

    def loadings(self, spark, k: int) -> DataFrame:
        """(component, weights)."""
        return spark.createDataFrame(
            [(i, [float(w) for w in self.vectors[:, i]]) for i in range(min(k, len(self.values)))], "component int, weights array<double>")

    def scores(self, df: DataFrame, k: int, array_col: str | None = None, prefix: str = "pc") -> DataFrame:
        """The table with its first ``k`` scores as columns: native arithmetic, no UDF."""
        names = self.moments.names
        values = [F.col(array_col).cast("array<double>")[i] if array_col else F.col(c).cast("double") for i, c in enumerate(names)]
        x = F.array(*[v - F.lit(float(m)) for v, m in zip(values, self.moments.mean)])
        named = df.withColumn("__centred", x)
        for i in range(k):
            weights = F.array(*[F.lit(float(w)) for w in self.vectors[:, i]])
            dot = F.aggregate(F.zip_with("__centred", weights, lambda a, w: a * w), F.lit(0.0), lambda acc, e: acc + e)
            named = named.withColumn(f"{prefix}{i + 1}", dot)
        return named.drop("__centred")


def component_regression(df: DataFrame, array_col: str, d: int, y: str, k: int) -> DataFrame:
    """Regress ``y`` on the first ``k`` component scores of an array column."""
    fitted = Components.fit(vector_moments(df, array_col, d))
    return ols(fitted.scores(df.select(y, array_col), k, array_col), y, [f"pc{i + 1}" for i in range(k)])
