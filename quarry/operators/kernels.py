"""Kernel machines on Nystroem features.

One mechanism serves the RBF, polynomial and sigmoid kernels: ``m`` landmark rows
(drawn by the hash of a key) and the inverse square root of their kernel matrix
K turn a row x into phi(x) = K^(-1/2) (k(x, z_1), ..., k(x, z_m)), and phi(x).phi(y)
approximates k(x, y). Landmarks and K are model-sized (m x d and m x m numbers);
features are an array column, folded by higher-order functions, so the compiled
code does not grow with m.

Both losses are smooth, convex and minimised by L-BFGS: each evaluation is one
aggregate (the loss and m + 1 sums), and the search stops when the gradient or
the progress is small, not after a fixed number of steps.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import hash_unit


@dataclass(frozen=True)
class Kernel:
    """``rbf``: exp(-gamma |x - z|^2); ``poly``: (gamma x.z + coef0)^degree; ``sigmoid``: tanh(gamma x.z + coef0)."""

    kind: str = "rbf"
    gamma: float = 1.0
    degree: int = 3
    coef0: float = 0.0

    def matrix(self, x: np.ndarray, z: np.ndarray) -> np.ndarray:
        dot = x @ z.T
        if self.kind == "rbf":
            return np.exp(-self.gamma * np.maximum((x**2).sum(1)[:, None] + (z**2).sum(1) - 2 * dot, 0.0))
        inner = self.gamma * dot + self.coef0
        return inner**self.degree if self.kind == "poly" else np.tanh(inner)

    def column(self, x: Column, z: Column) -> Column:
        if self.kind == "rbf":
            gap = F.zip_with(x, z, lambda a, b: (a - b) * (a - b))
            return F.exp(-self.gamma * F.aggregate(gap, F.lit(0.0), lambda s, v: s + v))
        dot = F.aggregate(F.zip_with(x, z, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        inner = self.gamma * dot + self.coef0
        return F.pow(inner, F.lit(float(self.degree))) if self.kind == "poly" else F.tanh(inner)


def _literal(rows: np.ndarray) -> Column:
    return F.array(*[F.array(*[F.lit(float(v)) for v in r]) for r in rows])


@dataclass
class Nystroem:
    kernel: Kernel
    columns: list[str]
    landmarks: np.ndarray
    root: np.ndarray  # K^(-1/2); directions that K does not have are left out

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], key: str, kernel: Kernel, m: int = 32, seed: int = 0) -> Nystroem:
        """Landmarks: the ``m`` complete rows with the smallest draws of their key (a top-n, nothing is sorted whole)."""
        rows = df.select(hash_unit(key, seed=seed).alias("__u"), *[F.col(c).cast("double").alias(c) for c in columns]).na.drop()
        z = np.unique(np.array([[r[c] for c in columns] for r in rows.orderBy("__u", *columns).limit(m).collect()], float).reshape(-1, len(columns)), axis=0)
        values, vectors = np.linalg.eigh(kernel.matrix(z, z)) if len(z) else (np.zeros(0), np.zeros((0, 0)))
        keep = np.abs(values) > 1e-10 * max(1e-300, np.abs(values).max(initial=0.0))
        # sigmoid kernels are indefinite: |value| keeps the features real
        root = (vectors[:, keep] / np.sqrt(np.abs(values[keep]))) @ vectors[:, keep].T
        return cls(kernel, list(columns), z, root)

    def apply(self, df: DataFrame, name: str = "phi") -> DataFrame:
        """The table with its feature array; NULL where a column is."""
        x = F.array(*[F.col(c).cast("double") for c in self.columns])
        complete = F.concat_ws("", *[F.when(F.col(c).isNull(), "n") for c in self.columns]) == ""
        near = F.transform(_literal(self.landmarks), lambda z: self.kernel.column(F.col("__x"), z))
        dots = F.transform(_literal(self.root), lambda r: F.aggregate(
            F.zip_with(r, F.col("__k"), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))
        out = df.withColumn("__x", F.when(complete, x)).withColumn("__k", F.when(F.col("__x").isNotNull(), near))
        return out.withColumn(name, F.when(F.col("__k").isNotNull(), dots)).drop("__x", "__k")


def minimise(value_and_slope: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, most: int = 100,
             tolerance: float = 1e-6, memory: int = 10) -> tuple[np.ndarray, float, int]:
    """L-BFGS with a backtracking search: (point, value, evaluations).

    It stops at a gradient of ``tolerance`` times the first one, when a step
    gains less than ``tolerance``^2 of the value, or after ``most`` evaluations.
    """
    x = start.astype(float)
    value, slope = value_and_slope(x)
    first, used, pairs = float(np.linalg.norm(slope)), 1, []
    while used < most and np.linalg.norm(slope) > tolerance * max(first, 1e-300):
        q, alphas = slope.copy(), []
        for s, y in reversed(pairs):
            alphas.append((s @ q) / (y @ s))
            q = q - alphas[-1] * y
        if pairs:
            s, y = pairs[-1]
            q = q * ((s @ y) / (y @ y))
        for (s, y), a in zip(pairs, reversed(alphas)):
            q = q + s * (a - (y @ q) / (y @ s))
        step, drop = (1.0 if pairs else 1.0 / max(1.0, first)), float(slope @ q)
        while True:
            after, after_slope = value_and_slope(x - step * q)
            used += 1
            if after <= value - 1e-4 * step * drop or used >= most or step < 1e-10:
                break
            step /= 2
        if after >= value:
            break
        s, y = -step * q, after_slope - slope
        if s @ y > 1e-12 * np.linalg.norm(s) * np.linalg.norm(y):
            pairs = [*pairs, (s, y)][-memory:]
        gained, x, value, slope = value - after, x - step * q, after, after_slope
        if gained <= tolerance**2 * max(abs(value), 1e-300):
            break
    return x, value, used


@dataclass
class Linear:
    """Weights of the features, then the intercept."""

    weights: np.ndarray
    objective: float
    evaluations: int

    def score(self, phi: str = "phi") -> Column:
        w = F.array(*[F.lit(float(v)) for v in self.weights[:-1]])
        return F.aggregate(F.zip_with(phi, w, lambda a, b: a * b), F.lit(float(self.weights[-1])), lambda s, v: s + v)


def _fit(rows: DataFrame, size: int, loss: Callable[[Column], tuple[Column, Column]], reg: float, most: int, tolerance: float) -> Linear:
    """Minimise reg/2 |w|^2 + the weighted mean loss over (phi, y, w); ``loss`` gives value and slope from the score."""
    total = rows.agg(F.sum("w")).first()[0]
    if not total:
        return Linear(np.zeros(size + 1), 0.0, 0)

    def evaluate(weights: np.ndarray) -> tuple[float, np.ndarray]:
        value, slope = loss(Linear(weights, 0.0, 0).score())
        found = rows.select("phi", (F.col("w") * value).alias("v"), (F.col("w") * slope).alias("g")).agg(
            F.sum("v").alias("v"), F.sum("g").alias("b"), *[F.sum(F.col("g") * F.col("phi")[i]).alias(f"g{i}") for i in range(size)]).first()
        gradient = np.array([found[f"g{i}"] for i in range(size)] + [found["b"]]) / total
        gradient[:-1] += reg * weights[:-1]
        return found["v"] / total + reg / 2 * float(weights[:-1] @ weights[:-1]), gradient

    weights, value, used = minimise(evaluate, np.zeros(size + 1), most, tolerance)
    return Linear(weights, value, used)


def _rows(df: DataFrame, phi: str, y: Column, weight: Column | None) -> DataFrame:
    w = F.lit(1.0) if weight is None else weight.cast("double")
    picked = df.select(F.col(phi).alias("phi"), y.cast("double").alias("y"), w.alias("w"))
    return picked.where("phi IS NOT NULL AND y IS NOT NULL AND w > 0").checkpoint()


def fit_classifier(df: DataFrame, phi: str, positive: Column, weight: Column | None = None, reg: float = 1e-3,
                   most: int = 100, tolerance: float = 1e-4) -> Linear:
    """Squared hinge loss; score > 0 means ``positive``."""
    rows = _rows(df, phi, F.when(positive, 1.0).when(~positive, -1.0), weight)
    size = (rows.select(F.size("phi")).first() or [0])[0]

    def loss(score: Column) -> tuple[Column, Column]:
        short = F.greatest(1.0 - F.col("y") * score, F.lit(0.0))
        return short * short, -2.0 * F.col("y") * short

    return _fit(rows, size, loss, reg, most, tolerance)


def fit_regressor(df: DataFrame, phi: str, y: str, epsilon: float = 0.1, reg: float = 1e-3, smooth: float = 0.1,
                  weight: Column | None = None, most: int = 100, tolerance: float = 1e-4) -> Linear:
    """Epsilon-insensitive loss, rounded to a parabola within ``smooth`` of the tube's edge."""
    rows = _rows(df, phi, F.col(y), weight)
    size = (rows.select(F.size("phi")).first() or [0])[0]

    def loss(score: Column) -> tuple[Column, Column]:
        gap = F.col("y") - score
        over = F.greatest(F.abs(gap) - epsilon, F.lit(0.0))
        value = F.when(over < smooth, over * over / (2.0 * smooth)).otherwise(over - smooth / 2.0)
        return value, -F.signum(gap) * F.least(over / smooth, F.lit(1.0))

    return _fit(rows, size, loss, reg, most, tolerance)


def balanced_weights(df: DataFrame, label: Column) -> Column:
    """n / (2 n_class) of a two-class label, as a column (two numbers from one aggregate)."""
    n, ones = df.agg(F.count(label), F.count_if(label)).first()
    return F.when(label, F.lit(n / (2.0 * ones) if ones else 0.0)).otherwise(F.lit(n / (2.0 * (n - ones)) if n > ones else 0.0))


def kernel_table(train: DataFrame, test: DataFrame, columns: Sequence[str], key: str, label: str, kernels: Sequence[Kernel],
                 m: int = 32, reg: float = 1e-3, seed: int = 0, tolerance: float = 1e-4) -> DataFrame:
    """Every kernel with and without class weights: accuracy, sensitivity, specificity, objective, evaluations."""
    rows = []
    for kernel in kernels:
        features = Nystroem.fit(train, columns, key, kernel, m, seed)
        mapped, held = features.apply(train).checkpoint(), features.apply(test).checkpoint()
        y = F.col(label) == 1
        for weighted in (False, True):
            model = fit_classifier(mapped, "phi", y, balanced_weights(mapped, y) if weighted else None, reg, tolerance=tolerance)
            said = model.score() > 0
            r = held.agg(F.avg((said == y).cast("double")), F.avg(F.when(y, said.cast("double"))), F.avg(F.when(~y, (~said).cast("double")))).first()
            rows.append((kernel.kind, kernel.degree if kernel.kind == "poly" else None, weighted, *r, float(model.objective), model.evaluations))
    return train.sparkSession.createDataFrame(
        rows, "kernel string, degree int, weighted boolean, accuracy double, sensitivity double, specificity double, objective double, evaluations int")
