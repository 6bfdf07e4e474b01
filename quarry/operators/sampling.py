"""

Every draw is a function of (key, seed) through md5 (``ordering.hash_unit``),
so a re-run after an executor loss, or the same query in another engine,
picks the same rows; ``rand()`` over an unordered frame would not.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import hash_digest, hash_unit, hash_unit_sql, join_null_safe, position_within, spread_out


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """B1: rows whose draw is below ``fraction`` (without replacement)."""
    return df.where(hash_unit(key, seed=seed) < F.lit(fraction))


def hash_split(df: DataFrame, key: str, test_fraction: float, seed: int = 0, name: str = "split") -> DataFrame:
    """B2: train/test tag by the key's draw."""
    return df.withColumn(name, F.when(hash_unit(key, seed=seed) < F.lit(test_fraction), F.lit("test"))
                         .otherwise(F.lit("train")))


def stratified_split(df: DataFrame, key: str, label: str, shares: Sequence[float], names: Sequence[str],
                     seed: int = 0, name: str = "split") -> DataFrame:
    """Exact per-class shares. Within each class rows are ordered by their
    draw; part i takes positions up to floor(n_class * cumulative share_i).

    Positions come from ``position_within`` (salted buckets), so a class
    holding a third of all rows is still spread over many tasks.
    """
    pos = position_within(df, [label], hash_unit(key, seed=seed), "__pos", tiebreak=[key])
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    x = join_null_safe(pos, sizes, [label])
    expr = F.lit(names[-1])
    cum = 0.0
    cuts = []
    for s, nm in zip(shares[:-1], names[:-1]):
        cum += s
        cuts.append((cum, nm))
    for cum_share, nm in reversed(cuts):
        expr = F.when(F.col("__pos") <= F.floor(F.col("__n") * F.lit(cum_share)), F.lit(nm)).otherwise(expr)
    return x.withColumn(name, expr).drop("__pos", "__n")


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed: int = 0, name: str = "fold") -> DataFrame:
    """fold = (position within class - 1) mod k, so each fold gets an equal share of every class."""
    pos = position_within(df, [label], hash_unit(key, seed=seed), "__pos", tiebreak=[key])
    return pos.withColumn(name, F.pmod(F.col("__pos") - 1, F.lit(k)).cast("int")).drop("__pos")


def _poisson1_cdf(kmax: int = 17) -> list[float]:
    out, term, acc = [], math.exp(-1.0), 0.0
    for k in range(kmax + 1):
        acc += term
        out.append(acc)
        term /= (k + 1)
    return out


POISSON1_CDF = _poisson1_cdf()


def poisson1(u: Column) -> Column:
    """Poisson(1) draw from a uniform by inverse CDF (cut points from e^-1 * sum 1/j!)."""
    expr = F.lit(len(POISSON1_CDF))
    for k in reversed(range(len(POISSON1_CDF))):
        expr = F.when(u < F.lit(POISSON1_CDF[k]), F.lit(k)).otherwise(expr)
    return expr


def poisson1_of_digest(digest: Column) -> Column:
    """:func:`poisson1` of :func:`hash_unit`, read off the md5's hex digits.

    The draw is n / 2^52 with n the first 13 digits, so u < c where n < c * 2^52;
    digits of equal length are ordered like their numbers, and those after the
    13th only tell a longer text from its equal beginning, which is not less.
    """
    expr = F.lit(len(POISSON1_CDF))
    for k, c in reversed(list(enumerate(POISSON1_CDF))):
        n = math.ceil(c * (1 << 52))
        expr = F.lit(k) if n >= 1 << 52 else F.when(digest < F.lit(f"{n:013x}"), F.lit(k)).otherwise(expr)
    return expr


def poisson1_sql(u: str) -> str:
    whens = " ".join(f"WHEN {u} < {c!r} THEN {k}" for k, c in enumerate(POISSON1_CDF))
    return f"(CASE {whens} ELSE {len(POISSON1_CDF)} END)"


def bootstrap_weights(df: DataFrame, key: str, replicates: int, seed: int = 0) -> DataFrame:
    """Poisson(1) bootstrap -- every row gets a weight in each replicate.

    The replicate index is generated per row and consumed by the partial
    aggregate of the caller in the same task, so the R-fold expansion is CPU
    only: it is never shuffled or stored. The rows are dealt out evenly before
    it: a table of few bytes is read by few tasks, whatever the draws cost.
    """
    spread = spread_out(df)
    x = spread.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    # the draw is its own column: the CASE chain then reads it instead of
    # re-evaluating the md5 in every branch
    x = x.withColumn("__d", hash_digest(key, "rep", seed=seed))
    # zero weights are kept (they add nothing to weighted sums); a filter on w
    # would be pushed below the projection and evaluate the md5 a second time
    return x.withColumn("w", poisson1_of_digest(F.col("__d"))).drop("__d")


def bootstrap_moments(df: DataFrame, key: str, value: str, replicates: int, seed: int = 0,
                      by: Sequence[str] = ()) -> DataFrame:
    """B5 + moments: weighted mean and sample sd of ``value`` per replicate (and group)."""
    w = bootstrap_weights(df.select(key, value, *by), key, replicates, seed)
    agg = w.groupBy(*by, "rep").agg(
        F.sum("w").alias("n"), F.sum(F.col("w") * F.col(value)).alias("sx"),
        F.sum(F.col("w") * F.col(value) * F.col(value)).alias("sxx"))
    mean = F.col("sx") / F.col("n")
    var = (F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")) / (F.col("n") - 1)
    return agg.select(*by, "rep", "n", mean.alias("mean"), F.sqrt(F.greatest(var, F.lit(0.0))).alias("sd"))


# ---- B5 on frequencies -----------------------------------------------------------------------

PIECES = (1, 2, 4, 8, 16)  # means with a table of cut points
BULK = 2 * PIECES[-1]  # copies beyond a multiple of this come from the pieces


def _poisson_cuts(mean: int) -> list[float]:
    """P(X <= k) for k = 0, 1, ... until it rounds to 1."""
    out, term, acc, k = [], math.exp(-mean), 0.0, 0
    while acc + term < 1.0 and (k <= mean or term > 1e-17):
        acc += term
        out.append(acc)
        k += 1
        term *= mean / k
    return out


POISSON_CUTS = {m: _poisson_cuts(m) for m in PIECES}


def poisson_of_count(count: Column, draw, pair) -> Column:
    """Poisson(count): the weight that ``count`` equal rows get together in one bootstrap replicate.

    The count is split by its binary digits below ``BULK``: each digit is a
    Poisson draw by inversion (``draw(i)``, a uniform per digit). The multiple of
    ``BULK`` is a normal draw (``pair``: two uniforms) with the Poisson's skewness,
    rounded; its distribution function is off by less than 0.002.
    """
    total = F.lit(0).cast("long")
    for i, m in enumerate(PIECES):
        u, chain = draw(i), F.lit(len(POISSON_CUTS[m]))
        for k in reversed(range(len(POISSON_CUTS[m]))):
            chain = F.when(u < F.lit(POISSON_CUTS[m][k]), F.lit(k)).otherwise(chain)
        total = total + F.when(F.floor(count / m) % 2 == 1, chain).otherwise(0)
    bulk = (F.floor(count / BULK) * BULK).cast("double")
    u1, u2 = pair
    z = F.sqrt(-2.0 * F.ln(1.0 - u1)) * F.cos(2.0 * math.pi * u2)
    many = F.greatest(F.floor(bulk + z * F.sqrt(bulk + 1.0 / 36.0) + (z * z - 1.0) / 6.0 + 0.5), F.lit(0)).cast("long")
    return total + F.when(bulk > 0, many).otherwise(0)


def poisson_of_count_sql(count: str, draw, pair) -> str:
    """The twin of :func:`poisson_of_count`."""
    parts = []
    for i, m in enumerate(PIECES):
        whens = " ".join(f"WHEN {draw(i)} < {c!r} THEN {k}" for k, c in enumerate(POISSON_CUTS[m]))
        parts.append(f"CASE WHEN ({count} // {m}) % 2 = 1 THEN CASE {whens} ELSE {len(POISSON_CUTS[m])} END ELSE 0 END")
    bulk = f"(({count} // {BULK}) * {BULK})::DOUBLE"
    z = f"(sqrt(-2.0 * ln(1.0 - {pair[0]})) * cos({2.0 * math.pi!r} * {pair[1]}))"
    parts.append(f"CASE WHEN {bulk} > 0 THEN greatest(floor({bulk} + {z} * sqrt({bulk} + 1.0 / 36.0) + ({z} * {z} - 1.0) / 6.0 + 0.5), 0)::BIGINT ELSE 0 END")
    return "(" + " + ".join(parts) + ")"


def bootstrap_frequency_moments(df: DataFrame, value: str, replicates: int, seed: int = 0, by: Sequence[str] = (),
                                key: Column | None = None) -> DataFrame:
    """B5 on the frequency table: (by..., rep, n, mean, sd), one weight per (distinct value, replicate).

    Equal rows are exchangeable, so their summed weight is one Poisson(count)
    draw: the cost follows the distinct values, not the rows. ``key`` names a
    value in the draws (default: its text form). Replicates without a row, or
    with one, have NULL moments.
    """
    freq = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    name = F.col("__v").cast("string") if key is None else key
    freq = freq.withColumn("__key", F.concat_ws("|", *[F.col(c).cast("string") for c in by], name))
    x = freq.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    tags = [*range(len(PIECES)), "a", "b"]
    # every draw its own column; those of digits that are not set are never looked at
    needed = [F.floor(F.col("__c") / m) % 2 == 1 for m in PIECES] + [F.col("__c") >= BULK] * 2
    x = x.withColumns({f"__u{t}": F.when(n, hash_unit("__key", "rep", F.lit(t), seed=seed)) for t, n in zip(tags, needed)})
    w = poisson_of_count(F.col("__c"), lambda i: F.col(f"__u{i}"), (F.col("__ua"), F.col("__ub")))
    v = F.col("__v").cast("double")
    agg = x.withColumn("w", w).groupBy(*by, "rep").agg(
        F.sum("w").alias("n"), F.sum(F.col("w") * v).alias("sx"), F.sum(F.col("w") * v * v).alias("sxx"))
    mean = F.try_divide(F.col("sx"), F.col("n").cast("double"))
    var = F.try_divide(F.col("sxx") - F.col("sx") * mean, (F.col("n") - 1).cast("double"))
    return agg.select(*by, "rep", "n", mean.alias("mean"), F.sqrt(F.greatest(var, F.lit(0.0))).alias("sd"))


def bootstrap_frequency_sql(source: str, value: str, key: str, replicates: int, seed: int, by: Sequence[str] = ()) -> str:
    """The twin of :func:`bootstrap_frequency_moments`."""
    groups = "".join(f"{c}, " for c in by)
    keys = [*by, key]
    name = f"concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)})"

    def unit(tag: object) -> str:
        return hash_unit_sql(["nm", "rep", f"'{tag}'"], seed)

    weight = poisson_of_count_sql("c", unit, (unit("a"), unit("b")))
    return f"""SELECT {groups}rep, sum(w) AS n, sum(w * v) / sum(w) AS mean,
        sqrt(greatest((sum(w * v * v) - sum(w * v) * sum(w * v) / sum(w)) / (sum(w) - 1), 0)) AS sd FROM (
      SELECT {groups}rep, v, {weight} AS w FROM (
        SELECT {groups}CAST({value} AS DOUBLE) AS v, {name} AS nm, count(*) AS c FROM {source} WHERE {value} IS NOT NULL GROUP BY ALL), range(1, {replicates + 1}) AS r(rep))
      GROUP BY {groups}rep"""
