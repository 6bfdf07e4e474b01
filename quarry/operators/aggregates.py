"""

All of them are one ``groupBy``/``agg`` (partial + final hash aggregation, so a
hot key is pre-aggregated in every task before the shuffle) or a global
aggregate used as a scalar subquery.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from quarry.functions.rounding import rnd
from quarry.operators.ordering import global_running_sum, join_null_safe


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def group_means(df: DataFrame, by: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """A1: mean of every numeric column per group (``groupby(k).mean()``)."""
    cols = list(cols) if cols is not None else numeric_columns(df, exclude=by)
    return df.groupBy(*by).agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])


def group_sum_count(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """A2: sum and count of one value per group."""
    return df.groupBy(*by).agg(F.sum(value).alias(f"sum_{value}"), F.count(value).alias(f"count_{value}"))


def quantile_expr(c: str | Column, probs: Sequence[float], exact: bool = True) -> Column:
    """Quantiles with linear interpolation (exact) or the bounded-memory sketch.

    ``exact=True`` (the oracle's semantics) keeps a value->count map per group;
    for high-cardinality columns at scale pass ``exact=False`` which uses
    ``percentile_approx`` (mergeable sketch, fixed memory per group).
    """
    col = F.col(c) if isinstance(c, str) else c
    if exact:
        return F.percentile(col, F.array(*[F.lit(float(p)) for p in probs]))
    return F.percentile_approx(col, [float(p) for p in probs], 10000)


def sorted_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles (linear interpolation) of one column through a distributed sort.

    For columns with too many distinct values for ``percentile``'s
    value->count map: the non-null values get their global position (range
    sort + checkpoint, see ``ordering``), the rows at the floor / ceiling of
    every position ``p * (n - 1)`` are kept (2 per quantile) and interpolated.
    Equal values are put in the order of a hash of their row, so a value that
    many rows share is sorted by many tasks.
    Returns one row per probability: (p, value).
    """
    from quarry.operators.ordering import global_row_number

    tie = F.xxhash64(*[F.col(c) for c, t in df.dtypes if "map" not in t and "variant" not in t])
    x = df.select(F.col(col).cast("double").alias("v"), tie.alias("tie")).where(F.col("v").isNotNull())
    n = x.agg(F.count(F.lit(1))).scalar()
    numbered = global_row_number(x, [F.asc("v"), F.asc("tie")], "rn")  # 1-based
    spark = df.sparkSession
    ps = spark.range(len(probs)).select(
        F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("id").cast("int") + 1).alias("p"))
    pos = ps.withColumn("pos", F.col("p") * (n - 1)).withColumn("lo", F.floor("pos") + 1).withColumn(
        "hi", F.ceil("pos") + 1)
    wanted = pos.select(F.explode(F.array("lo", "hi")).alias("rn")).distinct()
    # at most 2 * len(probs) rows survive the semi join
    picked = numbered.join(F.broadcast(wanted), "rn", "left_semi")
    lo = picked.select(F.col("rn").alias("lo"), F.col("v").alias("v_lo"))
    hi = picked.select(F.col("rn").alias("hi"), F.col("v").alias("v_hi"))
    j = pos.join(F.broadcast(lo), "lo").join(F.broadcast(hi), "hi")
    return j.select("p", (F.col("v_lo") + (F.col("pos") - (F.col("lo") - 1)) * (F.col("v_hi") - F.col("v_lo")))
                    .alias("value"))


def group_quantiles(df: DataFrame, by: Sequence[str], cols: Sequence[str], probs: Sequence[float],
                    exact: bool = True) -> DataFrame:
    """(by..., column, q array): quantiles of several columns per group, linear interpolation.

    The frequency table of (group, column, value) gets one distributed running
    count, which gives every value its range of positions; the values at the
    floor and ceiling of ``p * (n - 1)`` are all that is left of a group. No task holds the values of a group. Groups without a value have no row;
    a column may be in ``by`` as well. ``exact=False`` is the bounded sketch
    of :func:`quantile_expr`.
    """
    keys = [f"__by_{i}" for i in range(len(by))]
    long = df.select(
        *[F.col(c).alias(k) for c, k in zip(by, keys)], *[F.col(c).cast("double").alias(c) for c in cols]
    ).unpivot(keys, list(cols), "column", "__v").where(F.col("__v").isNotNull())
    names = [F.col(k).alias(c) for c, k in zip(by, keys)]
    keys.append("column")
    if not exact:
        return long.groupBy(*keys).agg(quantile_expr("__v", probs, False).alias("q")).select(*names, "column", "q")
    freq = long.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n"))
    cum = global_running_sum(freq, [*keys, "__v"], "__n", "__cum")
    groups = cum.groupBy(*keys).agg(F.sum("__n").alias("__t"), F.min(F.col("__cum") - F.col("__n")).alias("__off"))
    last = F.col("__cum") - F.col("__off") - 1  # positions count from 0
    first = last - F.col("__n") + 1
    steps = F.array(*[F.lit(float(p)) for p in probs])

    def position(p: Column) -> Column:
        return p * (F.col("__t") - 1)

    # entry 2i / 2i + 1: the positions below and above quantile i; they are worked out once per group,
    # and a value keeps those inside its range
    ends = F.flatten(F.transform(steps, lambda p: F.array(F.floor(position(p)), F.ceil(position(p)))))
    asked = groups.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__t", "__off", F.posexplode(ends).alias("__i", "__at"))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys))
    # without groups there is one row per column and probability
    found = cum.join(asked if by else F.broadcast(asked), same & (first <= F.col("__at")) & (F.col("__at") <= last))
    picked = found.groupBy(*keys, "__t").agg(
        F.map_from_entries(F.collect_list(F.struct("__i", "__v"))).alias("__m"))  # two entries a quantile

    def between(p: Column, i: Column) -> Column:
        lo, hi, part = F.col("__m")[2 * i], F.col("__m")[2 * i + 1], position(p) - F.floor(position(p))
        return F.when(lo == hi, lo).otherwise(lo * (1 - part) + hi * part)

    q = F.transform(steps, between)
    return picked.select(*names, "column", q.alias("q"))


def group_describe(df: DataFrame, by: Sequence[str], value: str, exact: bool = True) -> DataFrame:
    """A3: n, mean, sample sd, min, quartiles, max per group."""
    stats = df.groupBy(*by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"))
    q = group_quantiles(df, by, [value], [0.25, 0.5, 0.75], exact).drop("column")
    return join_null_safe(stats, q, list(by), "left").select(
        *by, "n", "mean", "std", "min",
        F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max",
    )


def group_median(df: DataFrame, by: str, value: str) -> DataFrame:
    """A4: median per group, groups ordered by it (descending)."""
    q = group_quantiles(df, [by], [value], [0.5]).drop("column")
    out = join_null_safe(df.select(by).distinct(), q, [by], "left")
    return out.select(by, F.col("q")[0].alias("median")).orderBy(F.desc("median"), by)


def value_counts(df: DataFrame, col: str, dropna: bool = True, sort: str | None = "count") -> DataFrame:
    """A5: frequency table. ``sort``: 'count' (desc, value asc on ties), 'value' or None."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    out = src.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if sort == "count":
        out = out.orderBy(F.desc("n"), F.asc_nulls_last(col))
    elif sort == "value":
        out = out.orderBy(F.asc_nulls_last(col))
    return out


def counts_within(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Frequency of ``col`` within each group."""
    return df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))


def relative_frequency(df: DataFrame, by: Sequence[str], col: str, digits: int | None = 6) -> DataFrame:
    """Share of each ``col`` value within its ``by`` group.

    The window runs over the aggregated table (one row per (group, value)),
    so its partitions hold distinct values, not raw rows.
    """
    counts = counts_within(df, by, col)
    share = F.col("n") / F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("share", rnd(share, digits) if digits is not None else share)


def relative_frequency_total(df: DataFrame, col: str, digits: int | None = 6) -> DataFrame:
    """Share of each value over the whole table (total as a scalar subquery)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / total
    return counts.withColumn("share", rnd(share, digits) if digits is not None else share)


def describe(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True,
             method: str | None = None) -> DataFrame:
    """A9 (numeric part): one row per (column, statistic).

    count, mean, std (n-1), min, 25%, 50%, 75%, max like ``DataFrame.describe``
    in pandas: one aggregate for the moments, :func:`group_quantiles` of all
    columns at once for the quartiles. ``method='sort'`` sorts the rows of each
    column instead of its frequency table (``sorted_quantiles``).
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    probs = [0.25, 0.5, 0.75]
    x = {c: F.col(c).cast("double") for c in cols}
    wide = df.agg(*[F.struct(
        F.lit(c).alias("column"), F.count(x[c]).cast("double").alias("count"), F.avg(x[c]).alias("mean"),
        F.stddev_samp(x[c]).alias("std"), F.min(x[c]).alias("min"), F.max(x[c]).alias("max")).alias(c) for c in cols])
    stats = wide.select(F.explode(F.array(*cols)).alias("s")).select("s.*")
    if method == "sort":
        q = None
        for c in cols:
            ordered = F.array_sort(F.collect_list(F.struct("p", "value")))  # one entry a probability
            part = sorted_quantiles(df, c, probs).agg(ordered.getField("value").alias("q")).select(F.lit(c).alias("column"), "q")
            q = part if q is None else q.unionByName(part)
    else:
        q = group_quantiles(df, [], cols, probs, exact)
    return stats.join(q, "column", "left").select(
        "column", "count", "mean", "std", "min", F.get("q", F.lit(0)).alias("q25"), F.get("q", F.lit(1)).alias("q50"),
        F.get("q", F.lit(2)).alias("q75"), "max",
    ).unpivot(["column"], ["count", "mean", "std", "min", "q25", "q50", "q75", "max"], "stat", "value")


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A9 (``include='all'`` part): count, unique, top, freq per string column.

    One pass over the data: the values of all columns are unpivoted and
    counted per (column, value); ``top`` is the most frequent value (smallest
    value on ties).
    """
    long = df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    freq = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return freq.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def filtered_describe(df: DataFrame, cond: Column, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """A10: describe after a filter (the filter is pushed to the scan)."""
    return describe(df.where(cond), cols, exact)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A11."""
    return df.select(col).distinct()


def dedup_report(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Row counts before and after ``dropDuplicates`` in one job."""
    keys = list(subset) if subset else df.columns
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(F.sum("__n").alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))


def functional_dependency(df: DataFrame, a: str, b: str) -> DataFrame:
    """For each ``a``, how many distinct ``b`` (1 everywhere = a determines b)."""
    return df.groupBy(a).agg(F.count_distinct(b).alias("n_distinct"))


def any_positive(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """1 if any value of the column is non-zero in the group."""
    return df.groupBy(*by).agg(*[F.max((F.col(c) != 0).cast("int")).alias(f"any_{c}") for c in cols])


def moments(df: DataFrame, col: str) -> DataFrame:
    """Mean, sample/population sd and variance, min, max."""
    return df.agg(
        F.count(col).alias("n"),
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
        F.var_samp(col).alias("var"),
        F.stddev_pop(col).alias("std_pop"),
        F.var_pop(col).alias("var_pop"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
    )


def min_nonzero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Smallest non-zero value of every column, one pass."""
    return df.agg(*[F.min(F.when(F.col(c) != 0, F.col(c))).alias(f"min_nz_{c}") for c in cols])


def conditional_totals(df: DataFrame, cond: Column, weight: Column) -> DataFrame:
    """Rows meeting a condition, and a weighted sum over them."""
    return df.agg(
        F.count_if(cond).alias("n_match"),
        F.sum(F.when(cond, weight)).alias("weighted_sum"),
    )


def chance_accuracy(df: DataFrame, label: str) -> DataFrame:
    """Sum of squared class shares (accuracy of guessing by the class mix)."""
    shares = relative_frequency_total(df, label, digits=None)
    return shares.agg(F.sum(F.col("share") * F.col("share")).alias("chance"))


def totals_frequency(df: DataFrame, instant: str, value: str) -> DataFrame:
    """Totals per instant, then how often each total occurs."""
    per = df.groupBy(instant).agg(F.sum(value).alias("total"))
    return per.groupBy("total").agg(F.count(F.lit(1)).alias("n_instants"))


def rates(df: DataFrame, by: Sequence[str], numerator: str, denominator: str) -> DataFrame:
    """Sum, count and per-unit rates from ONE aggregate (no self-joins)."""
    return df.groupBy(*by).agg(
        F.sum(numerator).alias("sum_num"),
        F.count(F.lit(1)).alias("n"),
        F.sum(denominator).alias("sum_den"),
    ).withColumn("per_row", F.col("sum_num") / F.col("n")).withColumn(
        "per_unit", F.try_divide(F.col("sum_num").cast("double"), F.col("sum_den").cast("double"))
    )
