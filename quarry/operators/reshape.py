
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _other(col: str, levels: Sequence) -> Column:
    return ~F.coalesce(F.col(col).isin(list(levels)), F.lit(False))


def pivot_counts(df: DataFrame, row: str, col: str, levels: Sequence, other: str | None = None) -> DataFrame:
    """Counts of ``col`` levels per ``row`` value, zero filled.

    The level list is fixed by the caller (column order of the result), so
    Spark does not run a separate job to discover it. ``other`` names a column
    that counts the rows of all other values, NULL included; without it these
    rows are not counted, but their ``row`` value stays.
    """
    names = [str(v) for v in levels]
    if other is not None:
        counts = [F.count_if(F.col(col) == F.lit(v)).alias(n) for v, n in zip(levels, names)]
        return df.groupBy(row).agg(*counts, F.count_if(_other(col, levels)).alias(other))
    out = df.groupBy(row).pivot(col, list(levels)).count()
    return out.na.fill(0, subset=names).select(row, *[F.col(n).cast("long").alias(n) for n in names])


crosstab = pivot_counts  # R2 is R1 with both axes categorical


def pivot_values(df: DataFrame, key: str, level_col: str, value: str, levels: Sequence) -> DataFrame:
    """One column per level holding the value, NULL elsewhere (no aggregation)."""
    return df.select(
        key, *[F.when(F.col(level_col) == F.lit(lv), F.col(value)).alias(f"{value}_{lv}") for lv in levels]
    )


def pivot_stats(df: DataFrame, row: str, col: str, value: str, levels: Sequence, other: str | None = None) -> DataFrame:
    """Statistics table to wide, one column per (level, statistic); ``other`` names the
    level that stands for all values outside the list, NULL included."""
    if other is not None:
        merged = F.when(_other(col, levels), F.lit(other)).otherwise(F.col(col).cast("string"))
        return pivot_stats(df.withColumn(col, merged), row, col, value, [*map(str, levels), other])
    return df.groupBy(row).pivot(col, list(levels)).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")
    )


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], cast: str | None = "double") -> DataFrame:
    """Wide -> long (variable, value)."""
    src = df.select(*ids, *[F.col(c).cast(cast).alias(c) if cast else F.col(c) for c in cols])
    return src.unpivot(list(ids), list(cols), "variable", "value")


def value_group_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns -> (value, group) pairs with nulls dropped."""
    return melt(df, [], cols).where(F.col("value").isNotNull()).select("value", F.col("variable").alias("group"))


def transpose_small(df: DataFrame, index: str) -> DataFrame:
    """Transpose a small table (Spark limits it to a bounded number of rows)."""
    return df.transpose(F.col(index))


def top_values_report(df: DataFrame, cols: Sequence[str], n: int, buckets: int = 256) -> DataFrame:
    """The ``n`` most frequent values of every column in one pass.

    unpivot -> count per (column, value) -> two-phase top-n: first within
    (column, hash bucket of the value), then within the column over at most
    ``buckets * n`` survivors. A column with a billion distinct values never
    sits in one task; the result equals a single global ranking because the
    order (count desc, value asc) is total.
    """
    from pyspark.sql import Window

    long = df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    freq = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc_nulls_last("value")]
    b = F.pmod(F.xxhash64("value"), F.lit(buckets))
    first = freq.withColumn("__b", b).withColumn(
        "__r", F.row_number().over(Window.partitionBy("column", "__b").orderBy(*order))).where(F.col("__r") <= n)
    w = Window.partitionBy("column").orderBy(*order)
    return first.drop("__b", "__r").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def aligned_frequencies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Counts of several columns aligned on the value (union of values)."""
    long = df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    out = long.groupBy("value").pivot("column", list(cols)).count()
    return out.na.fill(0, subset=list(cols))
