
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ordering import global_row_number, global_running_sum, join_null_safe


def with_group_total(df: DataFrame, by: Sequence[str], value: str, name: str = "group_total") -> DataFrame:
    """The group total beside every row.

    Written as aggregate + join rather than ``sum().over(partitionBy)``: the
    partial aggregate pre-sums a hot key in every task, and the totals table
    (one row per key) is joined back -- AQE broadcasts it when it is small
    and splits skewed partitions of a sort-merge join otherwise.
    """
    totals = df.groupBy(*by).agg(F.sum(value).alias(name))
    return join_null_safe(df, totals, list(by), "left")  # a NULL key is a group too


def running_share(freq: DataFrame, value_col: str, count_col: str = "n") -> DataFrame:
    """Running total and cumulative share of a frequency table (count desc, value asc)."""
    total = freq.agg(F.sum(count_col)).scalar()
    out = global_running_sum(
        freq, [F.desc(count_col), F.asc_nulls_last(value_col)], count_col, "cum_n", with_row_number="rank"
    )
    return out.withColumn("cum_share", F.col("cum_n") / total).withColumn(
        "prev_share", (F.col("cum_n") - F.col(count_col)) / total)


def cumulative_over_grid(grid: DataFrame, order: str, value: str, name: str = "cdf") -> DataFrame:
    """Running sum over an ordered grid of any length (distributed, see ``ordering``)."""
    return global_running_sum(grid, [order], value, name)


def cumulative_contribution(items: DataFrame, key: str, weight: str, share: float) -> DataFrame:
    """Items ranked by weight (desc) kept until their cumulative share reaches ``share``.

    Keeps every item whose preceding cumulative share is below ``share`` (the
    item that crosses the threshold is included).
    """
    total = items.agg(F.sum(weight)).scalar()
    ranked = global_running_sum(items, [F.desc(weight), F.asc(key)], weight, "cum", with_row_number="rank")
    ranked = ranked.withColumn("cum_share", F.col("cum") / total)
    return ranked.where((F.col("cum") - F.col(weight)) / total < F.lit(share))


def rank_by(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Rank (ties share a rank) within groups, or over a bounded result table (see :func:`global_rank`)."""
    w = Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)
    return df.withColumn(name, F.rank().over(w))


def global_rank(df: DataFrame, order: Sequence[tuple[str, bool]], name: str = "rank") -> DataFrame:
    """W5 over a whole table of any size: rank by (column, ascending) pairs, ties share a rank.

    Rows are counted per distinct order value; the running count of these
    frequencies, one distributed sort, gives every value the position of its
    first row, which is joined back. A NULL is a value, after all others.
    """
    keys = [c for c, _ in order]
    freq = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    by = [F.asc_nulls_last(c) if up else F.desc_nulls_last(c) for c, up in order]
    cum = global_running_sum(freq, by, "__n", "__cum")
    first = cum.select(*keys, (F.col("__cum") - F.col("__n") + 1).cast("int").alias(name))
    return join_null_safe(df, first, keys).select(*df.columns, name)


def sort(df: DataFrame, cols: Sequence[Column | str]) -> DataFrame:
    """O1."""
    return df.orderBy(*cols)


def head(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """O2: first ``n`` rows of an order -- a TakeOrderedAndProject (per-task top-n, then merge)."""
    return df.orderBy(*order).limit(n)


def top_contributors(loadings: DataFrame, component: str, weights: str, names: Sequence[str], k: int) -> DataFrame:
    """O3: per component, the ``k`` features with the largest absolute weight share.

    ``weights`` is an array column (one loading per feature, in ``names`` order).
    """
    exploded = loadings.select(component, F.posexplode(weights).alias("pos", "w"))
    names_arr = F.array(*[F.lit(n) for n in names])
    share = F.abs("w") / F.sum(F.abs("w")).over(Window.partitionBy(component))
    ranked = exploded.withColumn("feature", F.element_at(names_arr, F.col("pos") + 1)).withColumn(
        "share", share
    )
    w = Window.partitionBy(component).orderBy(F.desc("share"), F.asc("pos"))
    return ranked.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def order_by_levels(df: DataFrame, col: str, levels: Sequence[str], extra: Sequence[Column | str] = ()) -> DataFrame:
    """Sort by a user-defined category order (unknown levels last)."""
    pos = F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(col))
    return df.orderBy(F.when(pos == 0, F.lit(len(levels) + 1)).otherwise(pos), *extra)


def lump_by_share(df: DataFrame, col: str, share: float, max_keep: int | None = None, other: str = "Other") -> DataFrame:
    """Keep the most frequent values until ``share`` of rows is covered
    (optionally at most ``max_keep`` values), the rest becomes ``other``.

    The keep-list is a frequency table filtered to its head; it is joined
    back on the value (AQE picks broadcast when it is small).
    """
    freq = df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).where(F.col(col).isNotNull())
    ranked = running_share(freq, col)
    keep = ranked.where(F.col("prev_share") < F.lit(share))  # the value that crosses the share is kept
    if max_keep is not None:
        keep = keep.where(F.col("rank") <= max_keep)
    keep = keep.select(F.col(col).alias("__keep"))
    joined = df.join(keep, df[col] == keep["__keep"], "left")
    return joined.withColumn(col, F.when(F.col("__keep").isNotNull(), F.col(col)).otherwise(F.lit(other))).drop(
        "__keep"
    )
