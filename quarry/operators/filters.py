"""
pushed by Catalyst into the Parquet scan (PushedFilters)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_box(lat: str, lon: str, lat_range: tuple[float, float], lon_range: tuple[float, float]) -> Column:
    """bounding-box predicate."""
    return F.col(lat).between(*lat_range) & F.col(lon).between(*lon_range)


def any_null(cols: Sequence[str]) -> Column:
    """F7 predicate: at least one of the columns is NULL."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def rows_with_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """rows having at least one NULL."""
    return df.where(any_null(list(cols) if cols else df.columns))


def rows_at_max(df: DataFrame, metric: str, tie_break: Sequence[str] = (), all_ties: bool = False) -> DataFrame:
    """F8: row(s) with the maximum of ``metric``.

    ``all_ties=False``: first row wins (smallest ``tie_break``), as a top-1
    (per-task top-1 then merge). ``all_ties=True``: every row equal to the
    maximum, found with a scalar-subquery max (no global window).
    """
    if all_ties:
        top = df.agg(F.max(metric)).scalar()
        return df.where(F.col(metric) == top)
    return df.orderBy(F.desc(metric), *[F.asc(c) for c in tie_break]).limit(1)


def assert_all(df: DataFrame, cond: Column, name: str = "holds") -> DataFrame:
    """whole-table assertion as a one-row result (``every``)."""
    return df.agg(F.every(cond).alias(name), F.count_if(~cond).alias("violations"))


def exclude_text(col: str, pattern: str) -> Column:
    """Regex row filter (negated)."""
    return ~F.col(col).rlike(pattern)
