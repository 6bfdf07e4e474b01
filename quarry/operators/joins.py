"""

Broadcast rule: an explicit ``broadcast()`` is used only for sides whose size
is bounded by construction (a literal map, a parameter row, a per-partition
summary). Every other join is left to Catalyst and
AQE, which broadcast at run time from the *measured* size of the finished
stage (``spark.sql.adaptive.autoBroadcastJoinThreshold``) and otherwise split
skewed partitions of the sort-merge join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import global_row_number


BROADCAST_ROWS = 100_000


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str], bounded: bool = False) -> DataFrame:
    """Left outer equi-join to a lookup table.

    ``bounded=True`` says that ``dim`` should be small (for example a code
    list). It is counted, up to ``BROADCAST_ROWS``, and broadcast only if it is.
    """
    small = bounded and dim.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    right = F.broadcast(dim) if small else dim
    return df.join(right, on, "left")


def left_on_key(df: DataFrame, other: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join on an exact key with differently named columns (right key dropped)."""
    return df.join(other, df[left_key] == other[right_key], "left").drop(other[right_key])


def inner_renamed(df: DataFrame, other: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner join with differently named keys, both keys dropped after."""
    return df.join(other, df[left_key] == other[right_key], "inner").drop(df[left_key]).drop(other[right_key])


def full_outer(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on a composite key (keys coalesced)."""
    return df.join(other, list(keys), "full")


def side_by_side(tables: Mapping[str, DataFrame], order: Mapping[str, Sequence[Column | str]]) -> DataFrame:
    """Positional outer join -- the k-th row of every table on one line.

    Each table gets its global position (distributed numbering, see
    ``ordering.global_row_number``); the tables are then full-joined on it.
    Columns are prefixed with the table name.
    """
    out = None
    for name, t in tables.items():
        numbered = global_row_number(t, order[name], "pos")
        numbered = numbered.select("pos", *[F.col(c).alias(f"{name}_{c}") for c in t.columns])
        out = numbered if out is None else out.join(numbered, "pos", "full")
    return out


def add_columns_same_rows(df: DataFrame, cols: Mapping[str, Column]) -> DataFrame:
    """J6: "join back on row identity" is a projection in Spark -- no join at all."""
    return df.withColumns(dict(cols))


def classify_in_intervals(
    df: DataFrame,
    dim: DataFrame,
    left_key: Column,
    right_key: str,
    value: Column,
    bounds: Sequence[tuple[str, str]],
    otherwise: str,
    name: str = "class",
) -> DataFrame:
    """Equi-join to a per-day dimension, then classify ``value`` by the
    first boundary pair ``(lo_col, label)`` whose column ``lo_col`` exceeds it.

    ``bounds`` is an ordered list of (boundary column, label): the label of
    the first boundary greater than the value wins, else ``otherwise``; a
    NULL value or a key that the dimension lacks gives NULL. Whether the
    dimension is broadcast is left to its measured size.
    """
    joined = df.join(dim, left_key == F.col(right_key), "left")
    expr = F.when(value.isNull() | F.col(right_key).isNull(), F.lit(None))
    for col, label in bounds:
        expr = expr.when(value < F.col(col), F.lit(label))
    return joined.withColumn(name, expr.otherwise(otherwise))


def map_values(col: Column | str, mapping: Mapping, default: Column | None = None) -> Column:
    """Dictionary value map as a literal map (no join)."""
    c = F.col(col) if isinstance(col, str) else col
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    looked = F.element_at(F.create_map(*pairs), c) if pairs else F.lit(None)
    return F.coalesce(looked, default) if default is not None else looked


def semi(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """IN-list as a left-semi join."""
    return df.join(keys, on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """NOT IN as a left-anti join (NULL-safe unlike ``NOT IN``)."""
    return df.join(keys, on, "left_anti")
