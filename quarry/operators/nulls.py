
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.aggregates import group_quantiles
from quarry.operators.ordering import hash_unit


def null_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns containing NULLs and how many (one aggregate pass)."""
    cols = list(cols) if cols else df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_null").where(F.col("n_null") > 0)


def non_null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Non-null count per column and the gap to the fullest column."""
    cols = list(cols) if cols else df.columns
    wide = df.agg(*[F.count(c).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column", "n_non_null")
    # one row per column: the maximum over that small table needs no second scan
    top = F.max("n_non_null").over(Window.partitionBy(F.lit(0)))
    return long.withColumn("missing_vs_max", top - F.col("n_non_null"))


def joint_missing(df: DataFrame, subsets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows where every column of a subset is NULL, per named subset."""
    aggs = []
    for name, cols in subsets.items():
        cond = F.lit(True)
        for c in cols:
            cond = cond & F.col(c).isNull()
        aggs.append(F.count_if(cond).alias(name))
    wide = df.agg(*aggs)
    return wide.unpivot([], list(subsets), "subset", "n_rows")


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill NULLs with literals per column."""
    return df.na.fill(dict(values))


def replace_flagged_by_median(df: DataFrame, col: str, flagged: Column) -> DataFrame:
    """Flagged values -> median of the unflagged positive values.

    The median is a scalar subquery over ``group_quantiles``; no task holds the
    values of the column.
    """
    med = group_quantiles(df.where(~flagged & (F.col(col) > 0)), [], [col], [0.5]).select(F.col("q")[0]).scalar()
    return df.withColumn(col, F.when(flagged, med).otherwise(F.col(col)))


def hot_deck(
    df: DataFrame,
    key: str,
    col: str,
    flagged: Column,
    seed: int = 0,
    buckets: int = 4096,
) -> DataFrame:
    """Replace flagged values by a reproducible random draw from the good values.

    Donors (unflagged rows) get a dense number 0..n-1 in the order
    (md5 bucket, key): numbered within salted buckets, bucket offsets from a
    ``buckets``-row table. Each flagged row picks donor
    ``floor(u * n)`` with ``u`` its md5 draw, and fetches the donor value by
    an equi-join on the donor number. All steps are distributed; a hot bucket
    cannot form because buckets are hash-assigned. Donors without a key are
    spread by their value and can be picked like the others; flagged rows
    without a key share one draw.
    """
    marked = df.withColumn("__flag", F.coalesce(flagged, F.lit(False)))
    identity = F.coalesce(F.col("__dkey").cast("string"), F.col("__dval").cast("string"), F.lit(""))
    donors = marked.where(~F.col("__flag")).select(
        F.col(key).alias("__dkey"), F.col(col).alias("__dval")
    ).withColumn("__b", F.floor(hash_unit(identity, seed=None) * buckets).cast("int"))
    per_b = donors.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_b.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    n_donors = donors.agg(F.count(F.lit(1))).scalar()
    numbered = donors.withColumn("__r", F.row_number().over(Window.partitionBy("__b").orderBy("__dkey", "__dval")))
    numbered = numbered.join(F.broadcast(offsets.drop("__n")), "__b").select(
        (F.col("__r") - 1 + F.col("__off")).alias("__donor"), "__dval"
    )
    # only flagged rows meet the donors; all others pass by without a shuffle
    draw = hash_unit(F.coalesce(F.col(key).cast("string"), F.lit("")), seed=seed)
    picks = marked.where("__flag").withColumn("__donor", F.floor(draw * n_donors).cast("long"))
    replaced = picks.join(numbered, "__donor", "left").withColumn(col, F.col("__dval").cast(df.schema[col].dataType))
    return marked.where("NOT __flag").select(*df.columns).union(replaced.select(*df.columns))


def recode_unknown(df: DataFrame, col: str, tokens: Sequence[str], to: str = "Unknown") -> DataFrame:
    """Recode tokens that mean unknown."""
    return df.withColumn(col, F.when(F.col(col).isin(list(tokens)), F.lit(to)).otherwise(F.col(col)))


def sentinels_to_null(df: DataFrame, cols: Sequence[str], tokens: Sequence) -> DataFrame:
    """S4 for already-scanned data: several sentinel tokens -> NULL."""
    return df.withColumns({c: F.when(F.col(c).isin(list(tokens)), F.lit(None)).otherwise(F.col(c)) for c in cols})
