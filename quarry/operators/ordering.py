"""Global positions and running sums without a single-partition window.

A window with ``orderBy`` and no ``partitionBy`` moves every row to one task.
The helpers here keep the work distributed instead:

1. ``orderBy`` range-partitions and sorts the rows across all tasks;
2. ``monotonically_increasing_id`` numbers rows inside each sorted partition
   (partition id in the high bits), and the frame is checkpointed so that the
   numbering is fixed (a re-run of the range sort could draw other bounds);
3. a per-partition summary (one row per partition: count, sum) gets prefix
   sums -- a window over at most ``#partitions`` rows -- and is broadcast back.

Used by W2, W4, E4, X3, X8, X9, T6, T9, J5, O5 and the exact quantile path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PID = "__pid"
_MONO = "__mono"


def _sorted_numbered(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    numbered = (
        df.orderBy(*order)
        .withColumn(_MONO, F.monotonically_increasing_id())
        .withColumn(_PID, F.spark_partition_id())
    )
    # Reliable checkpoint into spark.checkpoint.dir: fixes the numbering and
    # cuts lineage, and survives executor loss.
    return numbered.checkpoint(eager=True)


def global_row_number(df: DataFrame, order: Sequence[Column | str], name: str = "rn") -> DataFrame:
    """Add ``name`` = 1-based position of each row in ``order`` (give a total order)."""
    numbered = _sorted_numbered(df, order)
    per_part = numbered.groupBy(_PID).agg(
        F.count(F.lit(1)).alias("__n"), F.min(_MONO).alias("__base")
    )
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    # one row per partition: bounded by the partition count, safe to broadcast
    out = numbered.join(F.broadcast(offsets), _PID).withColumn(
        name, F.col(_MONO) - F.col("__base") + F.col("__off") + F.lit(1)
    )
    return out.drop(_PID, _MONO, "__n", "__base", "__off")


def global_running_sums(
    df: DataFrame,
    order: Sequence[Column | str],
    values: Mapping[str, str],
    with_row_number: str | None = None,
) -> DataFrame:
    """For every ``value: name`` add ``name`` = sum of ``value`` over all rows up to and
    including this one in ``order``; all sums share one sort and one checkpoint."""
    numbered = _sorted_numbered(df, order)
    per_part = numbered.groupBy(_PID).agg(
        *[F.sum(v).alias(f"__s_{n}") for v, n in values.items()],
        F.count(F.lit(1)).alias("__n"), F.min(_MONO).alias("__base"),
    )
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        _PID,
        "__base",
        *[F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)).alias(f"__off_{n}") for n in values.values()],
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__noff"),
    )
    within = Window.partitionBy(_PID).orderBy(_MONO).rowsBetween(Window.unboundedPreceding, 0)
    out = numbered.join(F.broadcast(offsets), _PID).withColumns(
        {n: F.sum(v).over(within) + F.col(f"__off_{n}") for v, n in values.items()}
    )
    if with_row_number:
        out = out.withColumn(with_row_number, F.col(_MONO) - F.col("__base") + F.col("__noff") + 1)
    return out.drop(_PID, _MONO, "__base", "__noff", *[f"__off_{n}" for n in values.values()])


def global_running_sum(
    df: DataFrame,
    order: Sequence[Column | str],
    value: str,
    name: str = "running",
    with_row_number: str | None = None,
) -> DataFrame:
    """Add ``name`` = sum of ``value`` over all rows up to and including this one in ``order``."""
    return global_running_sums(df, order, {value: name}, with_row_number)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``<=>``), keeping one copy
    of each key column: a NULL group is a group, its rows must not vanish."""
    renamed = right.select(*[F.col(c).alias(f"__k_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for c in keys:
        e = left[c].eqNullSafe(renamed[f"__k_{c}"])
        cond = e if cond is None else cond & e
    return left.join(renamed, cond, how).drop(*[f"__k_{c}" for c in keys])


def hash_unit(*cols: Column | str, seed: int = 0) -> Column:
    """Reproducible uniform draw in [0, 1) from the md5 of the key (and a seed).

    md5 is used instead of Spark's murmur hash so that the same draw can be
    written in other SQL engines: 52 bits of the digest / 2^52 (exact in a double).
    """
    return F.conv(F.substring(hash_digest(*cols, seed=seed), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def hash_digest(*cols: Column | str, seed: int = 0) -> Column:
    """The md5 (hex) behind :func:`hash_unit`."""
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    if seed is not None:
        parts.append(F.lit(str(seed)))
    return F.md5(F.concat_ws("|", *parts) if len(parts) > 1 else parts[0])


def spread_out(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over as many tasks as the session shuffles to, and at least one per core."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def hash_unit_sql(key_sql: str | list[str], seed: int | None = 0) -> str:
    """The DuckDB twin of :func:`hash_unit` for one key expression (or a list)."""
    keys = [key_sql] if isinstance(key_sql, str) else list(key_sql)
    parts = [f"CAST({k} AS VARCHAR)" for k in keys]
    if seed is not None:
        parts.append(f"'{seed}'")
    text = f"concat_ws('|', {', '.join(parts)})" if len(parts) > 1 else parts[0]
    return f"(CAST(('0x' || substr(md5({text}), 1, 13)) AS BIGINT) / CAST({1 << 52} AS DOUBLE))"


def position_within(
    df: DataFrame,
    by: Sequence[str],
    unit: Column,
    name: str = "pos",
    buckets: int = 4096,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """1-based position of each row within its ``by`` group when ordered by ``unit``.

    ``unit`` must be a uniform value in [0, 1) that is unique per row (a hash
    draw, see :func:`hash_unit`). Hot groups are split into ``buckets`` salted
    sub-groups by the leading part of ``unit``; the per-(group, bucket) counts
    (``#groups x buckets`` rows) get prefix sums and are joined back, so no
    task ever holds a whole group.
    """
    tagged = df.withColumn("__u", unit).withColumn(
        "__b", F.least(F.floor(F.col("__u") * buckets), F.lit(buckets - 1)).cast("int")
    )
    counts = tagged.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inner = Window.partitionBy(*by, "__b").orderBy("__u", *tiebreak)
    ranked = tagged.withColumn("__r", F.row_number().over(inner))
    out = join_null_safe(ranked, offsets, [*by, "__b"]).withColumn(name, F.col("__r") + F.col("__off"))
    return out.drop("__u", "__b", "__r", "__off")
