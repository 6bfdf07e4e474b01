"""Rounding rules shared by queries and their SQL twins.

``round(x * 10^d) / 10^d`` rounds half away from zero in Spark and DuckDB
alike, because both engines see the same product double; rounding the
decimal text form (Spark's ``round(x, d)``) can differ on exact halves.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(c: Column | str, digits: int = 6) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    scale = float(10**digits)
    return F.round(col * F.lit(scale)) / F.lit(scale)


def rnd_sql(expr: str, digits: int = 6) -> str:
    return f"(ROUND(({expr}) * 1e{digits}) / 1e{digits})"
