"""Registry of queries: name -> (callable(spark, sf_dir) -> DataFrame, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, FloatType

from quarry.functions.rounding import rnd

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB twin (None: rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (the twin SQL rounds the same columns)."""
    return df.select(
        *[
            rnd(f.name, digits).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else f.name
            for f in df.schema.fields
        ]
    )
