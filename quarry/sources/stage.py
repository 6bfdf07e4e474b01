"""Stage tables and sinks: S12, K1, K2.

Stage folders live under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``) -- never a machine-local temporary folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.session import checkpoint_dir


def stage_path(spark: SparkSession, name: str) -> str:
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/stage/{name}-{uuid.uuid4().hex}"


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Parquet stage table (optionally partitioned, e.g. by date, for pruning)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", compression: str | None = "gzip",
              columns: list[str] | None = None) -> str:
    """K1 / K2: (projected) delimited sink, gzip by default."""
    src = df.select(*columns) if columns else df
    w = src.write.mode("overwrite").option("header", header).option("sep", sep)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path
