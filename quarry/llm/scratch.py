"""Intermediate tables that can be released, and values that travel without the package."""

from __future__ import annotations

import pickle
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from quarry.sources.stage import stage_path, write_stage


class Scratch:
    """Parquet tables in the shared folder; what is superseded is deleted."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and read it back: its lineage ends here."""
        path = stage_path(self.spark, self.name)
        schema = df.schema
        write_stage(df, path)
        kept = self.spark.read.schema(schema).parquet(path)
        self.paths[id(kept)] = (kept, path)
        return kept

    def release(self, *tables: DataFrame | None) -> None:
        """Delete tables that nothing reads any more."""
        for table in tables:
            if id(table) in self.paths:
                _, path = self.paths.pop(id(table))
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def ship(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcast ``value`` as bytes that carry its classes; the function gives it inside a task.

    A broadcast object is pickled by reference and needs this package where it
    is read; bytes made with the package registered by value don't.
    """
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    load = pickle.loads
    return lambda: load(packed.value)
