"""

Explicit ``StructType`` schemas everywhere (inference only in
``read_inferred`` for exploration); sentinels become NULL at scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True, sep: str = ",",
             null_value: str | None = None, comment: str | None = None, corrupt: str | None = None) -> DataFrame:
    """Delimited text with a given schema.

    ``sep`` may be several characters (S3); ``null_value`` maps one token to
    NULL (S4); ``comment`` skips lines starting with it (S6); ``corrupt`` adds a
    column with the text of lines that don't fit the schema. Gzip input is
    read natively (S7): one task per file, so repartition after the scan when
    a few large .gz files feed a wide job.
    """
    if corrupt is not None:
        fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        schema = StructType([*fields.fields, StructField(corrupt, StringType())])
    r = spark.read.schema(schema).option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    if null_value is not None:
        r = r.option("nullValue", null_value)
    if comment is not None:
        r = r.option("comment", comment)
    if corrupt is not None:
        r = r.option("columnNameOfCorruptRecord", corrupt)
    return r.csv(path)


def read_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """S1 exploratory form: header + inferred types (two passes; not for production)."""
    return spark.read.option("header", True).option("inferSchema", True).option("sep", sep).csv(path)


def null_tokens(df: DataFrame, cols: Sequence[str], tokens: Sequence[str]) -> DataFrame:
    """S4 with several sentinels (e.g. '9999', '?'): compare as text, then NULL."""
    return df.withColumns({
        c: F.when(F.col(c).cast("string").isin([str(t) for t in tokens]), F.lit(None)).otherwise(F.col(c))
        for c in cols})


def _placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, __file, __head, __id): lines with their file; ``__head``: in the file's first block.

    Lines of a block are read in order by one task, so ids of a block are consecutive.
    """
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("__file"), (F.col("_metadata.file_block_start") == 0).alias("__head"),
        F.monotonically_increasing_id().alias("__id"))


def _parsed(lines: DataFrame, schema: StructType, sep: str, corrupt: str | None) -> DataFrame:
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"sep": sep, "mode": "PERMISSIVE"}
    if corrupt is not None:
        ddl += f", `{corrupt}` string"
        options["columnNameOfCorruptRecord"] = corrupt
    return lines.select(F.from_csv("value", ddl, options).alias("r")).select("r.*")


def read_skipping(spark: SparkSession, path: str, schema: StructType, skip_pattern: str, sep: str = ",",
                  corrupt: str | None = None) -> DataFrame:
    """Skip the lines that match ``skip_pattern`` at the head of each file (a banner).

    Spark's CSV reader has no ``skiprows``: lines are read as text, the first
    line of each file that doesn't match is found (one row per file), and only
    matching lines before it go. A data line that looks like a banner stays.
    ``corrupt`` names a column that holds the text of malformed lines.
    """
    lines = _placed_lines(spark, path)
    begins = lines.where(F.col("__head") & ~F.col("value").rlike(skip_pattern)).groupBy("__file").agg(F.min("__id").alias("__first"))
    banner = F.col("__head") & F.col("value").rlike(skip_pattern) & F.coalesce(F.col("__id") < F.col("__first"), F.lit(True))
    return _parsed(lines.join(begins, "__file", "left").where(~banner), schema, sep, corrupt)


def read_after_lines(spark: SparkSession, path: str, schema: StructType, skip: int, sep: str = ",",
                     corrupt: str | None = None) -> DataFrame:
    """Skip the first ``skip`` lines of each file, whatever they hold (they must lie in its first block)."""
    lines = _placed_lines(spark, path)
    begins = lines.where("__head").groupBy("__file").agg(F.min("__id").alias("__first"))
    leading = F.col("__head") & (F.col("__id") - F.col("__first") < skip)
    return _parsed(lines.join(begins, "__file", "left").where(~leading), schema, sep, corrupt)


def malformed_rows(df: DataFrame, corrupt: str) -> DataFrame:
    """How many rows were read and how many of them did not fit the schema."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(corrupt).alias("n_malformed"))


def parse_datetime_columns(df: DataFrame, date_col: str, time_col: str, fmt: str, name: str) -> DataFrame:
    """One timestamp from two text columns (``parse_dates=[['d','t']]``)."""
    return df.withColumn(name, F.try_to_timestamp(F.concat_ws(" ", F.col(date_col), F.col(time_col)), F.lit(fmt)))


def names_from_side_file(spark: SparkSession, path: str, label: str) -> DataFrame:
    """Column names from a description file.

    Drops blank lines and ``|`` comment lines, drops the first remaining line
    (the label listing), keeps the text before ``:`` and appends ``label``.
    Returns (pos, name); the handful of names is what ``toDF`` needs.
    """
    from quarry.operators.ordering import global_row_number

    raw = spark.read.text(path).withColumn("__file_pos", F.monotonically_increasing_id())
    kept = raw.where((F.trim("value") != "") & ~F.col("value").startswith("|"))
    numbered = global_row_number(kept, ["__file_pos"], "pos")
    names = numbered.where(F.col("pos") > 1).select(
        (F.col("pos") - 1).alias("pos"), F.trim(F.split_part(F.col("value"), F.lit(":"), F.lit(1))).alias("name"))
    n = names.agg(F.max("pos")).scalar()
    last = spark.range(1).select((n + 1).alias("pos"), F.lit(label).alias("name"))
    return names.unionByName(last)


def apply_names(df: DataFrame, names: DataFrame) -> DataFrame:
    """Rename the columns of a header-less scan by the (bounded) name list, one name per column."""
    ordered = [r["name"] for r in names.orderBy("pos").collect()]
    if len(ordered) != len(df.columns):
        raise ValueError(f"{len(ordered)} names for {len(df.columns)} columns")
    return df.toDF(*ordered)
