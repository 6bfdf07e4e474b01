"""From raw documents to sharded training text, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all
but the last return the columns of ``docs``. The order:

1. language ID: rows whose language can't be told go (no letters at all, or a
   text that no learned language codes in fewer than 8 bits a byte);
2. MinHash near-dedup, five-word shingles: one row of each group stays;
3. benchmark decontamination: rows that hold a template window of a benchmark
   item go;
4. mixing: rows are repeated or left out so that sources meet their targets;
5. sharding: shard and slot of every row left, beside its columns.

:func:`run` writes what each stage keeps as Parquet into the shared folder, and
the next stage reads that: no stage is worked out twice.

Defined cases: rows with a NULL text go in the first stage; rows with a NULL
identifier can't be linked or flagged and stay in the stages 2 and 3; rows that
repeat an identifier are kept or dropped alike; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, mixing, near_duplicates, ppm_language, sharding
from quarry.session import checkpoint_dir, table
from quarry.sources.stage import stage_path, write_stage

UNIFORM_BITS = 8.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = ppm_language.train(docs, "doc_id", "text", "lang", F.lit(True))
    return ppm_language.with_language(docs, model, "text", UNIFORM_BITS)


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose identifier is not in ``ids``; the texts are not sorted for it."""
    return docs.join(ids.distinct().hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    checkpoint_dir(spark)
    return _without(docs, near_duplicates.near_duplicates(docs).where("NOT kept").select("doc_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    checkpoint_dir(spark)
    return _without(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    checkpoint_dir(spark)
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs, keep=docs.columns)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = write_stage(stage(spark, docs, sf_dir), stage_path(spark, name))
        docs = spark.read.schema(docs.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
