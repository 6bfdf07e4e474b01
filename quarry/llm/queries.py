"""The registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (
    conversations,
    decontaminate,
    divergence,
    exact_dedup,
    line_dedup,
    main_text,
    mixing,
    near_duplicates,
    ppm_language,
    prefix_tokens,
    sharding,
    toxicity,
    url_lists,
)
from quarry.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by the shortest code under per-language context trees."""
    return ppm_language.language_table(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the list entries active on its fetch day; the list log is made from the pages' addresses."""
    pages = table(spark, sf_dir, "pages")
    return url_lists.evaluate(url_lists.page_captures(pages), url_lists.page_entries(pages))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document from a factorization machine over hashed terms."""
    return toxicity.toxicity_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often every document is taken when sources are mixed 3 : 1 : 2."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays among those of the same text, white space aside."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard 0 to 23 of every document in a tree of regions, racks and shards."""
    return sharding.shard(table(spark, sf_dir, "documents"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text.extract(table(spark, sf_dir, "pages"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-identical documents: two-word shingles, Jaccard similarity of 0.8 or more."""
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), words=2, similarity=80)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with every benchmark item whose template windows it holds."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the 50k byte-level vocabulary."""
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    return prefix_tokens.token_counts(table(spark, sf_dir, "documents"), path)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the terms of each source are from other sources and from their language."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged reproducibly, with its cheapest repair."""
    damaged = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.digests(conversations.repair(damaged, copies=F.col("copies")))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand in three documents or more, but for their owner's."""
    lines = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return lines.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES["op1_language_id"] = op1_language_id
QUERIES["op2_url_filter"] = op2_url_filter
ORACLES["op2_url_filter"] = url_lists.ORACLE_SQL
QUERIES["op3_toxicity"] = op3_toxicity
QUERIES["op4_source_mix"] = op4_source_mix
ORACLES["op4_source_mix"] = mixing.oracle_sql()
QUERIES["op5_exact_dedup"] = op5_exact_dedup
ORACLES["op5_exact_dedup"] = exact_dedup.ORACLE_SQL
QUERIES["op6_shards"] = op6_shards
QUERIES["op7_main_text"] = op7_main_text
QUERIES["op8_minhash_near_dedup"] = op8_minhash_near_dedup
QUERIES["op9_decontaminate"] = op9_decontaminate
QUERIES["op10_token_counts"] = op10_token_counts
QUERIES["op11_source_divergence"] = op11_source_divergence
ORACLES["op11_source_divergence"] = divergence.ORACLE_SQL
QUERIES["op12_conversation_repair"] = op12_conversation_repair
QUERIES["op13_line_dedup"] = op13_line_dedup
ORACLES["op13_line_dedup"] = line_dedup.ORACLE_SQL
