"""Mixing sources to target weights (operator 4): hash-threshold histograms.

Every source gets a target number of words; a document is taken a whole number
of times. ``floor(target / size of the source)`` copies of everything are
taken, and the rest of the budget goes to the documents whose 48-bit hash lies
below a threshold. The threshold is found without sorting: words are summed by
source and hash bucket (the leading 12 bits), the running sum over at most
4096 buckets shows the bucket in which the budget runs out, and only that
bucket is split by its next 12 bits, and so on. After the last level one hash
value is left; it is taken if that brings the sum nearer to the target. The
thresholds are nested: a larger target keeps all that a smaller one took.

Only DataFrame functions are used. Texts are read once, to count words; all
later steps work on (identifier, source, size, hash).

Defined cases: a NULL or empty text has size 0 and takes 0 words; a NULL source
is a source of its own, last in order; rows that repeat an identifier within a
source share a hash and are taken alike; a NULL identifier hashes like an empty
one; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ordering import global_row_number, join_null_safe

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"
LEVELS, BITS = 4, 12
MANY_SOURCES = 50_000


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target): weights repeat over the sources in code point order, NULL last.

    ``share`` of all words is split by weight; a target stops at ``most`` times
    its source, and what is over is split again among the others until none is
    above. Each round is one aggregate over one row per source.
    """
    ranked = global_row_number(sizes, [F.col("source").asc_nulls_last()], "__rank")
    choice = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.select("source", "source_size", choice[(F.col("__rank") - 1) % len(weights)].alias("weight")).checkpoint()
    limit = F.col("source_size") * F.lit(float(most))
    rate, capped = 0.0, -1
    while True:
        full = (limit <= F.col("weight") * rate) if capped >= 0 else F.lit(False)
        row = ranked.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, limit).otherwise(0.0)).alias("spent"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weights"), F.count_if(full).alias("full"),
        ).first()
        if row["full"] == capped or not row["weights"]:
            break
        capped, rate = row["full"], (share * (row["all"] or 0) - row["spent"]) / row["weights"]
    return ranked.select("source", "source_size", F.least(limit, F.col("weight") * rate).alias("target"))


def thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, ..., copies, bound, at_bound): hashes below ``bound`` are taken once more, ``bound`` itself if ``at_bound``."""
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    state = plan.withColumn("copies", copies).select(
        "*", (F.col("target") - F.col("copies") * F.col("source_size")).alias("rest"), F.lit(0).cast("long").alias("prefix")
    )
    for level in range(1, LEVELS + 1):
        down = BITS * (LEVELS - level)
        part = rows.select("source", "size", F.shiftright("hash", down + BITS).alias("prefix"),
                           F.shiftright("hash", down).alias("bucket"))
        open_now = state.select("source", "prefix")
        inside = part if level == 1 else join_null_safe(part, open_now, ["source", "prefix"])
        sums = inside.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        running = join_null_safe(sums, state.select("source", "rest"), ["source"]).withColumn("upto", F.sum("words").over(upto))
        edge = running.where("upto > rest").groupBy("source").agg(
            F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"), "words")).alias("edge")
        )
        state = join_null_safe(state, edge, ["source"], "left").select(
            "source", "source_size", "target", "copies", (F.col("rest") - F.coalesce("edge.before", F.lit(0))).alias("rest"),
            F.coalesce("edge.bucket", F.lit(0)).alias("prefix"), F.coalesce("edge.words", F.lit(0)).alias("words"),
        ).checkpoint()
    return state.select(
        "source", "source_size", "target", "copies", F.col("prefix").alias("bound"),
        ((F.col("words") > 0) & (F.col("rest") * 2 >= F.col("words"))).alias("at_bound"),
    )


def _hash(id_col: str) -> Column:
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("long")


def _copies(most: float) -> Column:
    more = (F.col("hash") < F.col("bound")) | ((F.col("hash") == F.col("bound")) & F.col("at_bound"))
    return F.least(F.lit(int(most)), F.col("copies") + more.cast("int"))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size, hash): all that the mix needs to know of a document."""
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _hash(id_col).alias("hash"),
    ).checkpoint()


def plan_of(rows: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    return thresholds(rows, targets(sizes, weights, share, most))


def by_source(rows: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """Each row with its source's state: broadcast up to ``MANY_SOURCES`` sources (counted), else joined."""
    few = state.limit(MANY_SOURCES + 1).count() <= MANY_SOURCES
    return join_null_safe(rows, F.broadcast(state) if few else state, [key])


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
) -> DataFrame:
    """(id, size, source_size, target, taken, copies) of every row of ``docs``."""
    rows = sized(docs, id_col, text_col, source_col)
    state = plan_of(rows, weights, share, most)
    return by_source(rows, state, "source").withColumn("n", _copies(most)).select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("n")).alias("taken"),
        F.col("n").alias("copies"),
    )


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken."""
    state = plan_of(sized(docs, id_col, text_col, source_col), weights, share, most).select(
        F.col("source").alias("__source"), "copies", "bound", "at_bound"
    )
    rows = docs.select(F.struct("*").alias("row"), F.col(source_col).cast("string").alias("__source"), _hash(id_col).alias("hash"))
    taken = by_source(rows, state, "__source").withColumn("n", _copies(most)).where("n > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")).select("row.*")


def oracle_sql() -> str:
    """The same mix in DuckDB: one sort per source instead of histograms."""
    weights = reduce(lambda sql, kw: f"{sql} WHEN {kw[0]} THEN {float(kw[1])}", enumerate(WEIGHTS), f"CASE (rn - 1) % {len(WEIGHTS)}") + " END"
    return f"""
WITH rows_ AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         ('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 12))::BIGINT AS hash
  FROM documents),
src AS (SELECT source, SUM(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM rows_ GROUP BY source),
wt AS (SELECT *, {weights} AS weight, {float(MOST)} * source_size AS lim FROM src),
run AS (
  SELECT *, COALESCE(SUM(lim) OVER (ORDER BY lim / weight, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
         SUM(weight) OVER (ORDER BY lim / weight, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w,
         {SHARE} * SUM(source_size) OVER () AS budget FROM wt),
rate AS (SELECT MIN_BY((budget - spent) / left_w, lim / weight) AS r FROM run WHERE (budget - spent) / left_w <= lim / weight),
tgt AS (SELECT source, source_size, LEAST(lim, weight * r) AS target FROM wt, rate),
cop AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::INT ELSE 0 END AS copies FROM tgt),
peers AS (SELECT source, hash, SUM(size) AS words FROM rows_ GROUP BY source, hash),
acc AS (SELECT *, SUM(words) OVER (PARTITION BY source ORDER BY hash) AS upto FROM peers),
edge AS (
  SELECT acc.source, MIN(acc.hash) AS bound, MIN_BY(acc.words, acc.hash) AS words, MIN_BY(acc.upto - acc.words, acc.hash) AS before_
  FROM acc JOIN cop ON acc.source IS NOT DISTINCT FROM cop.source
  WHERE acc.upto > cop.target - cop.copies * cop.source_size GROUP BY acc.source),
fin AS (
  SELECT r.doc_id, r.size, c.source_size, c.target,
         LEAST({int(MOST)}, c.copies + CASE WHEN r.hash < COALESCE(e.bound, 0)
           OR (r.hash = e.bound AND (c.target - c.copies * c.source_size - e.before_) * 2 >= e.words) THEN 1 ELSE 0 END)::INT AS copies
  FROM rows_ r JOIN cop c ON r.source IS NOT DISTINCT FROM c.source LEFT JOIN edge e ON e.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies FROM fin
"""
