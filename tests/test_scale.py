"""What must not grow with the rows: tasks that hold all of them, joins that deal by few keys, work done again."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL
from quarry.operators import aggregates as A
from quarry.operators import models as M
from quarry.operators import ordering
from quarry.operators import sampling as B


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_class_weights_do_not_deal_rows_by_label(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 3).alias("y"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weighted = M.class_weights(rows, "y")
        assert "SortMergeJoin" not in _plan(weighted) and "BroadcastHashJoin" in _plan(weighted)
        want = {r.y: 1000 / (4 * r.n) for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        got = weighted.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert len(got) == 1000 and all(abs(r.weight - want[r.y]) < 1e-12 for r in got)


def test_bootstrap_rows_are_spread_before_the_draws(spark):
    rows = spark.range(400).select(F.col("id").alias("k"), F.col("id").cast("double").alias("v")).coalesce(1)
    w = B.bootstrap_weights(rows, "k", 3, seed=5)
    sizes = [r["count"] for r in w.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 400
    assert sum(sizes) == 1200


def test_bootstrap_weights_of_the_digest_are_those_of_the_number(spark):
    rows = spark.range(20000).select(ordering.hash_unit("id", seed=3).alias("u"), ordering.hash_digest("id", seed=3).alias("d"))
    assert rows.where(B.poisson1(F.col("u")) != B.poisson1_of_digest(F.col("d"))).count() == 0
    # draws at, just below and just above every cut
    cuts = [int(c * (1 << 52)) + d for c in B.POISSON1_CDF for d in (-1, 0, 1, 2) if int(c * (1 << 52)) + d < 1 << 52]
    edge = spark.createDataFrame([(n / (1 << 52), f"{n:013x}" + tail) for n in cuts for tail in ("0" * 19, "f" * 19)], "u double, d string")
    assert edge.where(B.poisson1(F.col("u")) != B.poisson1_of_digest(F.col("d"))).count() == 0


def test_sorted_quantiles_spread_a_value_that_all_rows_share(spark, monkeypatch):
    rows = spark.range(4000).select("id", F.when(F.col("id") < 3900, 7.0).otherwise(9.0).alias("v"))
    seen, numbered = [], ordering.global_row_number

    def number(df, order, name):
        seen.append(df.repartitionByRange(8, *order).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0])
        return numbered(df, order, name)

    monkeypatch.setattr(ordering, "global_row_number", number)
    got = {r.p: r.value for r in A.sorted_quantiles(rows, "v", [0.0, 0.5, 0.99, 1.0]).collect()}
    assert got == {0.0: 7.0, 0.5: 7.0, 0.99: 9.0, 1.0: 9.0}
    assert seen[0] < 2000


def test_quantile_positions_are_worked_out_once_per_group(spark):
    rows = spark.createDataFrame([(g, float(i)) for g in ("a", None) for i in range(11)], "g string, v double")
    for by in ([], ["g"]):
        q = A.group_quantiles(rows, by, ["v"], [0.25, 0.5, 0.75])
        assert "filter(transform(" not in _plan(q)
        assert [list(r["q"]) for r in q.collect()] == ([[2.5, 5.0, 7.5]] * 2 if by else [[2.25, 5.0, 7.75]])


def test_folds_are_dealt_once(spark):
    p = _plan(E.queries()["l9_cross_validation"](spark, SMALL))
    assert "md5(" not in p and "Window" not in p


def test_fold_comparison_shares_its_folds(spark, monkeypatch):
    from quarry.catalog import models

    dealt, deal = [], models.stratified_folds
    monkeypatch.setattr(models, "stratified_folds", lambda *a, **k: dealt.append(1) or deal(*a, **k))
    p = _plan(E.queries()["l10_compare_fold_scores"](spark, SMALL))
    assert len(dealt) == 1 and "md5(" not in p


def test_census_joins_and_scores_once(spark):
    p = _plan(E.queries()["census_flow"](spark, SMALL))
    assert "customer.parquet" not in p and "md5(" not in p
