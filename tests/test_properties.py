
import math

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from quarry.operators import evaluation as E
from quarry.operators import features as T
from quarry.operators import models as M
from quarry.operators import sampling as B
from quarry.operators import stats as X
from quarry.session import table


def test_minmax_in_unit_interval_on_fit_set(spark):
    li = table(spark, SMALL, "lineitem")
    out = T.apply_minmax(li, T.fit_minmax(li, ["l_extendedprice"]), ["l_extendedprice"])
    lo, hi = out.agg(F.min("l_extendedprice"), F.max("l_extendedprice")).first()
    assert lo == 0.0 and hi == 1.0


def test_zscore_population(spark):
    li = table(spark, SMALL, "lineitem")
    out = T.apply_zscore(li, T.fit_zscore(li, ["l_quantity"]), ["l_quantity"])
    m, s = out.agg(F.avg("l_quantity"), F.stddev_pop("l_quantity")).first()
    assert abs(m) < 1e-9 and abs(s - 1) < 1e-9


def test_one_hot_rows_sum_to_one(spark):
    p = table(spark, SMALL, "part")
    levels = T.fit_levels(p, "p_type")
    d = T.one_hot(p, "p_type", levels)
    total = sum(F.col(f"p_type_{lv}") for lv in levels)
    assert d.where(total != 1).count() == 0


def test_stratified_split_partitions_table_with_exact_shares(spark):
    o = table(spark, SMALL, "orders")
    s = B.stratified_split(o, "o_orderkey", "o_orderpriority", [0.6, 0.2, 0.2], ["a", "b", "c"], seed=1)
    assert s.count() == o.count()
    assert s.select("o_orderkey").distinct().count() == o.count()
    per = {(r.o_orderpriority, r.split): r.n for r in s.groupBy("o_orderpriority", "split").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    sizes = {r.o_orderpriority: r.n for r in o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).collect()}
    for g, n in sizes.items():
        assert per.get((g, "a"), 0) == math.floor(n * 0.6)


def test_folds_balanced(spark):
    o = table(spark, SMALL, "orders")
    f = B.stratified_folds(o, "o_orderkey", "o_orderpriority", 5, seed=2)
    counts = [r.n for r in f.groupBy("o_orderpriority", "fold").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(counts) - min(counts) <= 1 + max(counts) // 5


def test_confusion_total_and_auc_forms(spark):
    from quarry.catalog.stats import scored

    s = scored(spark, SMALL)
    n = s.count()
    assert E.confusion(s, "y", "pred").agg(F.sum("n")).first()[0] == n
    auc_rank = E.auc(s, "y", "score").first()[0]
    roc = E.roc_table(s, "y", "score").orderBy("fpr", "tpr").collect()
    pts = [(0.0, 0.0)] + [(r.fpr, r.tpr) for r in roc]
    trap = sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(pts, pts[1:]))
    assert abs(auc_rank - trap) < 1e-9


def test_bootstrap_ci_contains_estimate(spark):
    c = table(spark, SMALL, "customer")
    ci = X.bootstrap_ci(c, "c_custkey", "c_acctbal", 100, seed=1).first()
    mean = c.agg(F.avg("c_acctbal")).first()[0]
    assert ci.mean_lo <= mean <= ci.mean_hi


def test_fit_apply_same_data_equals_one_shot(spark):
    li = table(spark, SMALL, "lineitem")
    a = T.apply_zscore(li, T.fit_zscore(li, ["l_tax"]), ["l_tax"], "_z").select("l_tax_z")
    m, s = li.agg(F.avg("l_tax"), F.stddev_pop("l_tax")).first()
    b = li.select(((F.col("l_tax") - m) / s).alias("l_tax_z"))
    assert sorted(round(r[0], 9) for r in a.collect()) == sorted(round(r[0], 9) for r in b.collect())


def test_target_encoding_weight():
    assert abs(T.logit_weight(1) - 0.5) < 1e-12
    assert T.logit_weight(50) > 0.999


def test_stepwise_forward_matches_brute_force(spark):
    li = table(spark, SMALL, "lineitem")
    train, valid = li.where(F.col("l_linenumber") % 2 == 0), li.where(F.col("l_linenumber") % 2 == 1)
    feats = ["l_quantity", "l_discount", "l_tax"]
    for direction in ("forward", "backward"):
        path = M.stepwise_select(train, valid, feats, "l_returnflag", direction).orderBy("step").collect()
        assert [r.n_features for r in path] == ([1, 2, 3] if direction == "forward" else [3, 2, 1])
        assert sum(r.best for r in path) == 1
        kept = [] if direction == "forward" else list(feats)
        for step in path:
            changes = [] if step.feature == "*" else [f for f in feats if (f in kept) == (direction == "backward")]
            sets = {f: [g for g in feats if (g in kept) != (g == f)] for f in changes} or {"*": kept}
            found = {}
            for name, fs in sets.items():
                params = M.fit_gaussian_nb(train, fs, "l_returnflag")
                pred = M.predict_gaussian_nb(valid, params, fs, "l_returnflag")
                found[name] = pred.agg(F.avg((F.col("prediction") == F.col("l_returnflag")).cast("double"))).first()[0]
            assert step.feature == max(found, key=found.get) and abs(step.accuracy - found[step.feature]) < 1e-12
            kept = sets[step.feature]
