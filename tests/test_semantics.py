"""Semantics of individual operators on small literal tables (hand-computed values)."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.operators import aggregates as A
from quarry.operators import features as T
from quarry.operators import nulls as N
from quarry.operators import stats as X
from quarry.operators import windows as W
from quarry.operators.daylight import daylight_dimension


def test_qcut_right_closed_lowest_included(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8]], "x double")
    out = T.apply_quantile_bins(df, T.fit_quantile_edges(df, "x", 4), "x", 4)
    bins = {r.x: r.bin for r in out.collect()}
    # edges 1, 2.75, 4.5, 6.25, 8 -> (lowest included) [1,2.75], (2.75,4.5], (4.5,6.25], (6.25,8]
    assert bins == {1.0: 0, 2.0: 0, 3.0: 1, 4.0: 1, 5.0: 2, 6.0: 2, 7.0: 3, 8.0: 3}


def test_target_encoding_hand_values(spark):
    rows = [("a", 1.0), ("a", 0.0), ("a", 1.0), ("b", 1.0), ("c", 0.0), ("c", 0.0)]
    df = spark.createDataFrame(rows, "k string, y double")
    enc = {r.k: r.enc for r in T.fit_target_encoding(df, "k", "y").collect()}
    prior = 3 / 6
    w_a = 1 / (1 + math.exp(-(3 - 1) / 1.0))
    w_c = 1 / (1 + math.exp(-(2 - 1) / 1.0))
    assert abs(enc["a"] - (prior * (1 - w_a) + (2 / 3) * w_a)) < 1e-12
    assert abs(enc["b"] - prior) < 1e-12  # seen once -> prior
    assert abs(enc["c"] - (prior * (1 - w_c) + 0.0 * w_c)) < 1e-12
    test = spark.createDataFrame([("a",), ("zzz",)], "k string")
    out = {r.k: r.k_te for r in T.apply_target_encoding(test, T.fit_target_encoding(df, "k", "y"), "k").collect()}
    assert abs(out["zzz"] - prior) < 1e-12


def test_ordinal_unknown_minus_one(spark):
    df = spark.createDataFrame([("low",), ("high",), (None,), ("odd",)], "v string")
    got = [r[0] for r in df.select(T.ordinal("v", ["low", "mid", "high"])).collect()]
    assert got == [0, 2, -1, -1]


def test_threshold_bins_intervals(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (10.0,), (None,)], "x double")
    got = [r[0] for r in df.select(T.threshold_bins("x", [0, 10], ["neg", "low", "high"])).collect()]
    assert got == ["neg", "low", "high", None]


def test_value_counts_dropna(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "v string")
    assert {r.v: r.n for r in A.value_counts(df, "v").collect()} == {"a": 2, "b": 1}
    assert {r.v: r.n for r in A.value_counts(df, "v", dropna=False).collect()} == {"a": 2, "b": 1, None: 1}


def test_running_share_order(spark):
    freq = spark.createDataFrame([("x", 5), ("y", 3), ("z", 5)], "v string, n long")
    got = [(r.v, r.rank, r.cum_n) for r in W.running_share(freq, "v").orderBy("rank").collect()]
    assert got == [("x", 1, 5), ("z", 2, 10), ("y", 3, 13)]


def test_median_replacement(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 0.0), (3, 30.0), (4, 999.0)], "k int, x double")
    out = {r.k: r.x for r in N.replace_flagged_by_median(df, "x", F.col("x") > 100).collect()}
    assert out == {1: 10.0, 2: 0.0, 3: 30.0, 4: 20.0}  # median of positive unflagged values 10, 30


def test_hot_deck_deterministic_and_from_donors(spark):
    df = spark.createDataFrame([(i, float(i) if i % 4 else -1.0) for i in range(200)], "k int, x double")
    a = {r.k: r.x for r in N.hot_deck(df, "k", "x", F.col("x") < 0, seed=3).collect()}
    b = {r.k: r.x for r in N.hot_deck(df, "k", "x", F.col("x") < 0, seed=3).collect()}
    donors = {float(i) for i in range(200) if i % 4}
    assert a == b
    assert all(v in donors for v in a.values())


def test_welch_against_hand(spark):
    rows = [("a", v) for v in [1.0, 2.0, 3.0, 4.0]] + [("b", v) for v in [2.0, 4.0, 6.0]]
    df = spark.createDataFrame(rows, "g string, x double")
    r = X.welch_t(df, "g", "a", "b", ["x"], with_p=True).first()
    m1, m2, v1, v2 = 2.5, 4.0, 5 / 3, 4.0
    t = (m1 - m2) / math.sqrt(v1 / 4 + v2 / 3)
    dof = (v1 / 4 + v2 / 3) ** 2 / ((v1 / 4) ** 2 / 3 + (v2 / 3) ** 2 / 2)
    assert abs(r.t - t) < 1e-12 and abs(r.df - dof) < 1e-9
    assert 0 < r.p < 1


def test_ks_two_sample_brute_force(spark):
    a = [1.0, 2.0, 2.0, 5.0, 7.0]
    b = [2.0, 3.0, 4.0, 8.0]
    df = spark.createDataFrame([("a", v) for v in a] + [("b", v) for v in b], "g string, x double")
    d = X.ks_two_sample(df, "x", "g", "a", "b").first().d
    pts = sorted(set(a + b))
    want = max(abs(sum(v <= p for v in a) / len(a) - sum(v <= p for v in b) / len(b)) for p in pts)
    assert abs(d - want) < 1e-12


def test_spearman_uses_the_rows_complete_for_a_pair(spark):
    rows = [(None, 3.0, 1.0), (2.0, None, 1.0), (3.0, 1.0, None), (4.0, 4.0, 2.0), (5.0, 4.0, 2.0), (1.0, 8.0, 3.0),
            (1.0, 2.0, 9.0), (7.0, 6.0, 5.0)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    want = pd.DataFrame(rows, columns=["x", "y", "z"]).corr(method="spearman")
    got = X.correlation_long(df, ["x", "y", "z"], method="spearman").collect()
    assert len(got) == 9
    for r in got:
        assert abs(r["corr"] - want.loc[r.var1, r.var2]) < 1e-12
    # no complete row, a constant column, an empty table: NULL
    for source in (df.where("x IS NULL"), df.withColumn("x", F.lit(1.0)), df.limit(0)):
        assert X.spearman_pairs(source, [("x", "y")]).first()["corr"] is None


def test_auc_counts_ties_half_and_skips_missing_scores(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1), (0, 0.4), (1, None), (None, 0.5)]
    df = spark.createDataFrame(rows, "y int, s double")
    from quarry.operators.evaluation import auc

    pos, neg = [0.9, 0.4], [0.9, 0.1, 0.4]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / 6
    assert abs(auc(df, "y", "s").first().auc - want) < 1e-12
    assert auc(df.where("y = 1"), "y", "s").first().auc is None
    assert auc(df.limit(0), "y", "s").first().auc is None


def test_group_quantiles_equal_numpy_in_every_group(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "a", "b", None]), float(rng.randrange(30)), None if rng.random() < 0.2 else rng.random())
            for _ in range(400)] + [("one", 5.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.column): r.q for r in A.group_quantiles(df, ["g"], ["x", "y"], probs).collect()}
    assert ("one", "y") not in got and got["one", "x"] == [5.0] * 6
    for g in ("a", "b", None):
        for i, c in ((1, "x"), (2, "y")):
            values = [r[i] for r in rows if r[0] == g and r[i] is not None]
            assert np.allclose(got[g, c], np.quantile(values, probs), atol=1e-12)
    assert A.group_quantiles(df.limit(0), [], ["x"], probs).count() == 0
    by_itself = {r.x: r.q for r in A.group_quantiles(df, ["x"], ["x"], [0.5]).collect()}
    assert all(q == [x] for x, q in by_itself.items())
    empty = {(r.column, r.stat): r.value for r in A.describe(df.limit(0), ["x"]).collect()}
    assert empty["x", "count"] == 0 and empty["x", "q50"] is None and len(empty) == 8


def test_daylight_order_and_plausible_sunrise(spark):
    df = spark.createDataFrame([("2024-06-21",), ("2024-12-21",)], "d string").select(F.to_date("d").alias("d"))
    rows = {str(r.day): r for r in daylight_dimension(df, "d", 39.14, -77.20, -5.0).collect()}
    for r in rows.values():
        seq = [r.blue_am_start, r.golden_am_start, r.golden_am_end, r.golden_pm_start, r.blue_pm_start, r.blue_pm_end]
        assert seq == sorted(seq)
    # golden hour starts (sun at -4 deg) about 25 min before a ~4:43 standard-time sunrise at the solstice
    jun = rows["2024-06-21"]
    assert 4 * 3600 <= jun.golden_am_start <= 4 * 3600 + 45 * 60
    assert rows["2024-12-21"].golden_pm_start < jun.golden_pm_start


def test_group_pairs_no_join(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "g string, n int")
    got = sorted((r.l.g, r.r.g) for r in X.group_pairs(df, "g").collect())
    assert got == [("a", "b"), ("a", "c"), ("b", "c")]


def test_sorted_quantiles_equal_percentile(spark):
    from conftest import SMALL
    from quarry.session import table

    li = table(spark, SMALL, "lineitem")
    probs = [0.0, 0.1, 0.25, 0.5, 0.745, 1.0]
    got = {r.p: r.value for r in A.sorted_quantiles(li, "l_extendedprice", probs).collect()}
    want = li.agg(F.percentile("l_extendedprice", F.array(*[F.lit(p) for p in probs]))).first()[0]
    for p, w in zip(probs, want):
        assert abs(got[p] - w) < 1e-6 * max(1.0, abs(w))


def test_null_class_rows_are_kept(spark):
    from quarry.operators import sampling as B

    rows = [(i, None if i % 5 == 0 else ("a" if i % 2 else "b")) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, y string")
    assert B.stratified_split(df, "k", "y", [0.5, 0.5], ["x", "z"], seed=1).count() == 100
    folds = B.stratified_folds(df, "k", "y", 4, seed=1)
    assert folds.count() == 100 and folds.where(F.col("y").isNull()).count() == 20
    tot = W.with_group_total(df.withColumn("v", F.lit(1)), ["y"], "v")
    assert tot.where(F.col("y").isNull()).agg(F.max("group_total")).first()[0] == 20


def test_daylight_is_a_projection_and_null_stays_null(spark):
    from quarry.operators.daylight import classify_daylight

    df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2024-06-01 17:00:00'), (2, NULL), "
                   "(3, TIMESTAMP_NTZ'2024-06-01 06:00:00') AS t(id, ts)")
    out = classify_daylight(df, "ts", 39.14, -77.20, -5.0)
    assert out.columns == ["id", "ts", "daylight"]
    assert {r.id: r.daylight for r in out.collect()} == {1: "day", 2: None, 3: "night"}
    assert "Join" not in out._jdf.queryExecution().toString()


def test_intervals_without_a_dimension_row_give_null(spark):
    from quarry.operators.joins import classify_in_intervals

    df = spark.createDataFrame([(1, 5), (1, 50), (2, 5), (None, 5), (1, None)], "d int, v int")
    dim = spark.createDataFrame([(1, 10)], "day int, noon int")
    out = classify_in_intervals(df, dim, F.col("d"), "day", F.col("v"), [("noon", "am")], "pm")
    assert {(r.d, r.v): r["class"] for r in out.collect()} == {
        (1, 5): "am", (1, 50): "pm", (2, 5): None, (None, 5): None, (1, None): None}


def test_hot_deck_donors_without_a_key(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (3, 3.0), (4, -1.0), (5, -1.0), (None, -1.0)], "k int, x double")
    out = N.hot_deck(df, "k", "x", F.col("x") < 0, seed=3).collect()
    assert len(out) == 6 and all(r.x in (1.0, 2.0, 3.0) for r in out)


def test_label_by_position_without_a_label(spark):
    from quarry.functions.columns import label_by_position

    df = spark.createDataFrame([(-1,), (0,), (1,), (2,), (None,)], "c int")
    assert [r[0] for r in df.select(label_by_position("c", ["a", "b"])).collect()] == [None, "a", "b", None, None]
