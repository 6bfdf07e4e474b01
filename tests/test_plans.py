"""Plan-shape checks: pushdown, pruning, one hash per bootstrap draw, no
single-partition window over raw rows in the distributed helpers."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL
from quarry.operators.ordering import hash_unit, position_within
from quarry.session import table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_pushed_and_columns_pruned(spark):
    p = _plan(E.queries()["f2_bounding_box"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(c_acctbal), IsNotNull(c_nationkey), GreaterThanOrEqual(c_acctbal" in p
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_acctbal:double>" in p


def test_projection_prunes_scan(spark):
    p = _plan(E.queries()["s8_column_pruned_scan"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in p


def test_bootstrap_hashes_once_per_draw(spark):
    p = _plan(E.queries()["b5_bootstrap_moments"](spark, SMALL))
    assert len(re.findall(r"md5\(", p)) == 1
    # partial aggregation right after the generator: the R-fold rows are not shuffled
    assert p.index("partial_sum") < p.index("Generate")


def test_position_within_has_no_single_partition_window(spark):
    o = table(spark, SMALL, "orders")
    p = _plan(position_within(o, ["o_orderpriority"], hash_unit("o_orderkey", seed=1), "pos", tiebreak=["o_orderkey"]))
    for m in re.finditer(r"Window \[.*?\], \[(.*?)\]", p):
        assert m.group(1).strip(), "window without partition keys"


def test_group_total_is_aggregate_plus_join(spark):
    p = _plan(E.queries()["w1_group_total"](spark, SMALL))
    assert "Window" not in p and "HashAggregate" in p and "Join" in p


def test_daylight_labels_are_a_projection_of_one_scan(spark):
    p = _plan(E.queries()["j7_daylight_classify"](spark, SMALL))
    assert "Join" not in p and "Exchange" not in p


def test_exact_quantiles_hold_no_map_of_raw_values(spark):
    for name in ("a3_group_describe", "a4_group_median", "a9_describe_numeric", "a10_filtered_describe",
                 "n5_median_replace", "t8_quantile_bins", "c2_box_stats", "c4_qq_points", "x21_profile"):
        p = _plan(E.queries()[name](spark, SMALL))
        assert "percentile(" not in p and "median(" not in p, name
