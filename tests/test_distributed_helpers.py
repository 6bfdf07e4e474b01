"""The distributed numbering / running-sum helpers equal brute force."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators.ordering import global_row_number, global_running_sum, hash_unit, position_within


def test_global_row_number_matches_sort(spark):
    rnd = random.Random(3)
    data = [(i, rnd.randint(0, 20)) for i in range(500)]
    df = spark.createDataFrame(data, "k int, v int").repartition(7)
    got = {r.k: r.rn for r in global_row_number(df, [F.asc("v"), F.asc("k")], "rn").collect()}
    want = {k: i + 1 for i, (k, _) in enumerate(sorted(data, key=lambda t: (t[1], t[0])))}
    assert got == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(-3, 9)), min_size=1, max_size=60))
def test_running_sum_property(spark, pairs):
    data = [(i, g, v) for i, (g, v) in enumerate(pairs)]
    df = spark.createDataFrame(data, "k int, g int, v int").repartition(3)
    got = {r.k: r.running for r in global_running_sum(df, [F.desc("g"), F.asc("k")], "v").collect()}
    acc, want = 0, {}
    for k, g, v in sorted(data, key=lambda t: (-t[1], t[0])):
        acc += v
        want[k] = acc
    assert got == want


def test_position_within_groups(spark):
    data = [(i, "hot" if i % 3 else f"g{i % 7}") for i in range(900)]
    df = spark.createDataFrame(data, "k int, g string")
    got = position_within(df, ["g"], hash_unit("k", seed=1), "pos", buckets=16, tiebreak=["k"])
    rows = got.withColumn("u", hash_unit("k", seed=1)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.g, []).append((r.u, r.k, r.pos))
    for items in by.values():
        items.sort()
        assert [p for _, _, p in items] == list(range(1, len(items) + 1))
