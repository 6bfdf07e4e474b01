"""Driver contract: entry, queries, oracle_sql."""

import re

import __spark_entry__ as E
from quarry.catalog import REGISTRY


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["c_mktsegment", "o_orderpriority", "n", "share"]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_query_names():
    for name in E.queries():
        assert re.fullmatch(r"[a-z0-9_]+", name)
    for name in REGISTRY:
        assert "pipeline" not in name and not re.match(r"op\d+_", name)


def test_most_queries_have_twins():
    with_sql = [name for name, (_fn, sql) in REGISTRY.items() if sql]
    assert len(with_sql) / len(REGISTRY) > 0.8
