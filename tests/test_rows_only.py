"""Queries without a SQL twin (models, p-values, PCA, iterative selection) run
and return rows with a stable schema."""

import pytest

import __spark_entry__ as E
from quarry.catalog import REGISTRY
from conftest import SMALL

NO_SQL = sorted(name for name, (_fn, sql) in REGISTRY.items() if sql is None)


@pytest.mark.parametrize("name", NO_SQL)
def test_runs(spark, name):
    df = E.queries()[name](spark, SMALL)
    schema = df.schema
    rows = df.collect()
    assert len(rows) > 0
    assert E.queries()[name](spark, SMALL).schema == schema
