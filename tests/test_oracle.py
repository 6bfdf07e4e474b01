"""Every query with a SQL twin matches DuckDB on the sf0.001 tables."""

import math

import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SMALL

SQL = E.oracle_sql()
QUERIES = E.queries()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def _close(a, b):
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, duck, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    want = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = _rows(got), _rows(want)
    assert len(a) == len(b)
    for r, s in zip(a, b):
        assert all(_close(x, y) for x, y in zip(r, s)), (r, s)
