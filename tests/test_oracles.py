"""Every registered query against its DuckDB oracle on sf0.001 (rows-only keys must run)."""

import math

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL


# Spark simple type -> DuckDB type of the same values
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert df.columns
        return
    rel = duck.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == duck_types
    assert _rows(df.columns, rows) == _rows(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
