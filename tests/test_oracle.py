"""Every registered query against its DuckDB twin on the smallest driver tables.

Same comparison as the driver's correctness gate: column names, column
types, row count and an order-insensitive comparison of exact values.
"""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from orderlake.plans import oracle, registry
from orderlake.sources.fixtures import TABLES
from tests.conftest import SF_SMALL

QUERIES, ORACLE = registry.QUERIES, oracle.ORACLE  # the optional queries have tests of their own
SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE"}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, records):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in idx) for r in records),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    exp = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert {c: str(t) for c, t in zip(cols, [d[1] for d in res.description])} == {c: types[c] for c in cols}
    assert len(got) == len(exp)
    assert _rows(df.columns, got) == _rows(cols, exp)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "gross_revenue" in df.columns
