"""Every registered query against its DuckDB oracle at sf0.001 (order-insensitive)."""

import re

import pytest

import __spark_entry__ as ENTRY
from oracle_compare import compare, duck

from conftest import SF_SMALL

# the training-data queries have tests of their own
QUERIES = {k: f for k, f in ENTRY.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
SQL = {k: q for k, q in ENTRY.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle_or_is_documented():
    rows_only = set(QUERIES) - set(SQL)
    assert not rows_only
    assert set(SQL) <= set(QUERIES)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle_column_types_match(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    ours = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema.fields}
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SQL.get(name), SF_SMALL)
    if SQL.get(name) is None:
        assert r["spark_rows"] > 0
    else:
        assert r["cols_match"], r
        assert r["spark_rows"] == r["duck_rows"] > 0, r
        assert r["exact"], r


def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    assert df.count() > 0
    assert df.columns[:7] == ["id", "location", "latitude", "longitude_w", "lanes", "type", "highway"]
