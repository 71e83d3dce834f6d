"""Every query against DuckDB on the same tables."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from docsink.plans.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return repr(v)


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_value(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    got = _canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(spark_entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    want = _canonical(columns, cursor.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert got[1], "no rows to compare"
