"""Every catalog query against its SQL on the smallest tables."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as driver
from tests.conftest import DATA
from tradewind.catalog import ENTRIES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
ORACLE = driver.oracle_sql()
KEYS = sorted(ENTRIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return f"{v.normalize():f}"
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return repr(v)


def _table(columns, data):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(_plain(r[i]) for i in at) for r in data)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(spark, duck, key):
    df = driver.queries()[key](spark, DATA)
    got = _table(df.columns, df.collect())
    result = duck.execute(ORACLE[key])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == _table(columns, result.fetchall())


def test_every_query_has_sql():
    assert set(KEYS) <= set(driver.queries())
    assert set(KEYS) <= set(ORACLE)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["category", "total_revenue"]
    assert df.count() == 6
