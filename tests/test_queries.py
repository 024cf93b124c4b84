"""Every registered query against its SQL on the smallest test tables."""

import datetime
import decimal
import math
import os

import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = contract.QUERIES, contract.SQL
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float) and not isinstance(value, bool):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_sql(spark, duck, key):
    df = QUERIES[key](spark, SF_DIR)
    got = table_of(df.columns, df.collect())
    cursor = duck.execute(SQL[key])
    want = table_of([c[0] for c in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_every_query_has_sql():
    """All but the one that is compared with double sums in test_bandwidth.py."""
    assert set(QUERIES) - set(SQL) == {"kde_plug_in"} and set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
