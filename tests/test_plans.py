"""Every registered query against its SQL in DuckDB over the same tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from weft.plans import QUERIES
from weft.sources import TABLES

ORACLE_DIR = "/root/testdata/sf0.001"


def plain(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return x


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(columns), sorted((tuple(plain(r[k]) for k in order) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{ORACLE_DIR}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    query, sql = QUERIES[name]
    found = query(spark, ORACLE_DIR)
    got = table(found.columns, found.collect())
    want = duck.sql(sql)
    assert got == table(want.columns, want.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 10
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
