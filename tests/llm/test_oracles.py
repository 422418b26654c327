"""The queries that SQL can express against that SQL, and what is registered."""

import duckdb
import pytest

from weft.llm import queries


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, sf_dir).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_all_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names
