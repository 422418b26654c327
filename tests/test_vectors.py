"""Nearest vectors against SQL and against all pairs, with ties, odd vectors, several slices and groups."""

import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from weft.operators import cosine_top_k, vectors
from weft.plans import QUERIES


def compared(spark, folder, ids, values):
    pq.write_table(pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(values, pa.list_(pa.float32())), "label": pa.array([0] * len(ids), pa.int32())}), folder / "embeddings.parquet")
    query, sql = QUERIES["p43_vector_top_k"]
    found = query(spark, str(folder))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    got, want = (sorted(map(str, rows)) for rows in (map(tuple, found.select("query_id", "vec_id", "similarity", "rank").collect()), con.sql(f"SELECT query_id, vec_id, similarity, rank FROM ({sql})").fetchall()))
    assert got == want
    return found


def test_ties_over_slices_and_no_row_a_pair(spark, tmp_path, monkeypatch):
    """The query used to make a row for each pair in a nested-loop join."""
    monkeypatch.setattr(vectors, "QUERY_NUMBERS", 8 * 40)
    r = np.random.default_rng(3)
    values = np.round(r.normal(size=(10_000, 8)), 1)
    values[r.random(10_000) < 0.2] = values[0]  # copies, of a query too
    values[r.random(10_000) < 0.1] = 2 * values[1]
    ids = r.permutation(10_000) - 300
    found = compared(spark, tmp_path, ids.tolist(), values.tolist())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("CartesianProduct", "NestedLoop"))


def test_odd_vectors(spark, tmp_path):
    """A zero vector used to raise DIVIDE_BY_ZERO."""
    r = random.Random(5)
    values = [[r.gauss(0, 1) for _ in range(4)] for _ in range(400)]
    for k in (50, 7, 8, 9, 10, 11, 12):
        values[k] = [0.0] * 4
    values[100] = values[13] = None
    values[150], values[14] = [math.nan, 1.0, 0.0, 0.0], [math.inf, 1.0, 0.0, 0.0]
    values[200], values[15], values[16] = [1e30] * 4, [1e-30] * 4, [-1e30] * 4
    compared(spark, tmp_path, list(range(400)), values)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, tmp_path, n):
    compared(spark, tmp_path, list(range(0, 50 * n, 50)), [[1.0, float(k)] for k in range(n)])


def test_repeated_and_missing_ids(spark, tmp_path):
    r = random.Random(7)
    compared(spark, tmp_path, [r.choice([None, -50, 0, 50, *range(1, 9)]) for _ in range(60)], [[r.choice([-1.0, 0.5, 2.0]) for _ in range(3)] for _ in range(60)])


def test_widths_and_nulls_inside(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0, 0.0]), (2, [2.0, 4.0]), (3, [1.0, None]), (4, []), (5, [3.0]), (6, [1.0, 0.0]), (7, [1.0] * 9)]
    df = spark.createDataFrame(rows, "i long, v array<double>")
    got = cosine_top_k(df, F.col("i").isin(0, 5), "i", "v", 3, 4).collect()
    assert sorted(map(tuple, got), key=lambda x: (x[0], x[3])) == [(0, 2, 1.0, 1), (0, 6, 0.4472, 2), (0, 1, None, 3), (5, 0, None, 1), (5, 1, None, 2), (5, 2, None, 3)]


def test_only_a_null_query(spark):
    df = spark.createDataFrame([(0, None), (1, [1.0]), (2, [2.0, 3.0])], "i int, v array<double>")
    assert sorted(map(tuple, cosine_top_k(df, F.col("i") == 0, "i", "v", 5, 6).collect())) == [(0, 1, None, 1), (0, 2, None, 2)]
