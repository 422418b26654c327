import datetime

import pytest
from pyspark.sql import functions as F

from weft.operators import as_of_join, group_percentiles, interval_join, latest_per_key, range_join, salted_join, sessionize, sized_join, top_k
from weft.sources import read_table, register_views, write_bucketed, write_table


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_as_of_ties_nulls_and_no_match(spark):
    left = spark.createDataFrame([("a", 5, 1), ("a", 5, 2), ("a", 1, 3), ("b", 9, 4), ("a", None, 5)], "k string, t int, id int")
    right = spark.createDataFrame([("a", 5, 10), ("a", 5, 11), ("a", 3, 12), ("a", None, 99), ("b", 10, 13)], "k string, t int, v int")
    got = as_of_join(left, right, ["k"], "t", ["v"])
    assert rows(got.select("id", "r_t", "r_v")) == [(1, 5, 11), (2, 5, 11), (3, None, None), (4, None, None), (5, None, None)]
    assert as_of_join(left.limit(0), right, ["k"], "t", ["v"]).count() == 0


@pytest.mark.parametrize("width", [0.5, 3.0, 100.0])
def test_range_join(spark, width):
    points = spark.createDataFrame([(float(p),) for p in range(-5, 20)] + [(None,)], "p double")
    ranges = spark.createDataFrame([(0.0, 3.0, "x"), (2.5, 9.0, "y"), (5.0, 5.0, "empty"), (None, 4.0, "null")], "a double, b double, name string")
    want = sorted((float(p), n) for p in range(-5, 20) for a, b, n in [(0, 3, "x"), (2.5, 9, "y")] if a <= p < b)
    assert sorted(map(tuple, range_join(points, ranges, "p", "a", "b", width).select("p", "name").collect())) == want


@pytest.mark.parametrize("width", [0.7, 4.0, 50.0])
def test_interval_join(spark, width):
    import random

    r = random.Random(2)
    make = lambda n: [(k, a := round(r.uniform(-20, 20), 2), a + r.choice([0, 0.5, 3, 12])) for k in range(n)]
    left, right = make(60), make(50)
    want = sorted((i, j) for i, a, b in left for j, c, d in right if a < b and c < d and a < d and c < b)
    a = spark.createDataFrame([*left, (99, None, 1.0)], "i int, a double, b double")
    b = spark.createDataFrame([*right, (99, 1.0, None)], "j int, c double, d double")
    assert rows(interval_join(a, b, ("a", "b"), ("c", "d"), width).select("i", "j")) == sorted(want, key=str)


def test_sized_join_broadcasts_small_sides_only(spark, sf_dir):
    orders, customer = read_table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "k"), read_table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "k")
    hinted = lambda most: "strategy=broadcast" in sized_join(orders, customer, ["k"], most_bytes=most)._jdf.queryExecution().analyzed().toString()
    assert hinted(1 << 30) and not hinted(10)
    assert sized_join(orders, customer, ["k"], most_bytes=10).count() == sized_join(orders, customer, ["k"]).count() == orders.join(customer, "k").count()


def test_percentiles_are_exact(spark):
    import numpy as np

    data = [(k % 3, float(k * 37 % 101)) for k in range(200)] + [(0, None), (5, 2.5), (6, None)]
    got = {r.g: (r.a, r.b, r.c) for r in group_percentiles(spark.createDataFrame(data, "g int, v double"), ["g"], "v", {"a": 0.0, "b": 0.5, "c": 0.93}).collect()}
    for g in (0, 1, 2, 5):
        assert np.allclose(got[g], np.quantile([v for k, v in data if k == g and v is not None], [0, 0.5, 0.93]))
    assert 6 not in got


def test_names_that_operators_use_may_be_columns(spark):
    left = spark.createDataFrame([("a", 5, 1, 2), ("a", 1, 3, 4)], "k string, t int, mine int, cell int")
    right = spark.createDataFrame([("a", 3, 9)], "k string, t int, theirs int")
    assert rows(as_of_join(left, right, ["k"], "t", ["theirs"]).select("mine", "cell", "r_theirs")) == [(1, 2, 9), (3, 4, None)]
    assert rows(latest_per_key(left.withColumnRenamed("mine", "m"), ["k"], "t")) == [("a", 5, 1, 2)]
    assert rows(salted_join(left.withColumnRenamed("mine", "salt"), right.drop("t"), ["k"]).select("salt", "theirs")) == [(1, 9), (3, 9)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join(spark, how):
    left = spark.createDataFrame([(k % 3, k) for k in range(60)] + [(None, 99)], "k int, v int")
    right = spark.createDataFrame([(0, "x"), (1, "y"), (1, "z")], "k int, w string")
    assert rows(salted_join(left, right, ["k"], 4, how)) == rows(left.join(right, ["k"], how))
    with pytest.raises(ValueError):
        salted_join(left, right, ["k"], 4, "full")


def test_ranking(spark):
    df = spark.createDataFrame([("a", 1, "p"), ("a", 3, "q"), ("a", 3, "r"), ("b", None, "s")], "k string, t int, v string")
    assert rows(latest_per_key(df, ["k"], "t")) == [("a", 3, "r"), ("b", None, "s")]
    assert rows(top_k(df, ["k"], [F.desc("t"), F.col("v")], 2).select("k", "v", "rank")) == [("a", "q", 1), ("a", "r", 2), ("b", "s", 1)]


def test_sessions(spark):
    t = lambda m: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m)
    df = spark.createDataFrame([("a", t(0)), ("a", t(30)), ("a", t(61)), ("b", t(0)), ("a", t(30))], "k string, ts timestamp_ntz")
    got = sessionize(df, ["k"], "ts", 1800)
    assert rows(got.groupBy("k", "session").count()) == [("a", 1, 3), ("a", 2, 1), ("b", 1, 1)]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_formats(spark, tmp_path, fmt, sf_dir):
    df = read_table(spark, sf_dir, "supplier").unionByName(spark.createDataFrame([(7, 'say "a,b"\nc', 1, None)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"))
    write_table(df, str(tmp_path), "supplier", fmt)
    assert rows(read_table(spark, str(tmp_path), "supplier", fmt, df.schema)) == rows(df)
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path), "supplier", "xls")


def test_partitions_and_buckets(spark, tmp_path, sf_dir):
    nation = read_table(spark, sf_dir, "nation")
    write_table(nation, str(tmp_path), "nation", partition_by=["n_regionkey"])
    assert read_table(spark, str(tmp_path), "nation").where("n_regionkey = 1").count() == nation.where("n_regionkey = 1").count()
    write_bucketed(nation, "nation_by_key", 4, "n_nationkey")
    plan = spark.table("nation_by_key").hint("merge").join(spark.table("nation_by_key").hint("merge"), "n_nationkey")._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    spark.sql("DROP TABLE nation_by_key")


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = read_table(spark, sf_dir, "lineitem").where("l_quantity > 49").select("l_orderkey")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,49.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_views(spark, sf_dir):
    register_views(spark, sf_dir)
    assert spark.sql("SELECT count(*) FROM region").first()[0] == 5


def test_registered_functions(spark):
    from weft.functions.registry import register_functions

    register_functions(spark)
    assert spark.sql("SELECT weft_digits('a1b22'), weft_digits(NULL)").first()[0:2] == ("122", None)
    made = spark.createDataFrame([(1, 2.0), (1, 8.0), (1, None), (2, -1.0), (3, None)], "g int, v double")
    made.createOrReplaceTempView("made_values")
    assert {r.g: r.m for r in spark.sql("SELECT g, weft_geometric_mean(v) AS m FROM made_values GROUP BY g").collect()} == {1: 4.0, 2: None, 3: None}
    assert rows(spark.sql("SELECT word_no, word FROM weft_words('It is: so')")) == [(1, "It"), (2, "is"), (3, "so")]
    assert spark.sql("SELECT * FROM weft_words(NULL)").count() == 0


def test_late_rows_are_dropped_and_state_is_evicted(spark, tmp_path, sf_dir):
    """The last batch's copies are counted as dropped by the watermark, and no closed window stays."""
    from weft.streaming import hourly_counts, late_copies

    stream = hourly_counts(late_copies(spark, sf_dir, f"file://{tmp_path}"))
    query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in states) > 0
    assert states[-1]["numRowsTotal"] < max(s["numRowsTotal"] for s in states) or sum(s["numRowsRemoved"] for s in states) > 0
    events = read_table(spark, sf_dir, "events")
    assert spark.read.parquet(f"{tmp_path}/out").agg(F.sum("n")).first()[0] < events.count()


def test_streams_need_a_shared_folder_on_a_cluster():
    from weft.streaming import stream_folder

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError):
        stream_folder(Session)
    Session.conf["spark.checkpoint.dir"] = "hdfs://x/y/"
    assert stream_folder(Session) == "hdfs://x/y"
