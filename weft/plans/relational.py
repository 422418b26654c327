"""Queries over the star schema. Sums of money are decimal, so their value doesn't depend on
the order of rows; every limit has a total order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.functions import l2_norm, revenue, share_of
from weft.functions.registry import register_functions
from weft.operators import cosine_top_k, group_percentiles, interval_join, latest_per_key, range_join, salted_join, sized_join, top_k
from weft.sources import read_table, register_views

_REVENUE = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
RELATIONAL_QUERIES: dict = {}


def query(sql: str | None):
    def register(f):
        RELATIONAL_QUERIES[f.__name__] = (f, sql)
        return f

    return register


def total(c, name: str):
    return F.sum(c).cast("double").alias(name)


@query(f"""
SELECT l_orderkey, o_orderdate, CAST(sum({_REVENUE}) AS DOUBLE) AS revenue
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE c_mktsegment = 'BUILDING' AND o_orderdate < TIMESTAMP '1998-03-15' AND l_shipdate > TIMESTAMP '1998-03-15'
GROUP BY l_orderkey, o_orderdate ORDER BY revenue DESC, l_orderkey LIMIT 10""")
def p01_top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten open orders of one segment that are worth most (a top-k report)."""
    customer = read_table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    orders = read_table(spark, sf_dir, "orders").where("o_orderdate < timestamp_ntz '1998-03-15'").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = read_table(spark, sf_dir, "lineitem").where("l_shipdate > timestamp_ntz '1998-03-15'").select("l_orderkey", revenue().alias("r"))
    joined = lines.join(orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left_semi"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("l_orderkey", "o_orderdate").agg(total("r", "revenue")).orderBy(F.desc("revenue"), "l_orderkey").limit(10)


@query(f"""
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty, CAST(sum({_REVENUE}) AS DOUBLE) AS sum_revenue,
  CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_discount, count(*) AS n_lines, count(DISTINCT l_suppkey) AS n_suppliers
FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-08-01' GROUP BY ALL""")
def p02_pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem").where("l_shipdate <= timestamp_ntz '2001-08-01'")
    discount = F.sum(F.col("l_discount").cast("decimal(18,2)")).cast("double")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        total(F.col("l_quantity").cast("decimal(18,2)"), "sum_qty"), total(revenue(), "sum_revenue"), (discount / F.count("*")).alias("avg_discount"),
        F.count("*").alias("n_lines"), F.countDistinct("l_suppkey").alias("n_suppliers"),
    )


@query("""
SELECT o_orderkey, upper(o_orderpriority) AS priority, substr(o_orderpriority, 1, 1) AS code, year(o_orderdate) AS y, month(o_orderdate) AS m,
  CASE WHEN o_totalprice >= 200000 THEN 'high' WHEN o_totalprice >= 50000 THEN 'middle' ELSE 'low' END AS band, o_orderkey % 7 AS bucket
FROM orders WHERE o_orderstatus IN ('O', 'P') AND o_orderpriority LIKE '%U%'""")
def p03_project_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("O", "P") & F.col("o_orderpriority").like("%U%"))
    band = F.when(F.col("o_totalprice") >= 200000, "high").when(F.col("o_totalprice") >= 50000, "middle").otherwise("low")
    return orders.select(
        "o_orderkey", F.upper("o_orderpriority").alias("priority"), F.substring("o_orderpriority", 1, 1).alias("code"), F.year("o_orderdate").cast("long").alias("y"), F.month("o_orderdate").cast("long").alias("m"),
        band.alias("band"), (F.col("o_orderkey") % 7).alias("bucket"),
    )


@query(f"""
SELECT n_name, r_name, CAST(sum({_REVENUE}) AS DOUBLE) AS revenue, count(*) AS n_lines
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def p04_inner_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are summed by supplier before they meet the dimensions."""
    lines = read_table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.sum(revenue()).alias("r"), F.count("*").alias("n"))
    where = read_table(spark, sf_dir, "nation").join(read_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").join(where, F.col("s_nationkey") == F.col("n_nationkey"))
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("n_name", "r_name").agg(total("r", "revenue"), F.sum("n").alias("n_lines"))


@query("""
SELECT c_custkey, count(o_orderkey) AS n_orders, max(o_orderdate) AS last_order
FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' GROUP BY c_custkey""")
def p05_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey")
    return customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_orders"), F.max("o_orderdate").alias("last_order"))


@query("""
SELECT coalesce(a.k, b.k) AS k, a.n AS n_urgent, b.n AS n_low FROM
  (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) a FULL JOIN
  (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1) b ON a.k = b.k""")
def p06_full_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "k")
    side = lambda p, name: orders.where(F.col("o_orderpriority") == p).groupBy("k").agg(F.count("*").alias(name))
    return side("1-URGENT", "n_urgent").join(side("5-LOW", "n_low"), "k", "full").select("k", "n_urgent", "n_low")


@query("""
SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)
  AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')""")
def p07_semi_anti_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    on = F.col("o_custkey") == F.col("c_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return customer.join(orders.where("o_totalprice > 300000"), on, "left_semi").join(orders.where("o_orderstatus = 'P'"), on, "left_anti")


@query("""
SELECT p_partkey, n_nationkey FROM part JOIN nation ON p_retailprice >= 900 + n_nationkey * 45 AND p_retailprice < 900 + n_nationkey * 45 + 60""")
def p08_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = read_table(spark, sf_dir, "nation").select("n_nationkey", (900 + F.col("n_nationkey") * 45).alias("low"), (960 + F.col("n_nationkey") * 45).alias("high"))
    points = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return range_join(points, ranges, "p_retailprice", "low", "high", 50.0).select("p_partkey", "n_nationkey")


@query("""
SELECT l_returnflag, s_nationkey, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL""")
def p09_salted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_orderkey", "l_partkey").withColumnRenamed("l_suppkey", "k")
    suppliers = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), "s_nationkey")
    return salted_join(lines, suppliers, ["k"], salts=8).groupBy("l_returnflag", "s_nationkey").agg(F.count("*").alias("n"))


@query("""
SELECT o_orderpriority, o_orderstatus, grouping(o_orderpriority) AS g1, grouping(o_orderstatus) AS g2, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)""")
def p10_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    sums = [F.grouping("o_orderpriority").cast("long").alias("g1"), F.grouping("o_orderstatus").cast("long").alias("g2"), F.count("*").alias("n"), total(F.col("o_totalprice").cast("decimal(18,2)"), "total")]
    return orders.cube("o_orderpriority", "o_orderstatus").agg(*sums)


@query("""
SELECT y, q, count(*) AS n FROM (SELECT year(o_orderdate) AS y, quarter(o_orderdate) AS q FROM orders) GROUP BY ROLLUP (y, q)""")
def p11_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("long").alias("y"), F.quarter("o_orderdate").cast("long").alias("q"))
    return orders.rollup("y", "q").agg(F.count("*").alias("n"))


@query("""
SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY GROUPING SETS ((c_mktsegment, c_nationkey), (c_nationkey), ())""")
def p12_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    return customer.groupingSets([["c_mktsegment", "c_nationkey"], ["c_nationkey"], []], "c_mktsegment", "c_nationkey").agg(F.count("*").alias("n"))


@query("""
SELECT o_custkey, o_orderkey, row_number() OVER w AS rn, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS rk, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS dr,
  lag(o_orderkey) OVER w AS before, lead(o_orderkey) OVER w AS after, ntile(4) OVER w AS quarter_of,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS last_three
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def p13_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, ties = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"), Window.partitionBy("o_custkey").orderBy("o_orderdate")
    orders = read_table(spark, sf_dir, "orders")
    return orders.select(
        "o_custkey", "o_orderkey", F.row_number().over(w).cast("long").alias("rn"), F.rank().over(ties).cast("long").alias("rk"), F.dense_rank().over(ties).cast("long").alias("dr"),
        F.lag("o_orderkey").over(w).alias("before"), F.lead("o_orderkey").over(w).alias("after"), F.ntile(4).over(w).cast("long").alias("quarter_of"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).over(w.rowsBetween(-2, 0)).cast("double").alias("last_three"),
    )


@query("""
SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3""")
def p14_top_k_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three largest orders of each customer (a top-k report)."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top_k(orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3).withColumn("rank", F.col("rank").cast("long"))


@query("""
SELECT o_custkey, o_orderdate, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""")
def p15_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], "o_orderdate")


@query("""
(SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier) UNION ALL (SELECT n_nationkey FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def p16_set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, suppliers, nations = (read_table(spark, sf_dir, t).select(F.col(c).alias("k")) for t, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey")))
    rich = read_table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("k"))
    return customers.intersectAll(suppliers).unionAll(nations.subtract(rich))


_P17 = """
WITH RECURSIVE months(k, first) AS (SELECT 0, TIMESTAMP '1995-01-01' UNION ALL SELECT k + 1, first + INTERVAL '1' MONTH FROM months WHERE k < 79)
SELECT CAST(k AS BIGINT) AS k, count(o_orderkey) AS n FROM months LEFT JOIN orders ON o_orderdate >= first AND o_orderdate < first + INTERVAL '1' MONTH GROUP BY k"""


@query(_P17)
def p17_recursive_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month, with the months that have none: orders are counted by month first."""
    register_views(spark, sf_dir, ("orders",))
    return spark.sql("""
        WITH RECURSIVE months(k) AS (SELECT 0 UNION ALL SELECT k + 1 FROM months WHERE k < 79),
        counted AS (SELECT (year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS m, count(*) AS n FROM orders GROUP BY 1)
        SELECT CAST(k AS BIGINT) AS k, coalesce(n, 0) AS n FROM months LEFT JOIN counted ON k = m""")


@query("""
SELECT s_suppkey, s_acctbal, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE s_acctbal > (SELECT avg(s2.s_acctbal) FROM supplier s2 WHERE s2.s_nationkey = supplier.s_nationkey)""")
def p18_correlated_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(spark, sf_dir, ("supplier", "nation"))
    return spark.sql("""
        SELECT s_suppkey, s_acctbal, n_name FROM supplier s JOIN nation ON s_nationkey = n_nationkey
        WHERE s_acctbal > (SELECT avg(s2.s_acctbal) FROM supplier s2 WHERE s2.s_nationkey = s.s_nationkey)""")


@query("""
SELECT c_custkey, o_orderkey, o_totalprice FROM customer, LATERAL (SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 2)
WHERE c_mktsegment = 'MACHINERY'""")
def p19_lateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two largest orders of each customer of a segment (a top-k report)."""
    register_views(spark, sf_dir, ("customer", "orders"))
    return spark.sql("""
        SELECT c_custkey, o_orderkey, o_totalprice FROM customer, LATERAL (SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 2)
        WHERE c_mktsegment = 'MACHINERY'""")


@query("""
SELECT p_type, count(*) FILTER (p_brand = 'Brand#1') AS brand_1, count(*) FILTER (p_brand = 'Brand#2') AS brand_2, count(*) FILTER (p_brand = 'Brand#3') AS brand_3 FROM part GROUP BY p_type""")
def p20_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part").withColumn("b", F.replace(F.lower("p_brand"), F.lit("brand#"), F.lit("brand_")))
    return part.groupBy("p_type").pivot("b", ["brand_1", "brand_2", "brand_3"]).agg(F.count(F.lit(1))).na.fill(0)


@query("""
SELECT k, name, value FROM (SELECT l_linenumber AS k, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS tax FROM lineitem GROUP BY 1)
UNPIVOT (value FOR name IN (quantity, tax))""")
def p21_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    money = lambda c: F.col(c).cast("decimal(18,2)")
    sums = read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("k")).agg(total(money("l_quantity"), "quantity"), total(money("l_tax"), "tax"))
    return sums.unpivot("k", ["quantity", "tax"], "name", "value")


@query("""
SELECT a.*, b.parts, b.dearest FROM (SELECT l_suppkey, round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(quantile_cont(l_extendedprice, 0.9), 6) AS p90 FROM lineitem GROUP BY 1) a
JOIN (SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, arg_max(l_orderkey, (l_extendedprice, l_orderkey)) AS dearest FROM lineitem GROUP BY 1) b USING (l_suppkey)""")
def p22_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles by a sort of each group, which spills, beside the aggregates; of equal prices the greater order is the dearest."""
    lines = read_table(spark, sf_dir, "lineitem")
    cuts = group_percentiles(lines, ["l_suppkey"], "l_extendedprice", {"median": 0.5, "p90": 0.9})
    sums = lines.groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts"), F.max(F.struct("l_extendedprice", "l_orderkey")).alias("m"))
    return cuts.join(sums, "l_suppkey").select("l_suppkey", F.round("median", 6).alias("median"), F.round("p90", 6).alias("p90"), "parts", F.col("m.l_orderkey").alias("dearest"))


@query("""
SELECT label, count(*) AS n, round(avg(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))), 6) AS mean_norm, min(len(embedding)) AS width FROM embeddings GROUP BY label""")
def p23_array_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return vectors.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg(l2_norm(F.col("embedding"))), 6).alias("mean_norm"), F.min(F.size("embedding")).cast("long").alias("width"))


@query("""
SELECT o_orderstatus, round(CAST(count(*) FILTER (o_totalprice > 150000) AS DOUBLE) / count(*), 9) AS share FROM orders GROUP BY 1""")
def p24_conditional_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.round(share_of(F.count_if(F.col("o_totalprice") > 150000), F.count("*")), 9).alias("share"))


@query("""
SELECT r_name, s.seg AS segment, count(c_custkey) AS n FROM region CROSS JOIN (SELECT DISTINCT c_mktsegment AS seg FROM customer) s
LEFT JOIN (SELECT c_custkey, c_mktsegment, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey) c ON n_regionkey = r_regionkey AND c_mktsegment = s.seg GROUP BY ALL""")
def p25_cross_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of every region and segment, also where there is none: the cross join is of two
    lists of a handful of names, never of rows."""
    customer = read_table(spark, sf_dir, "customer").select("c_nationkey", F.col("c_mktsegment").alias("segment"))
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    counted = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_regionkey").alias("r_regionkey"), "segment").agg(F.count("*").alias("c"))
    every = read_table(spark, sf_dir, "region").crossJoin(customer.select("segment").distinct())
    return every.join(counted, ["r_regionkey", "segment"], "left").select("r_name", "segment", F.coalesce("c", F.lit(0)).alias("n"))


@query("""
SELECT c_custkey, n_nationkey FROM customer JOIN nation ON c_acctbal < n_nationkey * 400 - 400 AND n_nationkey * 400 - 1000 < c_acctbal + 150""")
def p26_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances with 150 above them against bands of 600 a nation: intervals that overlap."""
    left = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("low"), (F.col("c_acctbal") + 150).alias("high"))
    bands = read_table(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_nationkey") * 400.0 - 1000).alias("since"), (F.col("n_nationkey") * 400.0 - 400).alias("until"))
    return interval_join(left, bands, ("low", "high"), ("since", "until"), 500.0).select("c_custkey", "n_nationkey")


@query("""
SELECT p_brand, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <= 10 GROUP BY 1""")
def p27_sized_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts are broadcast only if their estimated size is under a bound."""
    parts = read_table(spark, sf_dir, "part").where("p_size <= 10").select(F.col("p_partkey").alias("k"), "p_brand")
    lines = read_table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), "l_quantity")
    return sized_join(lines, parts, ["k"]).groupBy("p_brand").agg(F.count("*").alias("n_lines"), total(F.col("l_quantity").cast("decimal(18,2)"), "quantity"))


@query("""
SELECT 'all' AS kind, k FROM (SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'either' AS kind, k FROM (SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def p28_set_operations_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXCEPT ALL keeps as many rows as one side has more; UNION drops repeated ones."""
    customers, suppliers = read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "supplier")
    more = customers.select(F.col("c_nationkey").alias("k")).exceptAll(suppliers.select("s_nationkey"))
    either = customers.where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")).union(suppliers.where("s_acctbal > 5000").select("s_nationkey")).distinct()
    return more.select(F.lit("all").alias("kind"), "k").unionByName(either.select(F.lit("either").alias("kind"), "k"))


@query("""
SELECT s_suppkey, round(percent_rank() OVER w, 9) AS pr, round(cume_dist() OVER w, 9) AS cd, nth_value(s_suppkey, 2) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second,
  count(*) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal RANGE BETWEEN 1000 PRECEDING AND 1000 FOLLOWING) AS near
FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_acctbal)""")
def p29_window_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relative ranks, the second row of a partition, and a frame by distance in value."""
    by = Window.partitionBy("s_nationkey")
    w, total_order = by.orderBy("s_acctbal"), by.orderBy("s_acctbal", "s_suppkey").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return read_table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.round(F.percent_rank().over(w), 9).alias("pr"), F.round(F.cume_dist().over(w), 9).alias("cd"), F.nth_value("s_suppkey", 2).over(total_order).alias("second"),
        F.count("*").over(w.rangeBetween(-1000, 1000)).alias("near"),
    )


@query("""
SELECT conv_id, count(*) FILTER (role = 'user') AS n_user, count(*) FILTER (role = 'assistant') AS n_assistant, CAST(count(DISTINCT role) AS BIGINT) AS n_roles,
  string_agg(DISTINCT role, ',' ORDER BY role) AS roles, CAST(max(length(text)) FILTER (role = 'user') AS BIGINT) AS longest
FROM conversations GROUP BY conv_id""")
def p40_map_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns by role as a map, made from one row a conversation and role."""
    by_role = read_table(spark, sf_dir, "conversations").groupBy("conv_id", "role").agg(F.count("*").alias("n"), F.max(F.length("text")).alias("m"))
    maps = by_role.groupBy("conv_id").agg(F.map_from_entries(F.collect_list(F.struct("role", F.struct("n", "m")))).alias("of"))  # a handful of roles each
    counts, longest = F.transform_values("of", lambda _, x: x["n"]), F.transform_values("of", lambda _, x: x["m"])
    return maps.select(
        "conv_id", *(F.coalesce(F.try_element_at(counts, F.lit(r)), F.lit(0)).alias(f"n_{r}") for r in ("user", "assistant")), F.size("of").cast("long").alias("n_roles"),
        F.array_join(F.array_sort(F.map_keys("of")), ",").alias("roles"), F.try_element_at(longest, F.lit("user")).cast("long").alias("longest"),
    )


@query("""
SELECT regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host, count(*) AS n, CAST(sum(length(html)) AS BIGINT) AS chars, count(*) FILTER (contains(lower(html), '<script')) AS with_script FROM pages GROUP BY 1""")
def p41_url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return pages.groupBy(F.coalesce(F.parse_url("url", F.lit("HOST")), F.lit("")).alias("host")).agg(F.count("*").alias("n"), F.sum(F.length("html")).alias("chars"), F.count_if(F.contains(F.lower("html"), F.lit("<script"))).alias("with_script"))


@query("""
SELECT length(text) - length(replace(text, ' ', '')) + 1 AS n_words, count(*) AS n, min(item_id) AS first, max(substr(text, 1, 12)) AS start FROM benchmark GROUP BY 1""")
def p42_string_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1).cast("long")
    return read_table(spark, sf_dir, "benchmark").groupBy(words.alias("n_words")).agg(F.count("*").alias("n"), F.min("item_id").alias("first"), F.max(F.substring("text", 1, 12)).alias("start"))


@query("""
SELECT query_id, vec_id, similarity, CAST(rank AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank FROM (
    SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 6) AS similarity
    FROM embeddings q JOIN embeddings v ON q.vec_id % 50 = 0 AND q.vec_id != v.vec_id)) WHERE rank <= 5""")
def p43_vector_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors by cosine of every vector whose id is divisible by 50 (a top-k
    report): every query meets all rows, in products of matrices."""
    near = cosine_top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, "vec_id", "embedding", 5, 6)
    return near.withColumn("rank", F.col("rank").cast("long"))


@query("""
SELECT s_nationkey, round(exp(avg(ln(greatest(s_acctbal, 1)))), 4) AS middle, max(length(regexp_replace(s_name, '[^0-9]', '', 'g'))) AS digits, count(*) AS n FROM supplier GROUP BY 1""")
def p44_udf_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered scalar and a registered aggregate function, both over Arrow batches, in SQL."""
    register_functions(spark)
    register_views(spark, sf_dir, ("supplier",))
    return spark.sql("""
        SELECT * FROM (SELECT s_nationkey, round(weft_geometric_mean(greatest(s_acctbal, 1.0D)), 4) AS middle FROM supplier GROUP BY s_nationkey)
        JOIN (SELECT s_nationkey, max(CAST(length(weft_digits(s_name)) AS BIGINT)) AS digits, count(*) AS n FROM supplier GROUP BY s_nationkey) USING (s_nationkey)""")


@query("""
SELECT conv_id, turn, word_no, word FROM (SELECT conv_id, turn, unnest(range(1, len(ws) + 1)) AS word_no, unnest(ws) AS word FROM (
  SELECT conv_id, turn, regexp_extract_all(text, '[A-Za-z]+') AS ws FROM conversations WHERE role = 'system'))""")
def p45_udf_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered table function, joined laterally in SQL."""
    register_functions(spark)
    register_views(spark, sf_dir, ("conversations",))
    return spark.sql("SELECT conv_id, turn, t.word_no, t.word FROM conversations, LATERAL weft_words(text) t WHERE role = 'system'")
