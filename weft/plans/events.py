"""Queries over the event table, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions import json_field
from weft.operators import as_of_join, sessionize
from weft.sources import read_table
from weft.streaming import RunningTotals, event_stream, first_per_key, hourly_counts, late_copies, run_available, stream_folder, within

EVENT_QUERIES: dict = {}


def query(sql: str | None):
    def register(f):
        EVENT_QUERIES[f.__name__] = (f, sql)
        return f

    return register


def plain_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


_HOURLY = """SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events GROUP BY ALL"""


@query(_HOURLY)
def p30_tumbling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return plain_time(hourly_counts(events), "hour").withColumn("value", F.col("value").cast("double"))


@query(_HOURLY)
def p31_stream_tumbling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream whose whole result table is written."""
    found = run_available(hourly_counts(event_stream(spark, sf_dir)), stream_folder(spark), "complete")
    return plain_time(found, "hour").withColumn("value", F.col("value").cast("double"))


@query("""
SELECT s AS start, count(*) AS n FROM events, LATERAL (SELECT unnest([date_trunc('hour', ts), date_trunc('hour', ts) + CASE WHEN minute(ts) >= 30 THEN INTERVAL 30 MINUTE ELSE INTERVAL '-30' MINUTE END]) AS s) GROUP BY s""")
def p32_sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of an hour, every half hour."""
    events = read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    found = events.groupBy(F.window("ts", "1 hour", "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    return plain_time(found.select(F.col("w.start").alias("start"), "n"), "start")


@query("""
WITH marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
numbered AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS session FROM marked)
SELECT user_id, session, min(ts) AS first, max(ts) AS last, count(*) AS n FROM numbered GROUP BY ALL""")
def p33_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sessionize(read_table(spark, sf_dir, "events"), ["user_id"], "ts", 6 * 3600)
    return events.groupBy("user_id", "session").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("n"))


@query("""
SELECT p.event_id, p.user_id, p.ts, v.ts AS view_ts, v.value AS view_value FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def p34_as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the user's last view at or before it."""
    events = read_table(spark, sf_dir, "events")
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return as_of_join(purchases, events.where("event_type = 'view'"), ["user_id"], "ts", ["value"], prefix="view_")


@query("""SELECT json_extract_string(props, '$.k') AS k, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY 1""")
def p35_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").groupBy(json_field("props", "k").alias("k")).agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"))


@query("""SELECT event_id, user_id, event_type FROM events""")
def p36_stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events are unique by id, so none is lost; a second copy of each is."""
    events = event_stream(spark, sf_dir)
    twice = events.unionByName(events)
    return run_available(first_per_key(twice, ["event_id"]).select("event_id", "user_id", "event_type"), stream_folder(spark))


@query("""SELECT user_id, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1""")
def p37_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals a user, kept in state; the last one of each user is their total."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        told = event_stream(spark, sf_dir).groupBy("user_id").transformWithStateInPandas(RunningTotals(), "user_id long, n long, value double", "append", "none")
        found = run_available(told, stream_folder(spark))
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return found.groupBy("user_id").agg(F.max("n").alias("n"), F.round(F.max_by("value", "n"), 4).alias("value"))


@query("""
SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY ALL""")
def p38_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that the watermark closes, each emitted once. The last batch brings copies of old
    events whose windows are closed and evicted by then: they come too late and change nothing."""
    folder = stream_folder(spark)
    events = late_copies(spark, sf_dir, folder)
    return plain_time(run_available(hourly_counts(events), folder), "hour").withColumn("value", F.col("value").cast("double"))


@query("""
SELECT p.event_id AS purchase, v.event_id AS view FROM events p JOIN events v ON p.user_id = v.user_id AND v.ts >= p.ts - INTERVAL 1 HOUR AND v.ts <= p.ts
WHERE p.event_type = 'purchase' AND v.event_type = 'view'""")
def p39_stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with the user's views in the hour before: two streams, whose watermarks and the
    bound on the distance in time let Spark drop old state."""
    events = event_stream(spark, sf_dir)
    side = lambda kind, name: events.where(F.col("event_type") == kind).select(F.col("event_id").alias(name), F.col("user_id").alias(f"{name}_user"), F.col("ts").alias(f"{name}_ts"))
    joined = within(side("purchase", "purchase"), side("view", "view"), "purchase_user", "view_user", "purchase_ts", "view_ts", "1 hour")
    return run_available(joined.select("purchase", "view"), stream_folder(spark))
