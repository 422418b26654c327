"""Structured Streaming over the event table.

``run_available`` drives a stream over what is there now and returns its result as a table
in a folder that the caller names (on a cluster a shared one).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weft import share_code
from weft.sources import read_table


def stream_folder(spark: SparkSession) -> str:
    """Where streams keep state and results: the folder that executors share. Where none is named
    (tests, one machine) a temporary one is made; on a cluster that is refused."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"file://{tempfile.mkdtemp(prefix='weft-stream-')}"


def event_stream(spark: SparkSession, folder: str, late: str = "1 hour") -> DataFrame:
    """The events as a stream with a watermark; ``ts`` as timestamp, which watermarks need.

    The path is given as a pattern, so the table may be a folder or one file.
    """
    schema = read_table(spark, folder, "events").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/[e]vents.parquet").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def run_available(result: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Runs the stream until its present input is used up. In ``complete`` mode each batch
    replaces the table, in ``append`` mode it is added."""
    spark = result.sparkSession
    share_code(spark)
    base = f"{folder}/weft-stream-{uuid.uuid4().hex}"
    if mode == "append":
        writer = result.writeStream.format("parquet").option("path", f"{base}/table")
    else:
        writer = result.writeStream.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{base}/table"))
    query = writer.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{base}/table")


def hourly_counts(events: DataFrame) -> DataFrame:
    """Events and their value by hour and type; batch and stream alike."""
    grouped = events.groupBy(F.window("ts", "1 hour").alias("w"), "event_type")
    return grouped.agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("value")).select(F.col("w.start").alias("hour"), "event_type", "n", "value")


def first_per_key(events: DataFrame, keys: list[str]) -> DataFrame:
    """Drops later rows of equal keys while the watermark still knows them."""
    return events.dropDuplicatesWithinWatermark(keys)


def late_copies(spark: SparkSession, folder: str, scratch: str, late: str = "1 hour") -> DataFrame:
    """The events as a stream of three batches: those up to a day before the last, the rest, and
    copies of those over three days older than the last. A batch's rows are late by the
    watermark that the batch before it ran with, so it takes the second for the third to be late.
    The batches are written to ``scratch`` first, one file each."""
    events, base = read_table(spark, folder, "events"), f"{scratch}/weft-late-{uuid.uuid4().hex}"
    last = events.agg(F.max("ts").alias("last"))  # one row
    dated = events.join(last)
    day, three = F.col("last") - F.expr("INTERVAL 1 DAY"), F.col("last") - F.expr("INTERVAL 3 DAYS")
    for batch in (dated.where(F.col("ts") <= day), dated.where(F.col("ts") > day), dated.where(F.col("ts") < three)):
        batch.drop("last").coalesce(1).write.mode("append").parquet(f"{base}/in")  # a file is a batch; the older file comes first
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def within(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str, right_time: str, span: str) -> DataFrame:
    """Inner join of two streams on a key, where the right time is at most ``span`` before the left."""
    near = (F.col(right_time) >= F.col(left_time) - F.expr(f"INTERVAL {span}")) & (F.col(right_time) <= F.col(left_time))
    return left.join(right, (F.col(left_key) == F.col(right_key)) & near)


class RunningTotals(StatefulProcessor):
    """Emits each user's number of events and total value so far, once a batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "n long, value double")

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        n, value = self.totals.get() or (0, 0.0)
        for pdf in rows:
            n += len(pdf)
            value += float(pdf["value"].sum())
        self.totals.update((n, value))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "value": [value]})

    def close(self) -> None:
        pass
