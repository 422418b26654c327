"""Runs of events with no long gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.operators.joins import fresh_name


def sessionize(df: DataFrame, by: list[str], time: str, gap_seconds: int, name: str = "session") -> DataFrame:
    """Numbers each key's sessions from 1; a new one begins after a gap over ``gap_seconds``."""
    w = Window.partitionBy(*by).orderBy(time)
    seconds = F.unix_micros(F.col(time).cast("timestamp"))
    new = fresh_name("fresh", df)
    fresh = F.coalesce((seconds - F.lag(seconds).over(w) > gap_seconds * 1_000_000).cast("int"), F.lit(1))
    return df.withColumn(new, fresh).withColumn(name, F.sum(new).over(w.rangeBetween(Window.unboundedPreceding, 0))).drop(new)
