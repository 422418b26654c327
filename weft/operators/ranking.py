"""The first rows of each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.operators.joins import fresh_name


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group; ``order`` should be total. Spark limits each group
    before the shuffle as well (window group limit)."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= k)


def latest_per_key(df: DataFrame, by: list[str], time: str) -> DataFrame:
    """One row a key, that of the greatest time, then of the greatest remaining columns; it is
    an aggregate, combined before the shuffle, not a window."""
    rest = [c for c in df.columns if c not in (*by, time)]
    m = fresh_name("m", df)
    return df.groupBy(*by).agg(F.max(F.struct(time, *rest)).alias(m)).select(*by, f"{m}.*").select(*df.columns)


def group_percentiles(df: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Exact percentiles (linear interpolation) of ``value`` in each group: ``by`` and a column a share.

    Each group is sorted, which spills, instead of being held as a whole; null values don't count.
    """
    at, n = fresh_name("at", df), fresh_name("n", df)
    w = Window.partitionBy(*by)
    placed = df.where(F.col(value).isNotNull()).select(*by, value, F.row_number().over(w.orderBy(value)).alias(at)).withColumn(n, F.count("*").over(w))

    def percentile(share: float) -> Column:
        place = (F.col(n) - 1) * F.lit(share) + 1
        part = place - F.floor(place)
        return F.sum(F.when(F.col(at) == F.floor(place), F.col(value) * (1 - part)).when(F.col(at) == F.floor(place) + 1, F.col(value) * part))

    return placed.groupBy(*by).agg(*(percentile(share).alias(name) for name, share in shares.items()))
