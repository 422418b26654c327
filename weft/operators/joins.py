"""Joins by nearness, by range and on skewed keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fresh_name(name: str, *frames: DataFrame) -> str:
    """``name`` with as many underscores before it as make it no column of the frames."""
    known = {c.lower() for df in frames for c in df.columns}
    while name.lower() in known:
        name = "_" + name
    return name


def as_of_join(left: DataFrame, right: DataFrame, by: list[str], time: str, values: list[str], prefix: str = "r_") -> DataFrame:
    """Each row of ``left`` with the ``values`` of the latest row of ``right`` at or before its time.

    Both sides are united and one window carries the last right row forward: one shuffle
    on ``by``, no pairs. Right rows that tie in time are told apart by their values, the
    greatest wins. Null times on the right match nothing; left rows without a match, and
    those with a null time, get nulls.
    """
    t, mine, theirs, last = (fresh_name(x, left, right) for x in ("t", "mine", "theirs", "last"))
    packed = F.struct(F.col(time).alias("t"), *(F.col(v).alias(f"v{k}") for k, v in enumerate(values)))
    cols = left.columns
    one = left.select(F.struct(*cols).alias(mine), *by, F.col(time).alias(t), F.lit(None).cast(right.select(packed.alias("p")).schema["p"].dataType).alias(theirs))
    two = right.where(F.col(time).isNotNull()).select(F.lit(None).cast(one.schema[mine].dataType).alias(mine), *by, F.col(time).alias(t), packed.alias(theirs))
    order = [F.col(t).asc_nulls_first(), F.col(mine).isNotNull().cast("int"), F.col(theirs)]
    seen = F.last(theirs, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    filled = one.unionByName(two).withColumn(last, seen).where(F.col(mine).isNotNull())
    return filled.select(*(F.col(mine)[c].alias(c) for c in cols), F.col(last)["t"].alias(prefix + time), *(F.col(last)[f"v{k}"].alias(prefix + v) for k, v in enumerate(values)))


def range_join(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: float) -> DataFrame:
    """Pairs with low <= point < high, as an equi-join on cells of ``width``.

    A range is listed once for each cell that it meets, so ``width`` should be near the
    usual length of a range: much smaller lists ranges often, much larger pairs many points
    with ranges that don't hold them. Column names of the two sides must differ.
    """
    name = fresh_name("cell", points, ranges)
    cell = lambda c: F.floor(F.col(c) / width)
    listed = ranges.where(F.col(low) < F.col(high)).withColumn(name, F.explode(F.sequence(cell(low), cell(high))))
    return points.withColumn(name, cell(point)).join(listed, name).where((F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))).drop(name)


def salted_join(left: DataFrame, right: DataFrame, on: list[str], salts: int = 16, how: str = "inner") -> DataFrame:
    """A join whose left side has hot keys: they are spread over ``salts`` tasks and the right
    side, which should have few rows a key, is repeated as often. ``how``: inner, left,
    left_semi or left_anti."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("rows of the right side are repeated, so only its matches may be kept")
    name = fresh_name("salt", left, right)
    salt = F.pmod(F.xxhash64(*left.columns), F.lit(salts))
    repeated = right.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return left.withColumn(name, salt).join(repeated, [*on, name], how).drop(name)


def interval_join(left: DataFrame, right: DataFrame, left_ends: tuple[str, str], right_ends: tuple[str, str], width: float) -> DataFrame:
    """Pairs of intervals [low, high) that overlap, as an equi-join on cells of ``width``.

    Each interval is listed once for each cell that it meets; a pair that meets in several cells
    is taken from the one where the later of the two begins, so no distinct is needed. Empty
    intervals and those with a null end overlap nothing. Column names of the two sides must
    differ. ``width`` should be near the usual length of an interval.
    """
    cell = fresh_name("cell", left, right)

    def listed(df: DataFrame, low: str, high: str) -> DataFrame:
        last = F.greatest(F.ceil(F.col(high) / width) - 1, F.floor(F.col(low) / width))
        return df.where(F.col(low) < F.col(high)).withColumn(cell, F.explode(F.sequence(F.floor(F.col(low) / width), last)))

    (a, b), (c, d) = left_ends, right_ends
    met = listed(left, a, b).join(listed(right, c, d), cell)
    return met.where((F.col(a) < F.col(d)) & (F.col(c) < F.col(b)) & (F.col(cell) == F.floor(F.greatest(a, c) / width))).drop(cell)


def sized_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", most_bytes: int = 64 << 20) -> DataFrame:
    """A join that broadcasts ``right`` where the optimizer's estimate of its size is at most
    ``most_bytes``, and else leaves the choice to Spark. The estimate comes from file sizes and
    statistics, so nothing is run to learn it; adaptive execution may still change the join."""
    size = right._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return left.join(F.broadcast(right) if int(str(size)) <= most_bytes else right, on, how)
