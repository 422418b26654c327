"""Column functions over built-in expressions; none runs Python on rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def revenue(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    """Price after discount, exact: decimals don't depend on the order of a sum."""
    return F.col(price).cast("decimal(18,2)") * (F.lit(1).cast("decimal(4,2)") - F.col(discount).cast("decimal(4,2)"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def l2_norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def share_of(part: Column, whole: Column) -> Column:
    """part / whole as double, null where whole is 0 or null."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def json_field(column: str, path: str) -> Column:
    return F.get_json_object(F.col(column), f"$.{path}")
