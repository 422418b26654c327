"""Functions in Python for SQL: scalar and aggregate ones over Arrow batches, and a table function.

They are for what built-in expressions can't say; ``FUNCTIONS`` lists them by name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf, udtf
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from weft import share_code


@pandas_udf(StringType())
def digits(values: pd.Series) -> pd.Series:
    """The ASCII digits of each string; null stays null."""
    return values.str.replace(r"[^0-9]", "", regex=True)


@pandas_udf(DoubleType())
def geometric_mean(values: pd.Series) -> float:
    """Of the values that aren't null; null if there is none, or one isn't positive."""
    known = values.dropna()
    return float(np.exp(np.log(known).mean())) if len(known) and (known > 0).all() else None


@udtf(returnType=StructType().add("word_no", LongType()).add("word", StringType()))
class Words:
    """One row a run of ASCII letters, numbered from 1; none for null."""

    def eval(self, text: str) -> Iterator[tuple[int, str]]:
        yield from enumerate(re.findall("[A-Za-z]+", text or ""), 1)


FUNCTIONS = {"weft_digits": digits, "weft_geometric_mean": geometric_mean}
TABLE_FUNCTIONS = {"weft_words": Words}


def register_functions(spark: SparkSession) -> None:
    """Registers all of them in the session, under their names."""
    share_code(spark)
    for name, f in FUNCTIONS.items():
        spark.udf.register(name, f)
    for name, f in TABLE_FUNCTIONS.items():
        spark.udtf.register(name, f)
