"""Tables in and out.

A table is a folder or file ``<dir>/<name>.<format>`` in any store that Spark reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
FORMATS = ("parquet", "orc", "json", "csv")


def read_table(spark: SparkSession, folder: str, name: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """A table, read lazily: filters and columns chosen later reach the scan.

    JSON and CSV don't carry their types, so they need a schema; none is guessed from rows.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; one of {', '.join(FORMATS)}")
    if fmt in ("json", "csv") and schema is None:
        raise ValueError(f"{fmt} needs a schema")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.options(header=True, escape='"', multiLine=True)
    return reader.load(f"{folder}/{name}.{fmt}")


def write_table(df: DataFrame, folder: str, name: str, fmt: str = "parquet", partition_by: list[str] | None = None, mode: str = "errorifexists") -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; one of {', '.join(FORMATS)}")
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.options(header=True, escape='"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{folder}/{name}.{fmt}")


def write_bucketed(df: DataFrame, table: str, buckets: int, *keys: str) -> None:
    """A managed table bucketed and sorted by ``keys``: joins and aggregates on them need no
    shuffle between tables of as many buckets."""
    df.write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").saveAsTable(table)


def register_views(spark: SparkSession, folder: str, names: tuple[str, ...] = TABLES) -> None:
    """Temporary views for ``spark.sql``."""
    for name in names:
        read_table(spark, folder, name).createOrReplaceTempView(name)
