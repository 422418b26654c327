"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import forget, joined, written

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """node, component (its least reachable node) for each node of ``links`` (a, b long).

    What a join adds one row a node of is written first, so Spark may split the other side
    where a node has very many links.

    Large-star and small-star rounds (Kiveris et al., 2014): each round points nodes at the
    least neighbour known, so long chains shrink by a factor a round. Every round is written
    to the shared folder; only its number of rows and a checksum reach the driver. Nodes of
    many links are met by joins with one row a node, never gathered.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "links")
    before = None
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
        done = [edges, least]
        large = joined(both, least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        large = written(large.distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        done.append(large)
        starred = joined(large, least, "u")
        small = starred.select("u", F.col("m").alias("v")).unionByName(starred.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = written(small.distinct(), "links")
        forget(*done)
        told = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (told.n, told.x) == before:
            break
        before = (told.n, told.x)
    else:
        raise RuntimeError(f"components are not settled after {MOST_ROUNDS} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    found = written(stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components")
    forget(edges)
    return found
