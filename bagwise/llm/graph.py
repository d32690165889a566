"""Connected components by alternating large and small stars.

Each round is two aggregations and two joins over the remaining edges; the
number of rounds grows with the logarithm of a component's size. Edges stay on
the executors; only a count and a checksum come back after a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagwise.llm.common import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), u > v, distinct; the next ones."""
    if large:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        out = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        low = edges.groupBy("u").agg(F.min("v").alias("low"))
        out = (edges.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
               .unionAll(low.select("u", F.col("low").alias("v"))))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of each node that has a link; a component's id is its smallest node."""
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .filter(F.col("u") != F.col("v")).distinct(), "edges")
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
        edges = written(_stars(_stars(edges, True), False), "edges")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
