"""Connected components of a large graph by alternating stars, in a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.llm.common import store


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of ``edges`` (two long columns); the root is the least node.

    Each round links every larger neighbour of a node to the least of its neighbours, then
    every smaller one; the graph becomes stars in about log(nodes) rounds. Edges are stored
    after each round, none reach the driver. Loops and repeated edges change nothing.
    """
    pairs = edges.select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).filter("x <> y").distinct()
    pairs = store(pairs, "edges")
    before = None
    while (now := pairs.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()) != before:
        before = now
        both = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").filter("y > x AND y <> m").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(least, "x")
        pairs = store(
            small.filter("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
            .unionByName(least.select("x", F.col("m").alias("y")))
            .distinct(),
            "edges",
        )
    return pairs.select(F.col("x").alias("node"), F.col("y").alias("root")).unionByName(
        pairs.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct()
    )
