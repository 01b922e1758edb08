"""Connected components of a graph whose links are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm._shared import stash


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 64) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has a link.

    Alternating large-star and small-star rounds: every link is turned towards the smallest node its ends
    know of, so paths halve each round and a large group turns into a star without being gathered. Links
    are written after each round, so nothing is recomputed when executors are lost.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = stash(edges, "links")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    seen = None
    for _ in range(most_rounds):
        # Large star: every larger neighbour of a node is linked to the node's smallest neighbour.
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).select(F.col("u").alias("n"), "m")
        least = stash(least, "least")
        large = both.join(least, F.col("u") == F.col("n")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        large = stash(large, "links")
        low = stash(large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m"), "least")
        small = large.join(low, F.col("u") == F.col("n"))
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("n").alias("u"), F.col("m").alias("v")))
        edges = stash(small.where("u <> v").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components have not settled in {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
