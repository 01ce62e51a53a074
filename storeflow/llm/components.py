"""Connected components by alternating large and small stars; only counts come to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeflow.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for edges (a, b); the component is its smallest node.

    Each step hangs every node under the smallest neighbour it knows, so that hubs never gather: a node's neighbours
    are only reduced to their minimum, in partial aggregates.  The number of steps grows with the
    logarithm of a component's diameter.
    """
    now = stored(
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "stars",
    )
    size = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    while size[0]:
        # Large star: neighbours above a node go to the least of its neighbourhood.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        # Small star: a node and its lower neighbours go to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        now = stored(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "stars")
        before, size = size, now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if size == before:
            break
    tops = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)
