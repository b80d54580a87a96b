"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asset_catalog.llm.common import checkpointed


def _stars(edges: DataFrame) -> DataFrame:
    """One round of large and small stars over (high, low) edges."""
    both = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
        edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
    )
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("least", "node").alias("least"))
    large = (
        both.where(F.col("other") > F.col("node"))
        .join(least, "node")
        .select(F.col("other").alias("high"), F.col("least").alias("low"))
        .where("high != low")
        .distinct()
    )
    lowest = large.groupBy("high").agg(F.min("low").alias("least"))
    small = (
        large.join(lowest, "high")
        .where(F.col("low") != F.col("least"))
        .select(F.col("low").alias("high"), F.col("least").alias("low"))
        .unionByName(lowest.select("high", F.col("least").alias("low")))
    )
    return small.where("high != low").distinct()


def connected_components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of the pairs that is not the smallest of its component.

    Alternates large and small stars until the edges stay the same: then each component is a star
    around its smallest node. Each round is checkpointed, and only counts reach the driver. Null
    ends and loops are ignored."""
    edges = pairs.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
    edges = checkpointed(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("high != low").distinct())

    def state(rows: DataFrame) -> tuple:
        # Nodes may be any 64-bit numbers, so their sums need more.
        high, low = (F.sum(F.col(end).cast("decimal(20,0)")).cast("string") for end in ("high", "low"))
        return tuple(rows.agg(F.count("*"), high, low).first())

    seen = state(edges)
    while seen[0]:
        edges = checkpointed(_stars(edges))
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
