"""Connected components of a graph of links, by large-star and small-star rounds on a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.sources.workdir import stored


def _least(links: DataFrame, own: str, other: str) -> DataFrame:
    """Per node ``own`` the smallest node among it and its ``other`` ends."""
    return links.groupBy(F.col(own).alias("node")).agg(F.min(other).alias("low")).select("node", F.least("node", "low").alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _least(both, "a", "b")
    larger = both.where("b > a")
    return larger.join(low, larger.a == low.node).select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links every node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = _least(down, "a", "b")
    to_low = down.join(low, down.a == low.node).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return to_low.unionByName(low.select(F.col("node").alias("a"), F.col("low").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``node, component`` (its smallest node) of every node in ``links(a, b)``.

    Nodes are compared as they are, ``a = b`` is allowed. Each round is stored, so no plan grows, and skewed joins are split by
    adaptive execution: a node's links never have to meet in one task. Rounds grow with the logarithm of the longest path.
    """
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    current = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        following = stored(_small_star(_large_star(current)), "links")
        mark = following.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        current = following
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"links did not settle within {max_rounds} rounds")
    return nodes.join(current.select(F.col("a").alias("node"), F.col("b").alias("low")), "node", "left").select("node", F.coalesce("low", "node").alias("component"))
