"""Connected components of links between nodes, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import written


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and its ``root``, the least node it is linked with through any chain, for links (a, b) of long nodes.

    Nodes that are a root aren't listed. Each round points every node at the least node around it, first from larger
    neighbours, then to smaller ones, until nothing changes; a round is two aggregations with partial sums and two
    joins, so a node with very many links needs no task of its own. Links of a node to itself and null nodes don't count.
    """
    now = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links"
    )
    before = None
    for _ in range(rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(
            moved.union(small.select("a", F.col("m").alias("b"))).where("a > b").distinct(), "links"
        )
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
    raise RuntimeError("links didn't settle")
