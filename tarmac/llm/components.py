"""Connected components by alternating large-star and small-star steps.

Each step is an aggregate (the smallest neighbour of a node, combined in every
task) and a join back, so a hub with a third of all links is never collected;
AQE splits its side of the join. Links are rewritten towards the smallest node
until nothing changes, which takes few rounds even for long chains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
    return (both.join(least, both["a"] == least["k"])
            .filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("m", "k").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    # edges point from the larger node a to a smaller node b
    least = edges.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
    joined = edges.join(least, edges["a"] == least["k"])
    moved = joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("k").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the links (a, b), a != b, that is not
    itself the smallest of its component; ``root`` is that smallest node."""
    links = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    mark = None
    while True:
        star = _small_star(_large_star(links).distinct()).distinct()
        links = written(star, name)
        # All links point at roots exactly when a further round leaves the
        # links as they are; compare order-free sums over all links.
        now = tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                              F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())
        if now == mark:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
