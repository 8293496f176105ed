"""Connected components of an edge list, by alternating large-star and small-star rounds.

Every node ends up beside the smallest node of its component. Each round is a few shuffles of the
edges and is written to the shared folder; the number of rounds grows with the logarithm of the
number of nodes. Only a checksum of a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forktide.llm.common import stored

MOST_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links every node's neighbours to the smallest one among them and the node.

    ``edges`` has ``a > b``. The large star looks at all neighbours and moves the larger ones, the
    small star moves the smaller ones and the node itself.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        moved = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        near = edges.join(least, "a")
        moved = near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.filter("a > b").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` for every node with an edge; the root is the component's smallest node."""
    spark = edges.sparkSession
    pairs = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a > b").distinct()
    pairs = stored(spark, pairs, "edges")
    before = None
    for _ in range(MOST_ROUNDS):
        pairs = stored(spark, _star(_star(pairs, large=True), large=False), "edges")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
        before = now
    raise RuntimeError("components did not settle")
