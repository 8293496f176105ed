"""Hash of a block by height, from whichever place knows it first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed order in which places are asked.
PLACES = ("hot_chain", "registry", "cold", "hot")


def hash_by_height(
    hot_chain: DataFrame, registry: DataFrame, cold: DataFrame, hot: DataFrame
) -> DataFrame:
    """``(height, hash, place)`` for every known height.

    Each input has height and hash, several rows per height allowed. One aggregate by height: the
    lowest place wins, and within it the smallest hash, so the answer does not depend on row order.
    """
    tagged = None
    for rank, source in enumerate((hot_chain, registry, cold, hot)):
        part = source.select("height", "hash", F.lit(rank).alias("rank")).filter(
            F.coalesce(F.col("hash"), F.lit("")) != ""
        )
        tagged = part if tagged is None else tagged.unionByName(part)
    best = tagged.groupBy("height").agg(F.min(F.struct("rank", "hash")).alias("b"))
    place = F.element_at(F.array(*[F.lit(p) for p in PLACES]), F.col("b.rank") + 1)
    return best.select("height", F.col("b.hash").alias("hash"), place.alias("place"))


def latest_height(tables: Sequence[DataFrame], height: str = "height") -> DataFrame:
    """Highest height over several tables, -1 when all are empty (A2)."""
    tops = None
    for t in tables:
        part = t.agg(F.max(height).alias("top"))
        tops = part if tops is None else tops.unionByName(part)
    return tops.agg(F.coalesce(F.max("top"), F.lit(-1)).cast("bigint").alias("max_height"))
