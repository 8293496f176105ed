"""Which block is canonical: forks, ancestors and the valid-block registry.

A registry is a DataFrame ``(processor_id, height, hash[, ...])`` with one row per height.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forktide.operators import ranges
from forktide.operators.versions import latest_by_key

PROCESSOR = "processor_id"


def canonical_chain(
    deliveries: DataFrame,
    keys: Sequence[str] = (PROCESSOR,),
    height: str = "height",
    hash: str = "hash",
    seq: str = "seq",
    width: int = ranges.WIDTH,
) -> DataFrame:
    """Blocks that survive a feed with forks.

    A delivery is orphaned by any later one at its height or below. So per height only the last
    delivery can survive, and it does when no lower height was delivered after it: one aggregate by
    height, then a running maximum of ``seq`` over heights. After the aggregate a key has one row
    per height, which bounds every window however the deliveries are distributed.
    """
    keys = list(keys)
    last = deliveries.groupBy(*keys, height).agg(
        F.max_by(hash, seq).alias(hash), F.max(seq).alias(seq)
    )
    below = ranges.running_max_before(last, keys, height, seq, "_below", width)
    survives = F.col("_below").isNull() | (F.col(seq) > F.col("_below"))
    return below.filter(survives).select(*keys, height, hash, seq)


def chain_tail(chain: DataFrame, depth: int, keys: Sequence[str] = (PROCESSOR,)) -> DataFrame:
    """The last ``depth`` blocks of each chain (W2); Spark limits each group before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.col("height").desc())
    return chain.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= depth).drop("_rn")


def mark_forks(
    steps: DataFrame,
    keys: Sequence[str] = (PROCESSOR,),
    seq: str = "seq",
    height: str = "height",
    width: int = ranges.WIDTH,
) -> DataFrame:
    """Adds ``tip`` (height delivered just before) and ``is_fork`` to each delivery.

    A delivery at or below the tip is a fork signal, never late data to drop; the first delivery of
    a feed has no tip and is none.
    """
    with_tip = ranges.previous_value(steps, keys, seq, height, "tip", width)
    return with_tip.withColumn("is_fork", F.coalesce(F.col(height) <= F.col("tip"), F.lit(False)))


def fork_detected(tip: int | None, first_new: int | None) -> bool:
    """The same test for one batch: False when either side is empty."""
    return tip is not None and first_new is not None and first_new <= tip


def common_ancestor(
    new_blocks: DataFrame,
    chain: DataFrame,
    step: Sequence[str],
    finalized: Column,
    base_height: Column | None = None,
) -> DataFrame:
    """Height to roll back to, per replacing step.

    ``new_blocks`` has the step columns, height, hash and whatever ``finalized`` and ``base_height``
    refer to (constant within a step). Without ``base_height`` the ancestor is the highest new block
    whose hash is already on the chain, at least the finalized height. With it, blocks below the
    fork stay valid: the ancestor is the base block of the step, or the height below its first block
    where the base is NULL. The join is on hash, which is unique.
    """
    step = list(step)
    if base_height is not None:
        below_first = F.min("height") - 1
        return new_blocks.groupBy(*step).agg(
            F.greatest(F.coalesce(F.max(base_height), below_first), F.max(finalized)).alias(
                "ancestor"
            )
        )
    known = chain.select("hash", F.lit(True).alias("_known"))
    return (
        new_blocks.join(known, "hash", "left")
        .groupBy(*step)
        .agg(
            F.greatest(
                F.max(F.when(F.col("_known"), F.col("height"))), F.max(finalized)
            ).alias("ancestor")
        )
    )


def rolled_back(chain: DataFrame, ancestors: DataFrame, step: Sequence[str]) -> DataFrame:
    """Number of chain blocks above the ancestor, per replacing step."""
    return (
        chain.join(ancestors, list(step))
        .groupBy(*step)
        .agg(F.count_if(F.col("height") > F.col("ancestor")).alias("rolled_back_blocks"))
    )


def register(registry: DataFrame, blocks: DataFrame, write_order: str = "seq") -> DataFrame:
    """Add blocks; the newest write at a height wins."""
    both = registry.unionByName(blocks.select(*registry.columns))
    return latest_by_key(both, [PROCESSOR, "height"], [write_order])


def unregistered(blocks: DataFrame, registry: DataFrame) -> DataFrame:
    """Blocks not yet registered with this hash."""
    return blocks.join(
        registry.select(PROCESSOR, "height", "hash"), [PROCESSOR, "height", "hash"], "left_anti"
    )


def after_fork(registry: DataFrame, fork_height: Column, new_blocks: DataFrame) -> DataFrame:
    """Registry once entries at or above the fork are replaced by the new blocks."""
    kept = registry.filter(F.col("height") < fork_height)
    return kept.unionByName(new_blocks.select(*registry.columns))


def prune_below(registry: DataFrame, lowest: Column) -> DataFrame:
    """Keep heights from ``lowest`` on (R7): ``tip - depth``, or the committed cutoff."""
    return registry.filter(F.col("height") >= lowest)


def bounds(registry: DataFrame, processors: DataFrame | None = None) -> DataFrame:
    """Highest, lowest and number of registered heights per processor, -1 / -1 / 0 if none (A3)."""
    found = registry.groupBy(PROCESSOR).agg(
        F.max("height").alias("highest"),
        F.min("height").alias("lowest"),
        F.count(F.lit(1)).alias("n_blocks"),
    )
    if processors is not None:
        found = processors.select(PROCESSOR).join(found, PROCESSOR, "left")
    return found.select(
        PROCESSOR,
        F.coalesce("highest", F.lit(-1)).cast("bigint").alias("highest"),
        F.coalesce("lowest", F.lit(-1)).cast("bigint").alias("lowest"),
        F.coalesce("n_blocks", F.lit(0)).cast("bigint").alias("n_blocks"),
    )


def advance_finality(chain: DataFrame, old: Column, new: Column) -> DataFrame:
    """Finality only moves up; finalized blocks leave the hot chain."""
    finalized = F.greatest(old, new)
    return chain.filter(F.col("height") > finalized)
