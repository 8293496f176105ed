"""Recovery and restart decisions over status rows (R13 - R17), for all processors at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forktide.functions import blocks, clock, text
from forktide.operators.versions import latest_by_key

STATUS_SCHEMA = (
    "id string, height bigint, hash string, parent_hash string, hot_blocks string, "
    "finalized_height bigint, finalized_hash string, timestamp timestamp, last_run bigint"
)


def recover_state(status: DataFrame, processors: DataFrame | None = None) -> DataFrame:
    """Newest status per processor: the finalized pair is the base, hot blocks lie on top.

    A row without a finalized pair falls back to its tip pair. Processors without a status start at
    genesis: height -1, empty hash, no blocks.
    """
    newest = latest_by_key(status, ["id"], ["timestamp", "height"])
    state = newest.select(
        "id",
        text.first_nonzero(F.col("finalized_height"), F.col("height")).alias("height"),
        F.coalesce(
            text.first_nonempty(F.col("finalized_hash"), F.col("hash")), F.lit("")
        ).alias("hash"),
        blocks.parse_blocks(F.col("hot_blocks")).alias("top"),
        text.first_nonzero(F.col("finalized_height"), F.col("height")).alias("finalized_height"),
        F.nullif(F.col("last_run"), F.lit(0)).alias("last_run"),
    )
    if processors is None:
        return state
    known = processors.select("id").join(state, "id", "left")
    return known.select(
        "id",
        F.coalesce("height", F.lit(-1)).alias("height"),
        F.coalesce("hash", F.lit("")).alias("hash"),
        F.coalesce("top", F.array().cast(blocks.BLOCK_LIST)).alias("top"),
        "finalized_height",
        "last_run",
    )


def stale_decision(
    state: DataFrame,
    now_ms: Column,
    threshold_ms: int | None = 600_000,
    trust_quick_restart: bool = True,
) -> DataFrame:
    """Adds downtime, ``action`` (keep / clear) and ``reason`` to recovered states.

    ``threshold_ms=None`` stands for infinity (never clear on downtime); 0 always clears.
    """
    downtime = now_ms - F.col("last_run")
    quick = F.lit(True) if threshold_ms is None else downtime < F.lit(threshold_ms)
    reason = (
        F.when(F.size("top") == 0, "no hot blocks")
        .when(F.lit(not trust_quick_restart), "restart not trusted")
        .when(F.col("last_run").isNull(), "no last run")
        .when(quick, "quick restart")
        .otherwise("long downtime")
    )
    return (
        state.withColumn("downtime_ms", downtime)
        .withColumn("downtime_min", clock.whole_minutes(downtime))
        .withColumn("reason", reason)
        .withColumn(
            "action",
            F.when(F.col("reason").isin("no hot blocks", "quick restart"), "keep").otherwise("clear"),
        )
    )


def rolled_back_state(decided: DataFrame, cold_status: DataFrame | None = None) -> DataFrame:
    """State to resume from after the decision.

    A cleared processor has no hot blocks left. With ``cold_status`` (id, height, hash) it resumes
    at what cold holds, so nothing between that and finality is lost; without, height and hash stay.
    """
    cleared = F.col("action") == "clear"
    empty = F.array().cast(blocks.BLOCK_LIST)
    if cold_status is None:
        cold_height, cold_hash, joined = F.col("height"), F.col("hash"), decided
    else:
        cold = cold_status.select(
            "id", F.col("height").alias("cold_height"), F.col("hash").alias("cold_hash")
        )
        joined = decided.join(cold, "id", "left")
        cold_height = F.coalesce("cold_height", F.lit(-1))
        cold_hash = F.coalesce("cold_hash", F.lit(""))
    return joined.select(
        "id",
        F.when(cleared, cold_height).otherwise(F.col("height")).alias("height"),
        F.when(cleared, cold_hash).otherwise(F.col("hash")).alias("hash"),
        F.when(cleared, empty).otherwise(F.col("top")).alias("top"),
        text.first_nonzero(F.col("finalized_height"), F.col("height")).alias("finalized_height"),
        "action",
        "reason",
    )
