"""Moving settled rows from hot to cold, as DataFrames.

The stored form with its commit point is ``forktide.streaming.store``; here is what it computes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forktide.operators.joins import keyed_join
from forktide.operators.versions import latest_by_key
from forktide.operators.visible import registered_rows


@dataclass(frozen=True)
class MigrationContext:
    """Given to the before-hook."""

    current_height: int
    finalized_height: int
    hot_table_rows: int
    blocks_since_last_migration: int
    is_at_chain_tip: bool


@dataclass(frozen=True)
class TransformContext:
    """Given to the row transform."""

    spark: Any
    table: str
    hot_table: str
    cold_table: str
    cutoff_height: int
    network: str


@dataclass(frozen=True)
class TableMove:
    name: str
    rows_in: int
    rows_out: int


@dataclass(frozen=True)
class MigrationResult:
    migrated: int
    cutoff_height: int
    duration_ms: int
    tables: tuple[TableMove, ...] = ()
    failed: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class MigrationHooks:
    """``transform_rows`` maps a DataFrame lazily; the others run on the driver."""

    before_migration: Callable[[MigrationContext], bool] | None = None
    transform_rows: Callable[[DataFrame, TransformContext], DataFrame] | None = None
    custom_migration: Callable[[Any], MigrationResult] | None = None
    after_migration: Callable[[MigrationResult], None] | None = None


def should_migrate(
    enabled: bool,
    at_head: bool,
    on_finality: bool,
    finalized_before: int,
    finalized_now: int,
    blocks_since: int,
    interval: int,
) -> bool:
    """Trigger for one batch (M1)."""
    if not (enabled and at_head):
        return False
    return finalized_now > finalized_before if on_finality else blocks_since >= interval


def trigger_column(
    at_head: Column,
    on_finality: Column,
    finalized_before: Column,
    finalized_now: Column,
    blocks_since: Column,
    interval: int,
) -> Column:
    """The same trigger for many processors at once."""
    due = F.when(on_finality, finalized_now > finalized_before).otherwise(blocks_since >= interval)
    return at_head & due


def blocks_since(
    blocks: DataFrame,
    migrations: DataFrame,
    keys: Sequence[str],
    seq: str = "seq",
    max_keys: int | None = None,
) -> DataFrame:
    """Blocks delivered after the last migration of their key.

    ``migrations`` has the keys and ``seq``; a key that never migrated counts all its blocks.
    ``max_keys`` bounds the number of keys; without it the join is shuffled, salted by ``seq`` if need be.
    """
    keys = list(keys)
    last = migrations.groupBy(*keys).agg(F.max(seq).alias("_last"))
    joined = keyed_join(blocks, last, keys, "left", max_rows=max_keys, salt_by=[seq])
    newer = F.col("_last").isNull() | (F.col(seq) > F.col("_last"))
    return joined.groupBy(*keys).agg(F.count_if(newer).alias("blocks_since"))


def cutoff(
    max_height: Column, depth: int, finalized: Column | None = None
) -> Column:
    """``max - depth``, held back to the finalized height when that is given (M3)."""
    plain = max_height - F.lit(depth)
    return plain if finalized is None else F.least(plain, finalized)


def cutoff_report(
    hot_tables: Sequence[DataFrame],
    depth: int,
    finalized: Column | None,
    last_cutoff: Column,
    height: str = "height",
) -> DataFrame:
    """One row: highest hot height over all tables, cutoff, and whether a move is due (M3)."""
    tops = None
    for t in hot_tables:
        part = t.agg(F.max(height).alias("top"))
        tops = part if tops is None else tops.unionByName(part)
    top = tops.agg(F.max("top").alias("max_height"))
    cut = cutoff(F.col("max_height"), depth, finalized)
    return top.withColumn("cutoff", cut).withColumn(
        "should_move",
        F.coalesce((F.col("max_height") > 0) & (F.col("cutoff") > last_cutoff), F.lit(False)),
    )


def rows_to_move(
    hot: DataFrame,
    last_cutoff: Column | int,
    cut: Column | int,
    registry: DataFrame | None = None,
    keys: Sequence[str] = (),
    order: Sequence[str] = (),
    block_keys: Sequence[str] = (),
    max_blocks: int | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    height: str = "height",
    hash: str = "hash",
    salt_by: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``(last_cutoff, cut]`` as they go to cold.

    With a registry, rows of orphaned blocks stay behind; with keys, the newest row per key is kept,
    so cold needs no deduplication on reading. Without both it is a plain copy.
    """
    h = F.col(height)
    moving = hot.filter((h > last_cutoff) & (h <= cut))
    if registry is not None:
        in_span = registry.filter((F.col("height") > last_cutoff) & (F.col("height") <= cut))
        moving = registered_rows(
            moving, in_span, block_keys, max_blocks, height, hash, salt_by
        )
    if keys:
        moving = latest_by_key(moving, keys, order)
    return moving if transform is None else transform(moving)


def move_totals(moves: DataFrame) -> DataFrame:
    """Rows per migration and table, with a total per migration and a grand total.

    ``moves`` is ``(migration_id, table_name, n_rows)``; NULL marks a total.
    """
    return moves.rollup("migration_id", "table_name").agg(
        F.sum("n_rows").cast("bigint").alias("n_rows")
    )
