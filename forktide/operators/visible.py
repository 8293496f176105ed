"""What a reader sees: valid rows, orphans, and the union of both zones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forktide.operators.joins import keyed_join


def valid_rows(
    rows: DataFrame,
    registry: DataFrame,
    threshold: Column,
    max_blocks: int | None = None,
    keys: Sequence[str] = (),
    height: str = "height",
    hash: str = "hash",
    salt_by: Sequence[str] = (),
) -> DataFrame:
    """Rows at or below the threshold, and above it those whose block is registered.

    One scan: the registry is joined as a marker, so old rows need no second branch. The registry is
    cut to heights above the threshold first, which leaves at most ``depth`` of them per processor:
    pass that bound as ``max_blocks`` to have it broadcast. ``threshold`` may refer to a column of
    both sides. An empty registry leaves the old rows only.
    """
    on = [*keys, height, hash]
    marks = (
        registry.filter(F.col("height") > threshold)
        .select(*keys, F.col("height").alias(height), F.col("hash").alias(hash))
        .dropDuplicates(on)
        .withColumn("_valid", F.lit(True))
    )
    marked = keyed_join(rows, marks, on, "left", max_rows=max_blocks, salt_by=salt_by)
    return marked.filter((F.col(height) <= threshold) | F.col("_valid")).drop("_valid")


def registered_rows(
    rows: DataFrame,
    registry: DataFrame,
    keys: Sequence[str] = (),
    max_blocks: int | None = None,
    height: str = "height",
    hash: str = "hash",
    salt_by: Sequence[str] = (),
) -> DataFrame:
    """Rows whose block is registered, whatever their height."""
    return _by_block(rows, registry, "left_semi", keys, max_blocks, height, hash, salt_by)


def orphan_rows(
    rows: DataFrame,
    registry: DataFrame,
    keys: Sequence[str] = (),
    max_blocks: int | None = None,
    height: str = "height",
    hash: str = "hash",
    salt_by: Sequence[str] = (),
) -> DataFrame:
    """Rows whose block is not registered."""
    return _by_block(rows, registry, "left_anti", keys, max_blocks, height, hash, salt_by)


def _by_block(rows, registry, how, keys, max_blocks, height, hash, salt_by) -> DataFrame:
    on = [*keys, height, hash]
    blocks = registry.select(*keys, F.col("height").alias(height), F.col("hash").alias(hash))
    return keyed_join(rows, blocks, on, how, max_rows=max_blocks, salt_by=salt_by)


def zone_union(
    cold: DataFrame,
    hot: DataFrame,
    cutoff: Column | int,
    height_from: int | None = None,
    height_to: int | None = None,
    height: str = "height",
) -> DataFrame:
    """Both zones as one table (U1): cold up to the committed cutoff, hot above it.

    A row lying in both zones during a move is read once. With an integer cutoff and a height range
    the zone that cannot contribute is left out of the plan (P2, zone pruning).
    """
    h = F.col(height)
    parts = []
    known = isinstance(cutoff, int)
    if not (known and height_from is not None and height_from > cutoff):
        parts.append(cold.filter(h <= cutoff))
    if not (known and height_to is not None and height_to <= cutoff):
        parts.append(hot.filter(h > cutoff))
    if not parts:
        parts = [cold.filter(F.lit(False))]
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if height_from is not None:
        out = out.filter(h >= height_from)
    if height_to is not None:
        out = out.filter(h <= height_to)
    return out


def partition_check(
    before: DataFrame, moved: DataFrame, stayed: DataFrame, key: Sequence[str]
) -> DataFrame:
    """moved + stayed = before, with nothing in both (U2): one row of counts.

    ``lost`` and ``extra`` count rows by key, so one shuffle of the key replaces two EXCEPT ALL.
    """
    tagged = (
        before.select(*key, F.lit(1).alias("_b"), F.lit(0).alias("_m"), F.lit(0).alias("_s"))
        .unionAll(moved.select(*key, F.lit(0), F.lit(1), F.lit(0)))
        .unionAll(stayed.select(*key, F.lit(0), F.lit(0), F.lit(1)))
    )
    per_key = tagged.groupBy(*key).agg(
        F.sum("_b").alias("b"), F.sum("_m").alias("m"), F.sum("_s").alias("s")
    )
    after = F.col("m") + F.col("s")

    def total(c: Column, name: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)

    return per_key.agg(
        total(F.col("b"), "rows_before"),
        total(F.col("m"), "rows_moved"),
        total(F.col("s"), "rows_stayed"),
        total(F.greatest(F.col("b") - after, F.lit(0)), "lost"),
        total(F.greatest(after - F.col("b"), F.lit(0)), "extra"),
        total(F.when((F.col("m") > 0) & (F.col("s") > 0), 1).otherwise(0), "in_both"),
    )
