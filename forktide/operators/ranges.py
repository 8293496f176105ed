"""Ordered computations over long sequences without one task per key.

A window over ``partitionBy(processor)`` would put a whole feed into one task. Here rows are cut
into ranges of their (integer, unique per key) order column: at most ``width`` rows of a key share
a range, a window runs inside each range, and a second window runs over one row per range. A key
with 10^12 rows has 10^12 / width range rows, if its order column is dense; ``sparse`` fits the ranges
to the rows of a key instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 1 << 16


def range_of(order: str, width: int = WIDTH) -> Column:
    return F.call_function("div", F.col(order), F.lit(width))


def _ranged(df: DataFrame, order: str, width: int) -> DataFrame:
    return df.withColumn("_range", range_of(order, width))


def _spaced(df: DataFrame, keys: Sequence[str], order: str, width: int) -> DataFrame:
    """Ranges of some ``width`` rows for an order with large gaps, such as microseconds.

    Each key's span is cut into as many equal parts as it has ``width`` rows; the extra aggregate is
    one row per key.
    """
    spans = df.groupBy(*keys).agg(
        F.min(order).alias("_low"),
        F.greatest(
            F.ceil((F.max(order) - F.min(order) + 1) * (F.lit(float(width)) / F.count(F.lit(1)))), F.lit(1)
        ).cast("bigint").alias("_step"),
    )
    placed = df.join(spans, list(keys))
    part = F.call_function("div", F.col(order) - F.col("_low"), F.col("_step"))
    return placed.withColumn("_range", part).drop("_low", "_step")


def running_max_before(
    df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, width: int = WIDTH
) -> DataFrame:
    """Adds the largest ``value`` among rows of the same key with a smaller ``order``."""
    keys = list(keys)
    rows = _ranged(df, order, width)
    inside = Window.partitionBy(*keys, "_range").orderBy(order)
    between = Window.partitionBy(*keys).orderBy("_range")
    carried = (
        rows.groupBy(*keys, "_range")
        .agg(F.max(value).alias("_top"))
        .select(
            *keys,
            "_range",
            F.max("_top").over(between.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"),
        )
    )
    return (
        rows.withColumn(
            "_seen", F.max(value).over(inside.rowsBetween(Window.unboundedPreceding, -1))
        )
        .join(carried, [*keys, "_range"])
        .withColumn(out, F.greatest("_seen", "_carry"))
        .drop("_seen", "_carry", "_range")
    )


def previous_value(
    df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, width: int = WIDTH
) -> DataFrame:
    """Adds ``value`` of the row just before, by ``order`` within the key (NULL for the first)."""
    keys = list(keys)
    rows = _ranged(df, order, width)
    inside = Window.partitionBy(*keys, "_range").orderBy(order)
    between = Window.partitionBy(*keys).orderBy("_range")
    carried = (
        rows.groupBy(*keys, "_range")
        .agg(F.max_by(value, order).alias("_last"))
        .select(*keys, "_range", F.lag("_last").over(between).alias("_carry"))
    )
    return (
        rows.withColumn("_first", F.row_number().over(inside) == 1)
        .withColumn("_lag", F.lag(value).over(inside))
        .join(carried, [*keys, "_range"])
        .withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag")))
        .drop("_first", "_lag", "_carry", "_range")
    )


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: str, out: str, width: int = WIDTH, sparse: bool = False
) -> DataFrame:
    """Adds 1, 2, 3, ... per key in ``order``; ``sparse`` orders have gaps wider than a few numbers."""
    keys = list(keys)
    rows = _spaced(df, keys, order, width) if sparse else _ranged(df, order, width)
    inside = Window.partitionBy(*keys, "_range").orderBy(order)
    between = Window.partitionBy(*keys).orderBy("_range")
    offsets = (
        rows.groupBy(*keys, "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *keys,
            "_range",
            F.coalesce(
                F.sum("_n").over(between.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_offset"),
        )
    )
    return (
        rows.withColumn("_local", F.row_number().over(inside))
        .join(offsets, [*keys, "_range"])
        .withColumn(out, F.col("_offset") + F.col("_local"))
        .drop("_local", "_offset", "_range")
    )


def trailing_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    size: int,
    sum_out: str,
    count_out: str,
    width: int = WIDTH,
    sparse: bool = False,
) -> DataFrame:
    """Adds sum and count of ``value`` over the last ``size`` rows of the key, this one included.

    Rows get dense numbers, are cut into slices of ``width`` numbers, and the last ``size - 1`` rows
    of a slice are sent to the next slice as well. A slice has at most width + size - 1 rows.
    """
    if size > width:
        raise ValueError("size must not exceed width")
    keys = list(keys)
    numbered = row_numbers(df, keys, order, "_n", width, sparse)
    slot = F.call_function("div", F.col("_n") - 1, F.lit(width))
    spill = F.pmod(F.col("_n") - 1, F.lit(width)) >= width - (size - 1)
    sliced = numbered.withColumn("_home", slot).withColumn(
        "_slice",
        F.explode(
            F.when(spill, F.array(F.col("_home"), F.col("_home") + 1)).otherwise(
                F.array(F.col("_home"))
            )
        ),
    )
    frame = Window.partitionBy(*keys, "_slice").orderBy("_n").rowsBetween(-(size - 1), 0)
    return (
        sliced.withColumn(sum_out, F.sum(value).over(frame))
        .withColumn(count_out, F.count(value).over(frame))
        .filter(F.col("_slice") == F.col("_home"))
        .drop("_n", "_home", "_slice")
    )
