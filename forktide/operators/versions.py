"""Newest row per key, and rows cancelled by a sign."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _packed(df: DataFrame, skip: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in skip])


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one with the largest ``order`` (which must be total within a key).

    Written as an aggregate: every map task already reduces a hot key to one row, so no task ever
    receives all versions of a key.
    """
    keys = list(keys)
    newest = F.max_by(_packed(df, keys), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def collapse_signs(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sign: str = "sign"
) -> DataFrame:
    """Rows of keys whose signs add up to more than 0; the newest positive row stands for the key."""
    keys = list(keys)
    positive = F.when(F.col(sign) > 0, F.struct(*order))
    grouped = df.groupBy(*keys).agg(
        F.sum(sign).alias("_sum"),
        F.max_by(_packed(df, [*keys, sign]), positive).alias("_row"),
    )
    return (
        grouped.filter(F.col("_sum") > 0)
        .select(*keys, "_row.*", F.lit(1).alias(sign))
        .select(*df.columns)
    )


def newest(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The single newest row of a table, as an aggregate instead of a sort."""
    row = F.max_by(_packed(df, ()), F.struct(*order)).alias("_row")
    return df.agg(row).filter(F.col("_row").isNotNull()).select("_row.*")
