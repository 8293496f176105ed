"""Queries readers run on event tables: top tokens, top rows, month ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forktide.functions import u256


def since(rows: DataFrame, ts: str, start: str, month: str | None = None) -> DataFrame:
    """Rows from a time on; ``month`` names a yyyyMM partition column to prune by as well."""
    out = rows.filter(F.col(ts) >= F.lit(start).cast("timestamp"))
    if month is not None:
        out = out.filter(F.col(month) >= F.lit(start[:4] + start[5:7]))
    return out


def top_tokens(
    transfers: DataFrame, k: int = 10, token: str = "token", value: str = "value"
) -> DataFrame:
    """The ``k`` tokens with most transfers and their exact 256-bit totals; ties go by token."""
    return (
        transfers.groupBy(token)
        .agg(
            F.count(F.lit(1)).alias("transfer_count"),
            u256.sum_u256(F.col(value)).alias("total_value"),
        )
        .orderBy(F.col("transfer_count").desc(), token)
        .limit(k)
    )


def top_rows(rows: DataFrame, by: Column, ties: Sequence[str], k: int = 100) -> DataFrame:
    """The ``k`` rows with the largest ``by``; Spark keeps k rows per task and merges those."""
    return rows.orderBy(by.desc(), *ties).limit(k)
