"""Contract of event tables, over schema and rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """All schema failures of a set of event tables in one message."""


def schema_problems(
    tables: Mapping[str, Iterable[str]], height: str = "height", hash: str = "hash"
) -> list[str]:
    """One line per missing column, naming the columns the table does have."""
    problems = []
    for table, columns in tables.items():
        columns = list(columns)
        for needed in (height, hash):
            if needed not in columns:
                problems.append(
                    f"table '{table}' lacks column '{needed}'; available: {', '.join(columns)}"
                )
    return problems


def require_contract(
    tables: Mapping[str, Iterable[str]], height: str = "height", hash: str = "hash"
) -> None:
    problems = schema_problems(tables, height, hash)
    if problems:
        raise ContractError("event tables break their contract:\n  " + "\n  ".join(problems))


def row_report(
    name: str,
    rows: DataFrame,
    key: Sequence[str],
    height: str = "height",
    hash: str = "hash",
    text_lengths: Mapping[str, int] | None = None,
) -> DataFrame:
    """One row per table: bad heights, hashes of wrong length and duplicate keys.

    A single pass: rows are aggregated by key (partially before the shuffle), then to one row. A
    table without the height or hash column gets NULL where rows cannot be judged.
    """
    lengths = dict(text_lengths or {})
    has_height, has_hash = height in rows.columns, hash in rows.columns

    def bad(condition, present: bool):
        return F.count_if(condition) if present else F.lit(None).cast("bigint")

    h = F.col(height) if has_height else F.lit(None)
    wrong = F.lit(False)
    for column, size in lengths.items():
        if column in rows.columns:
            wrong = wrong | F.coalesce(F.length(column) != size, F.lit(True))
    known_key = [c for c in key if c in rows.columns]
    per_key = rows.groupBy(*known_key).agg(
        F.count(F.lit(1)).alias("n"),
        bad(h.isNull(), has_height).alias("null_height"),
        bad(h < 0, has_height).alias("negative_height"),
        F.count_if(wrong).alias("wrong_length"),
    )

    def total(column: str):
        return F.sum(column).cast("bigint").alias(column)

    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        total("null_height"),
        total("negative_height"),
        total("wrong_length"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
    ).select(
        F.lit(name).alias("table_name"),
        F.lit(has_height).alias("has_height"),
        F.lit(has_hash).alias("has_hash"),
        "n_rows",
        "null_height",
        "negative_height",
        "wrong_length",
        "duplicate_rows",
    )
