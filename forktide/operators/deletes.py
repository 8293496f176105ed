"""Logical deletes: tombstones by predicate, by query and by id (P6, P8, D-1, D-2, D-3, A9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forktide.operators.joins import keyed_join
from forktide.operators.versions import collapse_signs, latest_by_key


def tombstones(rows: DataFrame, sign: str = "sign") -> DataFrame:
    """The same rows with sign -1; an existing sign column is replaced."""
    return rows.withColumn(sign, F.lit(-1))


def matching(rows: DataFrame, where: str, params: Mapping[str, Any] | None = None) -> DataFrame:
    """Rows under a predicate text with named markers, e.g. ``"pool = :pool"``."""
    if not params:
        return rows.filter(F.expr(where))
    return rows.sparkSession.sql(f"SELECT * FROM {{src}} WHERE {where}", args=dict(params), src=rows)


def current_rows(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], sign: str | None = "sign"
) -> DataFrame:
    """What a final read returns: sign tables are collapsed, others give the newest per key."""
    if sign is not None and sign in rows.columns:
        return collapse_signs(rows, keys, order, sign)
    return latest_by_key(rows, keys, order)


def removal_by_predicate(
    rows: DataFrame,
    where: str,
    keys: Sequence[str],
    order: Sequence[str],
    sign: str | None = "sign",
    params: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Tombstones for the current rows under a predicate (D-1).

    For a sign table these are rows to append; for a table without sign only the keys matter, to be
    taken out on reading by ``without_ids``.
    """
    hit = matching(current_rows(rows, keys, order, sign), where, params)
    return tombstones(hit, sign or "sign")


def removal_by_query(
    spark: SparkSession, query: str, params: Mapping[str, Any] | None = None, **frames: DataFrame
) -> DataFrame:
    """Tombstones for the rows of a query (D-2); ``{name}`` in the text refers to a DataFrame."""
    return tombstones(spark.sql(query, args=dict(params) if params else None, **frames))


def without_ids(
    rows: DataFrame,
    removed: DataFrame,
    on: Sequence[str],
    max_removed: int | None = None,
    salt_by: Sequence[str] = (),
) -> DataFrame:
    """Rows whose key was not removed (D-3).

    The id list may be as long as the table: it is broadcast only with a proven bound, and is made
    distinct by an aggregate before the join.
    """
    ids = removed.select(*on).distinct()
    return keyed_join(rows, ids, on, "left_anti", max_rows=max_removed, salt_by=salt_by)


def removal_report(table: str, kind: Column, removed: DataFrame) -> DataFrame:
    """``(table, kind, removed)`` with the number of cancelled rows."""
    return removed.agg(F.count(F.lit(1)).alias("removed")).select(
        F.lit(table).alias("table_name"), kind.alias("kind"), "removed"
    )
