"""Removing rows of stored tables logically (D-1, D-2, D-3 on tables, with report A9).

A table with a ``sign`` column gets tombstones appended. For any other table the removed keys are
kept in a table next to it, with the write order they apply up to, and reads leave those rows out; a
row written later is visible again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forktide.operators import deletes

SIGN = "sign"


@dataclass(frozen=True)
class Removable:
    """A stored table whose rows can be removed: its key, and the column that orders writes."""

    table: str
    key: tuple[str, ...]
    order: str

    @property
    def removed(self) -> str:
        return f"{self.table}_removed"


def _has_sign(spark: SparkSession, t: Removable) -> bool:
    return SIGN in spark.table(t.table).columns


def _removed_keys(spark: SparkSession, t: Removable) -> DataFrame:
    """Newest removal per key: one row per key, whatever was removed how often."""
    return spark.table(t.removed).groupBy(*t.key).agg(F.max("upto").alias("upto"))


def read_rows(spark: SparkSession, t: Removable) -> DataFrame:
    """Current rows: collapsed by sign, or the newest per key that was not removed since."""
    rows = spark.table(t.table)
    current = deletes.current_rows(rows, t.key, [t.order])
    if SIGN in rows.columns or not spark.catalog.tableExists(t.removed):
        return current
    gone = current.join(_removed_keys(spark, t), list(t.key), "left")
    kept = gone.filter(F.col("upto").isNull() | (F.col(t.order) > F.col("upto")))
    return kept.select(*rows.columns)


def _append(spark: SparkSession, t: Removable, hit: DataFrame) -> int:
    counted = Observation()
    hit = hit.observe(counted, F.count(F.lit(1)).alias("n"))
    if _has_sign(spark, t):
        stones = deletes.tombstones(hit, SIGN).select(*spark.table(t.table).columns)
        stones.write.mode("append").insertInto(t.table)
    else:
        if not spark.catalog.tableExists(t.removed):
            empty = spark.table(t.table).select(*t.key, F.col(t.order).alias("upto")).limit(0)
            empty.write.format("parquet").saveAsTable(t.removed)
        keys = hit.select(*t.key, F.col(t.order).alias("upto"))
        keys.write.mode("append").insertInto(t.removed)
    return counted.get["n"]


def remove_rows(
    spark: SparkSession,
    tables: Sequence[Removable],
    where: str,
    params: Mapping[str, Any] | None = None,
) -> list[dict[str, Any]]:
    """Remove the current rows under a predicate from each table; one report entry per table."""
    out = []
    for t in tables:
        kind = SIGN if _has_sign(spark, t) else "keys"
        hit = deletes.matching(read_rows(spark, t), where, params)
        out.append({"table": t.table, "kind": kind, "removed": _append(spark, t, hit)})
    return out


def remove_by_query(
    spark: SparkSession, t: Removable, query: str, params: Mapping[str, Any] | None = None
) -> int:
    """Remove the rows a query returns; they carry the table's columns."""
    return _append(spark, t, spark.sql(query, args=dict(params) if params else None))


def remove_ids(spark: SparkSession, t: Removable, ids: DataFrame) -> int:
    """Remove the current rows with the given keys."""
    hit = read_rows(spark, t).join(ids.select(*t.key).distinct(), list(t.key), "left_semi")
    return _append(spark, t, hit)
