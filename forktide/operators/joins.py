"""Joins of many rows against a keyed side whose keys are unique (registry, ids, lookups).

The keyed side is broadcast only when its size is bounded beforehand; otherwise both sides are
shuffled and merged, and rows of a hot key are spread by adaptive execution, or else over salts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A block reference is about 100 bytes in a hash relation: 200,000 of them are some 20 MB.
BROADCAST_ROWS = 200_000
SALTS = 32


def proven_small(keyed: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Runs one job that stops after ``max_rows + 1`` rows; use it on stored tables."""
    return keyed.limit(max_rows + 1).count() <= max_rows


def checked_bound(keyed: DataFrame) -> int | None:
    """The ``max_rows`` of ``keyed_join`` for a table whose size is not known beforehand."""
    return BROADCAST_ROWS if proven_small(keyed) else None


def keyed_join(
    rows: DataFrame,
    keyed: DataFrame,
    on: Sequence[str],
    how: str,
    max_rows: int | None = None,
    salt_by: Sequence[str] = (),
    salts: int = SALTS,
) -> DataFrame:
    """Join ``rows`` with ``keyed`` (unique on ``on``); ``how`` keeps its Spark meaning.

    ``max_rows`` is an upper bound of ``keyed`` known to the caller, e.g. from a height range. With
    none, or one above BROADCAST_ROWS, both sides are shuffled and merged, whatever size Spark expects
    of ``keyed``: files on disk say little of the rows in them. Adaptive execution splits partitions
    that a hot key makes large. Where it is off, ``salt_by`` names columns of ``rows`` that differ
    within one key, and the keyed side is repeated once per salt.
    """
    on = list(on)
    if max_rows is not None and max_rows <= BROADCAST_ROWS:
        return rows.join(F.broadcast(keyed), on, how)
    if not salt_by or splits_skew(rows):
        return rows.join(keyed.hint("merge"), on, how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int"))
    repeated = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated.hint("merge"), [*on, "_salt"], how).drop("_salt")


def splits_skew(rows: DataFrame) -> bool:
    """Whether the session splits large partitions of a join by itself."""
    conf = rows.sparkSession.conf
    settings = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(conf.get(s) == "true" for s in settings)
