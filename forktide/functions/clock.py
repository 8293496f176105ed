"""Time helpers (F3 - F6). The session time zone is expected to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def millis_text(ts: Column) -> Column:
    """``2023-05-01 12:00:00.000``"""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def to_millis(ts: Column) -> Column:
    """Timestamps are stored with millisecond precision."""
    return F.date_trunc("MILLISECOND", ts)


def year_month(ts: Column) -> Column:
    """Month partition value ``yyyyMM``."""
    return F.date_format(ts, "yyyyMM")


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def whole_minutes(ms: Column) -> Column:
    return F.floor(ms / F.lit(60000)).cast("bigint")
