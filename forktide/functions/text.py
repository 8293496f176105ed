"""Text helpers: addresses, hex fields, defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def address(c: Column) -> Column:
    """Addresses are kept in lower case."""
    return F.lower(c)


def topic_address(topic: Column) -> Column:
    """A 32-byte log topic holds an address in its last 20 bytes."""
    return F.concat(F.lit("0x"), F.lower(F.right(topic, F.lit(40))))


def strip_hex(c: Column) -> Column:
    """Drop a leading ``0x``; the empty string stays empty."""
    return F.when(c.startswith("0x"), F.substring(c, 3, 2147483647)).otherwise(c)


def to_long(c: Column) -> Column:
    """Number or numeric text -> bigint, NULL where it is neither."""
    return c.try_cast("bigint")


def first_nonempty(*cs: Column) -> Column:
    """First value that is neither NULL nor the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])


def first_nonzero(*cs: Column) -> Column:
    """First number that is neither NULL nor 0; the last argument is the default as it is."""
    return F.coalesce(*[F.nullif(c, F.lit(0)) for c in cs[:-1]], cs[-1])
