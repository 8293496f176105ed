"""Rows before they are written: normalisation, entity grouping, zone routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forktide.functions import clock, names, text, u256


def normalise_rows(
    df: DataFrame, hex_fields: Sequence[str] = (), u256_fields: Sequence[str] = ()
) -> DataFrame:
    """Column expressions chosen from the schema.

    Integers wider than bigint become text, ``u256_fields`` padded to 78 digits; ``0x`` is stripped
    from hex fields; timestamps are cut to milliseconds; arrays and everything else pass.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in u256_fields:
            c = u256.pad(c)
        elif f.name in hex_fields and isinstance(f.dataType, T.StringType):
            c = text.strip_hex(c)
        elif isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 0:
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = clock.to_millis(c).cast(f.dataType)
        out.append(c.alias(f.name))
    return df.select(*out)


def zone_of(is_head: Column) -> Column:
    """Catching up -> cold, at the head of the feed -> hot."""
    return F.when(is_head, F.lit("hot")).otherwise(F.lit("cold"))


def route(df: DataFrame, entity: str, is_head: Column, network: str) -> DataFrame:
    """Adds ``target``, the table each row goes to."""
    return df.withColumn("target", names.entity_table(F.col(entity), network, zone_of(is_head)))


def split_by_entity(df: DataFrame, entity: str, entities: Sequence[str]) -> dict[str, DataFrame]:
    """One DataFrame per entity of a mixed batch (T6); persist the batch before writing several."""
    return {e: df.filter(F.col(entity) == e).drop(entity) for e in entities}
