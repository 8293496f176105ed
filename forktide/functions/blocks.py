"""Block references as values: JSON interchange and the finality threshold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_LIST = "array<struct<height:bigint,hash:string>>"


def blocks_json(blocks: Column) -> Column:
    """Only height and hash are kept; other fields of the structs are dropped."""
    slim = F.transform(
        blocks, lambda b: F.struct(b["height"].alias("height"), b["hash"].alias("hash"))
    )
    return F.to_json(slim)


def parse_blocks(text: Column) -> Column:
    """JSON text -> block list; NULL or empty text is the empty list."""
    parsed = F.from_json(F.nullif(text, F.lit("")), BLOCK_LIST)
    return F.coalesce(parsed, F.array().cast(BLOCK_LIST))


def threshold(tip: Column, depth: int) -> Column:
    """Rows at or below this height need no registry entry."""
    return tip - F.lit(depth)
