"""Table names: entity class name -> zone table name (F1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONES = ("hot", "cold")

# Word boundaries put into a PascalCase name, applied in this order.
_BOUNDARIES = (
    ("([a-z])([A-Z])", "$1_$2"),
    ("([0-9])([A-Z])", "$1_$2"),
    ("([A-Z]+)([A-Z][a-z])", "$1_$2"),
)


def entity_table(entity: Column, network: str, zone: Column) -> Column:
    """``V3Swap`` -> ``ethereum_hot_v3_swaps``, as a column expression."""
    snake = entity
    for pattern, replacement in _BOUNDARIES:
        snake = F.regexp_replace(snake, pattern, replacement)
    return F.concat(F.lit(f"{network}_"), zone, F.lit("_"), F.lower(snake), F.lit("s"))


def zone_table(network: str, zone: str, base: str) -> str:
    """Physical name of one zone of an event table."""
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone!r}, expected one of {ZONES}")
    return f"{network}_{zone}_{base}"


def snapshot_table(network: str, base: str) -> str:
    return f"{network}_{base}"


def substitute_network(template: str, network: str) -> str:
    """Fill the ``${network}`` placeholder, wherever it occurs."""
    return template.replace("${network}", network)
