"""Registered queries; importing the package fills the registry."""

from forktide.plans import (  # noqa: F401
    chain_queries,
    state_queries,
    value_queries,
    zone_queries,
)
from forktide.plans import stored_queries  # noqa: F401,I001 - reuses oracles of the others
from forktide.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
