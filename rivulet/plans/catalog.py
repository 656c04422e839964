"""All registered queries."""

from . import queries_changes, queries_lookup, queries_shape, queries_state, queries_tables  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
