"""All registered queries."""

from tidemark.catalog import bronze, changes, star, tables  # noqa: F401
from tidemark.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
