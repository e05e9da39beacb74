"""Every registered query."""

from tillroll.catalog import customers, rows, tables  # noqa: F401  (importing registers them)
from tillroll.catalog.registry import QUERIES

__all__ = ["QUERIES"]
