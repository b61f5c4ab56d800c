"""Queries over the test tables, each with the SQL that states the expected result."""

from ledgerline.suite import metrics, scale, series, tables  # noqa: F401  (they register their queries)
from ledgerline.suite.registry import QUERIES

__all__ = ["QUERIES"]
