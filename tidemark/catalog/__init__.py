"""Registered queries over the test tables and the SQL that checks them."""

from tidemark.catalog import checks, mechanisms, operators, products, storage  # noqa: F401  (each module registers its queries)
from tidemark.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
