"""Registered queries, each beside the SQL it must agree with."""

from . import exports, imports, loads, merge, registry, schema, tables, unique, upkeep  # noqa: F401
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
