"""Registered queries and the SQL that must give the same rows."""

from zilverspoor.checks.core import CHECKS, oracle_sql, queries
from zilverspoor.checks import (  # noqa: F401  (registers the queries)
    functions,
    joins,
    mappings,
    projections,
    quality,
    sinks,
    sources,
    windows,
)

__all__ = ["CHECKS", "oracle_sql", "queries"]
