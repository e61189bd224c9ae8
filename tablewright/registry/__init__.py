"""Queries over the shared test tables, each with the SQL that must give the same rows."""

from tablewright.registry import (  # noqa: F401  (importing a module registers its queries)
    checks,
    dimensions,
    joins,
    lake,
    lookups,
    scalars,
    sinks,
    sources,
    star,
    streams,
)
from tablewright.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
