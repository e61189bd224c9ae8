"""Incremental load with Structured Streaming."""

from tablewright.streaming.incremental import (
    AppendFact,
    RollUp,
    UpsertDimension,
    compact_dimension,
    compact_rollup,
    incremental_load,
    read_dimension,
    read_fact,
    read_rollup,
)
from tablewright.streaming.star import IncrementalStar

__all__ = [
    "AppendFact",
    "IncrementalStar",
    "RollUp",
    "UpsertDimension",
    "compact_dimension",
    "compact_rollup",
    "incremental_load",
    "read_dimension",
    "read_fact",
    "read_rollup",
]
