"""Operators of a training-data pipeline. Nothing outside this subpackage imports it."""

from tablewright.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
