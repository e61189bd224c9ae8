"""Whole table sets built from the operators: star schema, arrivals lake, lookup tables."""

from tablewright.plans.lake import build_lake, lake_tables
from tablewright.plans.lookup_tables import build_lookups, consolidate, lookup_tables
from tablewright.plans.star import PROFILES, StarProfile, build_star, check_star, star_counts, star_tables

__all__ = [
    "PROFILES",
    "StarProfile",
    "build_lake",
    "build_lookups",
    "build_star",
    "check_star",
    "consolidate",
    "lake_tables",
    "lookup_tables",
    "star_counts",
    "star_tables",
]
