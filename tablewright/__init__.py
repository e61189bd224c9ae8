"""Spark-native building blocks for analytical tables: sources, dimensions, facts, lookups, checks."""

__version__ = "0.1.0"
