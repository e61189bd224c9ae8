"""Row filters and projections. Plain built-in predicates, so they reach the file scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_equal(df: DataFrame, **constants: object) -> DataFrame:
    """Rows whose columns equal the given constants."""
    for column, value in constants.items():
        df = df.filter(F.col(column) == F.lit(value))
    return df


def filter_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with a value in each of the columns."""
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def filter_filled(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose text columns are neither NULL nor blank."""
    for column in columns:
        df = df.filter(F.col(column).isNotNull() & (F.col(column) != ""))
    return df


def project(df: DataFrame, columns: Mapping[str, str | Column] | Sequence[str]) -> DataFrame:
    """Select columns; a mapping gives them new names or values."""
    if not isinstance(columns, Mapping):
        return df.select(*columns)
    return df.select(*[(F.col(src) if isinstance(src, str) else src).alias(name) for name, src in columns.items()])


def concat_rows(*frames: DataFrame) -> DataFrame:
    """All rows of frames of the same layout, columns matched by position."""
    return reduce(DataFrame.union, frames)
