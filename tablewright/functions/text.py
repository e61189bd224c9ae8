"""Text, cast and hash expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def blank_to_null(column: Column | str) -> Column:
    """Empty text as NULL."""
    return F.nullif(_col(column), F.lit(""))


def cast_or_null(column: Column | str, kind: str) -> Column:
    """Cast that gives NULL, not an error, for text that is no such value."""
    return _col(column).try_cast(kind)


def item_of_split(column: Column | str, delimiter: str, index: int) -> Column:
    """Item ``index`` (from 0) of text split at a literal delimiter; NULL beyond the last item."""
    return F.get(F.split(_col(column), f"\\Q{delimiter}\\E"), F.lit(index))


def content_key(*columns: Column | str) -> Column:
    """md5 of the concatenated text of the columns; NULL if one of them is NULL."""
    return F.md5(F.concat(*[_col(column).cast("string") for column in columns]))


def whole_decimal(column: Column | str, precision: int = 18) -> Column:
    """A number as a decimal of scale 0, its fraction cut and not rounded."""
    return _col(column).cast("bigint").cast(f"decimal({precision},0)")
