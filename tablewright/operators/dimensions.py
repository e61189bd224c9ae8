"""Dimension builders and keyed upserts.

First and last row per key are ``min`` / ``max`` over a struct of (order, values): one aggregate that
combines within each task before the shuffle, so a key holding a third of the rows arrives as one
row per task. The struct itself is never NULL, so a NULL value on the latest row does overwrite.
Rows equal in ``order`` are settled by their values, so results do not depend on file order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions import calendar_parts

_PICK = "_pick"
_FIRST = "_first"
_LAST = "_last"


def ordered_values(order: Sequence[str], values: Sequence[str]) -> Column:
    """Struct that compares by ``order`` first and by ``values`` on ties."""
    return F.struct(
        *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)]
    )


def unpack(picked: str, values: Sequence[str]) -> list[Column]:
    """The value columns of a struct made by ``ordered_values``."""
    return [F.col(f"{picked}.v{i}").alias(c) for i, c in enumerate(values)]


def dim_distinct(df: DataFrame, columns: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    """Distinct rows of ``columns``; a key whose attributes changed keeps a row per version."""
    for column in not_null:
        df = df.filter(F.col(column).isNotNull())
    return df.select(*columns).dropDuplicates()


def dim_first(df: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first in ``order``; later rows of a known key change nothing."""
    values = [c for c in (columns or df.columns) if c not in key]
    picked = df.groupBy(*key).agg(F.min(ordered_values(order, values)).alias(_PICK))
    return picked.select(*key, *unpack(_PICK, values))


def last_wins(df: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the last in ``order``, taken whole."""
    values = [c for c in (columns or df.columns) if c not in key]
    picked = df.groupBy(*key).agg(F.max(ordered_values(order, values)).alias(_PICK))
    return picked.select(*key, *unpack(_PICK, values))


def upsert_state(
    df: DataFrame, key: Sequence[str], order: Sequence[str], keep_first: Sequence[str], take_last: Sequence[str]
) -> DataFrame:
    """Per key the first and the last values with their order: partial results that can be merged."""
    return df.groupBy(*key).agg(
        F.min(ordered_values(order, keep_first)).alias(_FIRST), F.max(ordered_values(order, take_last)).alias(_LAST)
    )


def merge_states(states: DataFrame, key: Sequence[str]) -> DataFrame:
    """Merge several ``upsert_state`` results into one row per key."""
    return states.groupBy(*key).agg(F.min(_FIRST).alias(_FIRST), F.max(_LAST).alias(_LAST))


def state_rows(
    states: DataFrame, key: Sequence[str], keep_first: Sequence[str], take_last: Sequence[str]
) -> DataFrame:
    """Plain columns of merged states."""
    return states.select(*key, *unpack(_FIRST, keep_first), *unpack(_LAST, take_last))


def dim_upsert(
    df: DataFrame, key: Sequence[str], order: Sequence[str], keep_first: Sequence[str], take_last: Sequence[str]
) -> DataFrame:
    """One row per key: ``keep_first`` as first seen, ``take_last`` as last seen in ``order``."""
    return state_rows(upsert_state(df, key, order, keep_first, take_last), key, keep_first, take_last)


def table_upsert(base: DataFrame | None, changes: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of ``base`` (one per key) with ``changes`` applied; the row last in ``order`` wins.

    Rows of ``base`` whose key does not change pass through: with few changed keys Spark broadcasts
    those and never shuffles ``base``.
    """
    if base is None:
        return last_wins(changes, key, order).select(*changes.columns)
    columns = base.columns
    newest = last_wins(changes.select(*columns), key, order)
    changed = newest.select(*key)
    untouched = base.join(changed, list(key), "left_anti")
    touched = base.join(changed, list(key), "left_semi")
    merged = last_wins(touched.select(*columns).unionByName(newest), key, order)
    return untouched.select(*columns).unionByName(merged.select(*columns))


def calendar(
    df: DataFrame,
    ts_col: str,
    weekday: str = "mon0",
    distinct: bool = True,
    as_text: Sequence[str] = (),
    name: str = "start_time",
) -> DataFrame:
    """Calendar rows of a timestamp column: hour, day, week, month, year, weekday.

    All parts follow from the time, so duplicates are removed on that one column before they are computed.
    """
    times = df.select(F.col(ts_col).alias(name))
    if distinct:
        times = times.dropDuplicates()
    return times.select(name, *calendar_parts(name, weekday, as_text))


def calendar_union(
    *sources: tuple[DataFrame, Sequence[str]],
    weekday: str = "sun1",
    as_text: Sequence[str] = (),
    name: str = "datetime",
) -> DataFrame:
    """Distinct calendar rows of several date columns; a missing date gives one row of NULLs.

    Each source is (frame, date columns); the columns of one frame are read in a single scan.
    """
    dates = None
    for df, columns in sources:
        if len(columns) == 1:
            part = df.select(F.col(columns[0]).alias(name))
        else:
            part = df.select(F.explode(F.array(*columns)).alias(name))
        dates = part if dates is None else dates.union(part)
    return dates.dropDuplicates().select(name, *calendar_parts(name, weekday, as_text, hour=False))
