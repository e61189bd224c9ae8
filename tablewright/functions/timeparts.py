"""Time conversions and calendar parts.

Times are TIMESTAMP_NTZ counted from the epoch in UTC, so no result depends on the session time zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day-number conventions (number of Monday .. rule) and the text form of a timestamp.
WEEKDAYS = ("mon0", "sun0", "sun1")
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def from_epoch_millis(millis: Column | str) -> Column:
    """Epoch milliseconds as a timestamp, milliseconds kept."""
    return F.timestamp_add("MILLISECOND", _col(millis), F.expr(EPOCH))


def from_epoch_millis_cut(millis: Column | str) -> Column:
    """Epoch milliseconds as a timestamp cut to whole seconds, by integer division."""
    millis = _col(millis)
    return F.timestamp_add("MILLISECOND", millis - millis % 1000, F.expr(EPOCH))


def epoch_millis(ts: Column | str) -> Column:
    """Whole milliseconds between the epoch and a TIMESTAMP_NTZ.

    Put together from its parts: the built-in difference goes through the session zone, where an hour
    skipped in spring does not exist.
    """
    days = F.datediff(_col(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(ts)) * 60 + F.minute(ts)
    return minutes * 60_000 + (F.date_part(F.lit("SECOND"), _col(ts)) * 1000).cast("bigint")


def cut_to_second(ts: Column | str) -> Column:
    """A TIMESTAMP_NTZ without its fraction of a second."""
    fraction = F.date_part(F.lit("SECOND"), _col(ts)) % 1
    return _col(ts) - F.make_dt_interval(secs=fraction)


def timestamp_text(ts: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a timestamp, its fraction cut off."""
    return cut_to_second(ts).cast("string")


def weekday_number(ts: Column | str, convention: str) -> Column:
    """Day of the week: ``mon0`` Monday=0, ``sun0`` Sunday=0, ``sun1`` Sunday=1."""
    if convention == "mon0":
        return F.weekday(ts)
    if convention == "sun0":
        return F.dayofweek(ts) - 1
    if convention == "sun1":
        return F.dayofweek(ts)
    raise ValueError(f"weekday convention must be one of {WEEKDAYS}, not {convention!r}")


def calendar_parts(
    ts: Column | str, weekday: str = "mon0", as_text: Sequence[str] = (), hour: bool = True
) -> list[Column]:
    """Aliased hour, day, ISO week, month, year and weekday of a timestamp or date."""
    parts = {
        "hour": F.hour(ts) if hour else None,
        "day": F.dayofmonth(ts),
        "week": F.weekofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "weekday": weekday_number(ts, weekday),
    }
    return [
        (part.cast("string") if name in as_text else part).alias(name)
        for name, part in parts.items()
        if part is not None
    ]


def parse_date(text: Column | str, pattern: str) -> Column:
    """Date from text; NULL when the text does not fit the pattern."""
    return F.try_to_date(text, pattern)
