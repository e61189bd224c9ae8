"""Column expressions. All are Spark built-ins, so they stay inside generated code."""

from tablewright.functions.text import blank_to_null, cast_or_null, content_key, item_of_split, whole_decimal
from tablewright.functions.timeparts import (
    WEEKDAYS,
    calendar_parts,
    cut_to_second,
    epoch_millis,
    from_epoch_millis,
    from_epoch_millis_cut,
    parse_date,
    timestamp_text,
)

__all__ = [
    "WEEKDAYS",
    "blank_to_null",
    "calendar_parts",
    "cast_or_null",
    "content_key",
    "cut_to_second",
    "epoch_millis",
    "from_epoch_millis",
    "from_epoch_millis_cut",
    "item_of_split",
    "parse_date",
    "timestamp_text",
    "whole_decimal",
]
