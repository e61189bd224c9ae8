"""DataFrame operators: filters, joins, dimensions, keys, roll-ups and data checks."""

from tablewright.operators.dimensions import (
    calendar,
    calendar_union,
    dim_distinct,
    dim_first,
    dim_upsert,
    last_wins,
    table_upsert,
)
from tablewright.operators.filters import concat_rows, filter_equal, filter_filled, filter_not_null, project
from tablewright.operators.joins import hot_keys, lookup_one, natural_join
from tablewright.operators.keys import monotonic_key, running_starts, sequence_key
from tablewright.operators.lookups import (
    music_history,
    song_playlist_session,
    user_history,
)
from tablewright.operators.quality import (
    check_key,
    check_length,
    check_non_empty,
    check_not_null,
    check_rejects,
    check_sql,
    check_unique,
    duplicate_keys,
    observe_faults,
    observed_checks,
    raise_on_failure,
    run_checks,
    table_faults,
)
from tablewright.operators.rejects import cast_faults, split_typed
from tablewright.operators.rollup import numbered_counts, roll_up, row_counts

__all__ = [
    "calendar",
    "calendar_union",
    "cast_faults",
    "check_key",
    "check_length",
    "check_non_empty",
    "check_not_null",
    "check_rejects",
    "check_sql",
    "check_unique",
    "concat_rows",
    "dim_distinct",
    "dim_first",
    "dim_upsert",
    "duplicate_keys",
    "filter_equal",
    "filter_filled",
    "filter_not_null",
    "hot_keys",
    "last_wins",
    "lookup_one",
    "monotonic_key",
    "music_history",
    "natural_join",
    "numbered_counts",
    "observe_faults",
    "observed_checks",
    "project",
    "raise_on_failure",
    "roll_up",
    "row_counts",
    "run_checks",
    "running_starts",
    "sequence_key",
    "song_playlist_session",
    "split_typed",
    "table_faults",
    "table_upsert",
    "user_history",
]
