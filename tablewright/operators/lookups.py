"""Query-first lookup tables over consolidated events: one row per key, clustered for point reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions import cast_or_null
from tablewright.operators.dimensions import last_wins

# The tables' keys. The leading ones place a row, the rest sort it.
LOOKUP_KEYS = {
    "music_history": (["sessionId"], ["itemInSession"]),
    "user_history": (["userId", "sessionId"], ["itemInSession"]),
    "song_playlist_session": (["song_title"], ["userId"]),
}


def music_history(events: DataFrame, order: Sequence[str] = (), song_length: str = "double") -> DataFrame:
    """Artist, song and length of each item of a session."""
    rows = events.select(
        F.col("sessionId").cast("int").alias("sessionId"),
        F.col("itemInSession").cast("int").alias("itemInSession"),
        F.col("artist").alias("artist_name"),
        F.col("song").alias("song_title"),
        F.col("length").cast(song_length).alias("song_length"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
    )
    return _keyed(rows, "music_history", len(order))


def user_history(events: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Songs of each user's session, by item."""
    rows = events.select(
        cast_or_null("userId", "int").alias("userId"),
        F.col("sessionId").cast("int").alias("sessionId"),
        F.col("itemInSession").cast("int").alias("itemInSession"),
        F.col("song").alias("song_title"),
        F.col("artist").alias("artist_name"),
        "firstName",
        "lastName",
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
    )
    return _keyed(rows, "user_history", len(order))


def song_playlist_session(events: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Users who played each song, once per song and user."""
    rows = events.select(
        F.col("song").alias("song_title"),
        cast_or_null("userId", "int").alias("userId"),
        "firstName",
        "lastName",
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
    )
    return _keyed(rows, "song_playlist_session", len(order))


def _keyed(rows: DataFrame, table: str, n_order: int) -> DataFrame:
    place, sort = LOOKUP_KEYS[table]
    order = [f"_o{i}" for i in range(n_order)]
    columns = [c for c in rows.columns if c not in order]
    return last_wins(rows, [*place, *sort], order, columns).select(*columns)
