"""Consolidated event CSV and the lookup tables answering one question each."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import schemas
from tablewright.operators import filter_filled, music_history, song_playlist_session, user_history
from tablewright.operators.lookups import LOOKUP_KEYS
from tablewright.sources import read_csv, read_parquet, write_csv, write_table
from tablewright.storage import run_together, stash

ORDER = ("sessionId", "itemInSession")


def consolidate(events: DataFrame) -> DataFrame:
    """The needed columns of the events that name an artist."""
    return filter_filled(events, "artist").select(*schemas.CONSOLIDATED_COLUMNS)


def lookup_tables(
    events: DataFrame, order: Sequence[str] = ORDER, song_length: str = "double"
) -> dict[str, DataFrame]:
    """The three tables of consolidated events; of rows with one key the last in ``order`` stays."""
    return {
        "music_history": music_history(events, order, song_length),
        "user_history": user_history(events, order),
        "song_playlist_session": song_playlist_session(events, order),
    }


def build_lookups(
    spark: SparkSession,
    csv_dir: str,
    out: str,
    order: Sequence[str] = ORDER,
    only: Sequence[str] = tuple(LOOKUP_KEYS),
) -> dict[str, DataFrame]:
    """Read a folder of event CSVs, write the consolidated CSV and the lookup tables, return the tables.

    The consolidated rows are kept as Parquet too, so the CSV is parsed once and each table reads
    only its own columns.
    """
    out = out.rstrip("/")
    events = stash(consolidate(read_csv(spark, csv_dir, schemas.EVENT_CSV)), "events", f"{out}/consolidated")
    tables = lookup_tables(events, order)
    jobs = [partial(write_csv, events, f"{out}/consolidated_csv", quote_all=True)]
    for name in only:
        place, sort = LOOKUP_KEYS[name]
        # files are ranges of the first key; the others are found by an index
        jobs.append(partial(write_table, tables[name], f"{out}/{name}", cluster_by=place, sort_by=sort, index=[*place, *sort][1:]))
    run_together(spark, jobs)
    return {name: read_parquet(spark, f"{out}/{name}") for name in only}


def song_of_item(music: DataFrame, session_id: int, item: int) -> DataFrame:
    """Artist, song and length of one item of a session."""
    return music.filter((F.col("sessionId") == session_id) & (F.col("itemInSession") == item)).select(
        "artist_name", "song_title", "song_length"
    )


def songs_of_session(users: DataFrame, user_id: int, session_id: int) -> DataFrame:
    """Songs and user name of one user's session, by item."""
    found = users.filter((F.col("userId") == user_id) & (F.col("sessionId") == session_id))
    return found.orderBy("itemInSession").select("artist_name", "song_title", "firstName", "lastName")


def users_of_song(plays: DataFrame, song_title: str) -> DataFrame:
    """Names of all users who played a song."""
    return plays.filter(F.col("song_title") == song_title).select("firstName", "lastName")
