from __future__ import annotations

import json
import os
import sys
from datetime import datetime, timezone

import pytest
from pyspark.sql import DataFrame

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablewright.schemas import CATALOGUE, EVENT_LOG  # noqa: E402
from tablewright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        4,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def millis(text: str) -> int:
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


def event(ts: str, user: str | None, session: int, item: int, **other) -> dict:
    """An event record as it stands in a log file; a play unless ``page`` says otherwise."""
    row = {
        "artist": "Band A", "auth": "Logged In", "firstName": f"First{user}", "gender": "F", "itemInSession": item,
        "lastName": f"Last{user}", "length": 200.5, "level": "free", "location": "Town", "method": "PUT",
        "page": "NextSong", "registration": 1512345678901.0, "sessionId": session, "song": "Song 1", "status": 200,
        "ts": millis(ts), "userAgent": "\"Agent/1.0 (X; Y)\"", "userId": user,
    }
    return {**row, **other}


EVENTS = [
    # matches on title, artist and length
    event("2018-11-01T21:07:13.457", "8", 137, 0),
    # two plays of a session in one second
    event("2018-11-01T21:07:13.100", "8", 137, 1, song="Song 2", length=301.25),
    # matches on two keys only
    event("2018-11-02T01:00:00.000", "10", 182, 0, length=999.0),
    # no match
    event("2018-11-02T02:00:00.000", "10", 182, 1, artist="Nobody", song="Unknown", length=1.5, level="paid"),
    # a title and artist that two catalogue rows share
    event("2018-11-03T03:00:00.000", "26", 183, 0, artist="Band B", song="Twin", length=100.25),
    # the last millisecond of a day; ISO week 1 in December
    event("2018-12-31T23:59:59.999", "26", 183, 1, level="paid"),
    # no play
    event("2018-11-01T20:00:00.000", "41", 37, 0, page="Home", artist=None, song=None, length=None),
    event("2018-11-01T20:00:01.000", None, 40, 0, page="Login", artist=None, song=None, length=None, auth="Logged Out"),
    # plays without user
    event("2018-11-04T00:00:00.000", "", 50, 0),
    event("2018-11-04T00:00:05.000", None, 51, 0),
]


def song(song_id: str | None, artist_id: str, title: str, artist: str, duration: float, **other) -> dict:
    row = {
        "num_songs": 1, "artist_id": artist_id, "artist_latitude": None, "artist_longitude": None,
        "artist_location": "", "artist_name": artist, "song_id": song_id, "title": title, "duration": duration, "year": 0,
    }
    return {**row, **other}


SONGS = [
    song("S1", "A1", "Song 1", "Band A", 200.5, artist_location="Old Town", artist_latitude=1.5, artist_longitude=2.5),
    # an artist with a second song and a changed place
    song("S2", "A1", "Song 2", "Band A", 301.25, artist_location="New Town", year=1999),
    # equal title and artist
    song("S3", "A2", "Twin", "Band B", 100.25),
    song("S4", "A2", "Twin", "Band B", 100.75),
    # a repeated song id
    song("S5", "A3", "Repeat", "Band C", 50.0),
    song("S5", "A3", "Repeat (live)", "Band C", 60.0),
    song(None, "A4", "Untitled", "Band D", 10.0),
]


def as_table(spark, records: list[dict], schema, path) -> DataFrame:
    """Records as a one-file table: frames over Python lists take a task and a conversion per core."""
    df = spark.createDataFrame([tuple(row[c] for c in schema.names) for row in records], schema)
    df.coalesce(1).write.parquet(str(path))
    return spark.read.schema(schema).parquet(str(path))


@pytest.fixture(scope="session")
def events(spark, tmp_path_factory):
    return as_table(spark, EVENTS, EVENT_LOG, tmp_path_factory.mktemp("tables") / "events")


@pytest.fixture(scope="session")
def songs(spark, tmp_path_factory):
    return as_table(spark, SONGS, CATALOGUE, tmp_path_factory.mktemp("tables") / "songs")


@pytest.fixture(scope="session")
def log_dir(tmp_path_factory):
    """The events as dated JSON-lines files."""
    root = tmp_path_factory.mktemp("log_data")
    for row in EVENTS:
        day = datetime.fromtimestamp(row["ts"] / 1000, timezone.utc)
        folder = root / f"{day:%Y}" / f"{day:%m}"
        folder.mkdir(parents=True, exist_ok=True)
        with open(folder / f"{day:%Y-%m-%d}-events.json", "a", encoding="utf-8") as out:
            out.write(json.dumps(row) + "\n")
    return str(root)


@pytest.fixture(scope="session")
def song_dir(tmp_path_factory):
    """The catalogue as one JSON file per song, three folders deep."""
    root = tmp_path_factory.mktemp("song_data")
    for i, row in enumerate(SONGS):
        folder = root / "A" / "AB"[i % 2] / "ABC"[i % 3]
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"TR{i}.json").write_text(json.dumps(row), encoding="utf-8")
    return str(root)


def rows(df) -> list[tuple]:
    """Rows as sorted tuples; NULLs first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
