import csv

import pytest
from conftest import rows

from tablewright import schemas
from tablewright.plans import build_lookups, lookup_tables
from tablewright.plans.lookup_tables import song_of_item, songs_of_session, users_of_song
from tablewright.sources import read_csv, write_csv

NAMES = schemas.EVENT_CSV.names


def line(artist, song, user, session, item, first="Ann", last="Lee", length="200.5"):
    row = dict.fromkeys(NAMES, "")
    row.update(
        artist=artist, song=song, userId=user, sessionId=session, itemInSession=item, firstName=first, lastName=last,
        length=length, level="free", location="Town, ST", registration="1.53E+12", ts="1.52468E+12", page="NextSong",
    )
    return [row[c] for c in NAMES]


@pytest.fixture
def csv_dir(tmp_path):
    days = {
        "2018-11-01.csv": [
            line("Band A", "Song 2", 8, 137, 3),
            line("", "", 8, 137, 0, length=""),
            line("Band A", "Song 1", 8, 137, 1),
        ],
        "2018-11-02.csv": [
            line("Band A", "Song 1", 8, 150, 0),
            line("Band A", "Song 1", 9, 151, 0, "Bo", 'O"Ray'),
            line("Band B", "Song 1", 8, 137, 10),
        ],
    }
    folder = tmp_path / "event_data"
    folder.mkdir()
    for name, lines in days.items():
        with open(folder / name, "w", newline="", encoding="utf-8") as out:
            csv.writer(out).writerows([NAMES, *lines])
    return str(folder)


def test_build_and_ask(spark, csv_dir, tmp_path):
    out = str(tmp_path / "out")
    tables = build_lookups(spark, csv_dir, out)
    assert {name: df.count() for name, df in tables.items()} == {
        "music_history": 5, "user_history": 5, "song_playlist_session": 3,
    }
    assert rows(song_of_item(tables["music_history"], 137, 1)) == [("Band A", "Song 1", 200.5)]
    in_order = [tuple(r) for r in songs_of_session(tables["user_history"], 8, 137).collect()]
    assert [r[1] for r in in_order] == ["Song 1", "Song 2", "Song 1"]
    assert in_order[2] == ("Band B", "Song 1", "Ann", "Lee")
    # once per user, however often they played it
    assert rows(users_of_song(tables["song_playlist_session"], "Song 1")) == [("Ann", "Lee"), ("Bo", 'O"Ray')]


def test_consolidated_file(spark, csv_dir, tmp_path):
    build_lookups(spark, csv_dir, str(tmp_path / "out"), only=["music_history"])
    parts = list((tmp_path / "out" / "consolidated_csv").glob("*.csv"))
    text = parts[0].read_text().splitlines()
    assert text[0] == ",".join(f'"{c}"' for c in schemas.CONSOLIDATED_COLUMNS)
    assert all(line.startswith('"') and line.endswith('"') for line in text[1:])
    fields = [f for f in schemas.EVENT_CSV.fields if f.name in schemas.CONSOLIDATED_COLUMNS]
    fields.sort(key=lambda f: schemas.CONSOLIDATED_COLUMNS.index(f.name))
    back = read_csv(spark, str(tmp_path / "out" / "consolidated_csv"), type(schemas.EVENT_CSV)(fields))
    assert back.count() == 5
    assert back.filter("lastName = 'O\"Ray'").count() == 1


def test_the_last_row_of_a_key_stays(spark):
    schema = "artist string, firstName string, gender string, itemInSession int, lastName string, length double, level string, location string, sessionId int, song string, userId string"
    events = spark.createDataFrame(
        [
            ("B", "Old", "F", 1, "L", 1.0, "free", "T", 10, "S", "8"),
            ("B", "New", "F", 0, "L", 2.0, "free", "T", 11, "S", "8"),
            ("B", "Mid", "F", 2, "L", 3.0, "free", "T", 10, "S", "8"),
        ],
        schema,
    )
    tables = lookup_tables(events, song_length="float")
    assert rows(tables["song_playlist_session"]) == [("S", 8, "New", "L")]
    assert dict(tables["music_history"].dtypes)["song_length"] == "float"


def test_compressed_files_hold_the_same_rows(spark, csv_dir, tmp_path):
    events = read_csv(spark, csv_dir, schemas.EVENT_CSV)
    many = events
    for _ in range(6):
        many = many.union(many)
    for name, compression in (("plain", None), ("small", "gzip")):
        write_csv(many.coalesce(1), str(tmp_path / name), compression=compression)
    size = {name: sum(f.stat().st_size for f in (tmp_path / name).glob("*.csv*")) for name in ("plain", "small")}
    assert size["small"] < size["plain"] / 4
    assert rows(read_csv(spark, str(tmp_path / "small"), schemas.EVENT_CSV)) == rows(many)
