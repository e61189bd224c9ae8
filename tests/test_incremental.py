import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tablewright import streaming
from tablewright.functions import cast_or_null, from_epoch_millis
from tablewright.operators import dim_upsert
from tablewright.plans import PROFILES, star_tables
from tablewright.schemas import EVENT_LOG, STAR_COLUMNS
from tablewright.streaming import (
    AppendFact,
    IncrementalStar,
    UpsertDimension,
    compact_dimension,
    incremental_load,
    read_dimension,
    read_fact,
)


def users(staged):
    plays = staged.filter("page = 'NextSong'").withColumn("user_id", cast_or_null("userId", "int"))
    return plays.filter("user_id is not null")


USERS = UpsertDimension("users", ["user_id"], ["ts", "itemInSession"], ["firstName", "lastName"], ["level"], users)
PLAYS = AppendFact(
    "plays", lambda staged: staged.filter("page = 'NextSong'").select(from_epoch_millis("ts").alias("start_time"), "sessionId")
)


@pytest.fixture
def landing(tmp_path, log_dir):
    """A landing folder and a function that drops the records of some days there."""
    folder = tmp_path / "landing"
    folder.mkdir()
    from pathlib import Path

    days = {p.name[:10]: p.read_text() for p in Path(log_dir).rglob("*.json")}

    def drop(*names):
        for name in names:
            (folder / f"{name}.json").write_text(days[name])

    return str(folder), drop, days


def test_new_files_are_loaded_once(spark, landing, tmp_path):
    folder, drop, days = landing
    out = str(tmp_path / "out")

    def load():
        return incremental_load(spark, folder, EVENT_LOG, out, [PLAYS], [USERS], max_files=1)

    # the latest day first: arrival order does not matter
    drop("2018-12-31")
    assert load() == [0]
    assert load() == []
    drop("2018-11-01", "2018-11-02", "2018-11-03", "2018-11-04")
    assert load() == [1, 2, 3, 4]
    events = spark.read.schema(EVENT_LOG).json(folder)
    want = dim_upsert(users(events), USERS.key, USERS.order, USERS.keep_first, USERS.take_last)
    assert rows(read_dimension(spark, out, USERS)) == rows(want)
    assert read_fact(spark, out, "plays").count() == events.filter("page = 'NextSong'").count()

    for _ in range(2):
        compact_dimension(spark, out, USERS)
        assert rows(read_dimension(spark, out, USERS)) == rows(want)
    assert spark.read.parquet(f"{out}/users").select("batch").distinct().count() == 1
    late = json.loads(days["2018-12-31"].splitlines()[0]) | {"ts": 1_600_000_000_000, "level": "late", "firstName": "X"}
    (tmp_path / "landing" / "new.json").write_text(json.dumps(late))
    assert load() == [5]
    found = {r.user_id: (r.firstName, r.level) for r in read_dimension(spark, out, USERS).collect()}
    assert found[26] == ("First26", "late")
    compact_dimension(spark, out, USERS)
    assert {r.user_id: (r.firstName, r.level) for r in read_dimension(spark, out, USERS).collect()} == found


def test_a_batch_that_fails_midway_is_repeated_whole(spark, landing, tmp_path):
    folder, drop, _ = landing
    out = str(tmp_path / "out")
    drop("2018-11-01", "2018-11-02")

    def broken(staged):
        return staged.select(F.raise_error(F.lit("disk full")).cast("int").alias("user_id"), "*")

    bad = UpsertDimension("users", ["user_id"], ["ts"], ["firstName"], ["level"], broken)
    with pytest.raises(Exception, match="disk full"):
        incremental_load(spark, folder, EVENT_LOG, out, [PLAYS], [bad])
    # the fact of the failed batch is already there; the repeated batch replaces it
    assert incremental_load(spark, folder, EVENT_LOG, out, [PLAYS], [USERS]) == [0]
    assert read_fact(spark, out, "plays").count() == 4


def test_star_file_by_file(spark, landing, song_dir, events, songs, tmp_path):
    folder, drop, days = landing
    star = IncrementalStar(str(tmp_path / "star"))

    def load():
        return star.load(spark, song_dir, folder)

    drop("2018-12-31", "2018-11-01")
    assert load() == {"catalogue": [0], "log": [0]}
    assert load() == {"catalogue": [], "log": []}
    drop("2018-11-02", "2018-11-03", "2018-11-04")

    # plays are written before users: the batch that breaks off is run again whole
    healthy = star.users
    star.users = UpsertDimension(healthy.name, healthy.key, ["ts"], [], [], lambda rows: rows.select("ts", F.raise_error(F.lit("disk full")).cast("int").alias("user_id")))
    with pytest.raises(Exception, match="disk full"):
        load()
    star.users = healthy
    assert load() == {"catalogue": [], "log": [1]}

    want = star_tables(events, songs, "rowwise")
    for _ in range(2):
        for table, columns in STAR_COLUMNS.items():
            got = star.read(spark, table)
            assert got.columns == list(columns)
            drop_key = ["songplay_id"] if table == "songplays" else []
            assert rows(got.drop(*drop_key)) == rows(want[table].drop(*drop_key))
        plays = star.read(spark, "songplays")
        assert sorted(r[0] for r in plays.select("songplay_id").collect()) == list(range(1, plays.count() + 1))
        star.compact(spark)


def test_a_play_keeps_what_it_found(spark, landing, song_dir, tmp_path):
    folder, drop, days = landing
    empty = tmp_path / "songs"
    empty.mkdir()
    star = IncrementalStar(str(tmp_path / "star"))
    drop("2018-11-01")
    star.load(spark, str(empty), folder)
    from shutil import copytree

    copytree(song_dir, empty, dirs_exist_ok=True)
    (tmp_path / "landing" / "again.json").write_text(days["2018-11-01"])
    star.load(spark, str(empty), folder)
    found = star.read(spark, "songplays").orderBy("songplay_id").select("songplay_id", "song_id").collect()
    assert [tuple(r) for r in found] == [(1, None), (2, None), (3, "S2"), (4, "S1")]


def test_other_profiles_are_refused(tmp_path):
    for name in PROFILES:
        if name != "rowwise":
            with pytest.raises(ValueError, match="build_star"):
                IncrementalStar(str(tmp_path), name)


def test_public_names():
    assert all(hasattr(streaming, name) for name in streaming.__all__)


def test_star_loads_compressed_files(spark, events, songs, tmp_path):
    """Files that are compressed, beside others that are not."""
    folders = {}
    for name, df in (("songs", songs), ("logs", events)):
        folders[name] = str(tmp_path / name)
        df.coalesce(1).write.json(folders[name], compression="gzip")
    star = IncrementalStar(str(tmp_path / "out"))
    star.load(spark, folders["songs"], folders["logs"])
    assert star.read(spark, "songplays").count() == 8
    events.limit(1).coalesce(1).write.mode("append").json(folders["logs"])
    star.load(spark, folders["songs"], folders["logs"])
    assert star.read(spark, "songplays").count() == 9
