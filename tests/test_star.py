"""All profiles on one fixture; they differ as documented on ``StarProfile``."""

from dataclasses import replace
from datetime import datetime
from hashlib import md5

import pytest
from conftest import EVENTS, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright import schemas
from tablewright.operators import check_sql, hot_keys
from tablewright.plans import PROFILES, build_star, check_star, star, star_tables
from tablewright.registry.derived import event_log
from tablewright.sources import ledger, read_json, register_views

ALL = list(schemas.STAR_COLUMNS)
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(events, songs):
    return {name: star_tables(events, songs, name, number_in_order=True) for name in PROFILES}


def test_columns(tables):
    for name, star in tables.items():
        for table in ALL:
            extra = ["year", "month"] if (name, table) == ("lake", "songplays") else []
            assert star[table].columns == [*schemas.STAR_COLUMNS[table], *extra]


def found(star):
    return rows(star["songplays"].select("session_id", "song_id", F.col("start_time").cast("string")))


def test_fact_of_rowwise_keeps_misses_and_takes_one_song(tables):
    assert found(tables["rowwise"]) == sorted(
        [
            (137, "S1", "2018-11-01 21:07:13.457"),
            (137, "S2", "2018-11-01 21:07:13.1"),
            (182, None, "2018-11-02 01:00:00"),
            (182, None, "2018-11-02 02:00:00"),
            (183, "S3", "2018-11-03 03:00:00"),
            (183, "S1", "2018-12-31 23:59:59.999"),
            (50, "S1", "2018-11-04 00:00:00"),
            (51, "S1", "2018-11-04 00:00:05"),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_fact_of_warehouse_keeps_matches_only_and_fans_out(tables):
    want = [
        (137, "S1", "2018-11-01 21:07:13"),
        (137, "S2", "2018-11-01 21:07:13"),
        (182, "S1", "2018-11-02 01:00:00"),
        (183, "S1", "2018-12-31 23:59:59"),
        (183, "S3", "2018-11-03 03:00:00"),
        (183, "S4", "2018-11-03 03:00:00"),
        (50, "S1", "2018-11-04 00:00:00"),
        (51, "S1", "2018-11-04 00:00:05"),
    ]
    assert found(tables["warehouse"]) == want
    # plays without a user are dropped here
    assert found(tables["lake"]) == want[:6]


def test_fact_of_scheduled_matches_length_too(tables):
    plays = found(tables["scheduled"])
    assert len(plays) == 8
    assert (182, None, "2018-11-02 01:00:00") in plays
    assert (183, "S3", "2018-11-03 03:00:00") in plays
    assert not [p for p in plays if p[1] == "S4"]


def test_keys(tables):
    def ids(name):
        return sorted(r[0] for r in tables[name]["songplays"].select("songplay_id").collect())

    assert ids("rowwise") == list(range(1, 9))
    assert ids("warehouse") == list(range(8))
    assert len(set(ids("lake"))) == 6
    # two plays of one session and second share a content key
    twice = md5(b"1372018-11-01 21:07:13").hexdigest()
    assert ids("scheduled").count(twice) == 2
    assert len(set(ids("scheduled"))) == 7


def test_more_key_columns_make_content_keys_unique(events, songs):
    profile = replace(PROFILES["scheduled"], key_columns=("session_id", "start_time", "song_id"))
    keys = star_tables(events, songs, profile, only=["songplays"])["songplays"]
    known = keys.filter("song_id is not null")
    assert known.select("songplay_id").distinct().count() == known.count()


def test_users(tables):
    def users(name):
        return rows(tables[name]["users"].select("user_id", "level"))

    # the latest level stays, rows without user id are left out
    assert users("rowwise") == [(10, "paid"), (26, "paid"), (8, "free")]
    versions = [(10, "free"), (10, "paid"), (26, "free"), (26, "paid"), (8, "free")]
    # a user seen on another page counts
    assert users("warehouse") == sorted([*versions, (41, "free")], key=str)
    assert users("lake") == [(str(u), level) for u, level in versions]
    # not filtered: plays without user give a row each way of naming nobody
    assert users("scheduled") == [(None, "free"), (None, "free"), *versions]


def test_songs(tables):
    def songs(name):
        return rows(tables[name]["songs"].select("song_id", "title"))

    known = [("S1", "Song 1"), ("S2", "Song 2"), ("S3", "Twin"), ("S4", "Twin"), ("S5", "Repeat")]
    live = ("S5", "Repeat (live)")
    assert songs("rowwise") == known
    assert songs("warehouse") == songs("lake") == [*known, live]
    assert songs("scheduled") == [(None, "Untitled"), *known, live]


def test_warehouse_songs_are_not_deduplicated(events, songs):
    twice = songs.union(songs)
    assert star_tables(events, twice, "warehouse", only=["songs"])["songs"].count() == 12
    assert star_tables(events, twice, "lake", only=["songs"])["songs"].count() == 6


def test_artists(tables):
    def places(name):
        return rows(tables[name]["artists"].filter("artist_id = 'A1'").select("location", "latitude"))

    # the second song's place replaces the first, its missing latitude too
    assert places("rowwise") == [("New Town", None)]
    for name in ("warehouse", "lake", "scheduled"):
        assert places(name) == [("New Town", None), ("Old Town", 1.5)]


def test_time(tables):
    counts = {name: star["time"].count() for name, star in tables.items()}
    # rowwise and scheduled keep a row per play; the others one per different second
    assert counts == {"rowwise": 8, "warehouse": 6, "lake": 5, "scheduled": 8}
    kinds = {name: dict(star["time"].dtypes) for name, star in tables.items()}
    assert [kinds[n]["month"] for n in PROFILES] == ["string", "string", "int", "string"]
    monday = {
        name: star["time"].filter("day = 31").select("start_time", "week", "weekday").first() for name, star in tables.items()
    }
    assert [tuple(monday[n])[1:] for n in PROFILES] == [(1, "0"), (1, "1"), (1, 2), (1, "1")]
    assert monday["rowwise"].start_time == datetime(2018, 12, 31, 23, 59, 59, 999000)
    assert monday["lake"].start_time == datetime(2018, 12, 31, 23, 59, 59)


def test_start_time_as_text(events, songs):
    profile = replace(PROFILES["lake"], start_time_text=True)
    star = star_tables(events, songs, profile, only=["songplays", "time"])
    assert dict(star["time"].dtypes)["start_time"] == "string"
    assert star["songplays"].filter("start_time = '2018-11-03 03:00:00'").count() == 2


def test_whole_numbers_compare_whole_seconds(events, songs):
    """With scale-0 staging 100.25 and 100.75 are the same length."""
    profile = replace(PROFILES["scheduled"], whole_numbers=True)
    star = star_tables(events, songs, profile, only=["songplays", "songs"])
    assert star["songplays"].filter("session_id = 183 and song_id in ('S3', 'S4')").count() == 2
    assert dict(star["songs"].dtypes)["duration"] == "decimal(18,0)"


def test_salted_match_gives_the_same_fact(events, songs):
    hot = hot_keys(events, ["song", "artist"], 0.3)
    assert hot
    plain = star_tables(events, songs, "lake", only=["songplays"])["songplays"].drop("songplay_id")
    salted = star_tables(events, songs, "lake", only=["songplays"], hot=hot)["songplays"].drop("songplay_id")
    assert rows(salted) == rows(plain)


@pytest.mark.parametrize("name", list(PROFILES))
def test_build_writes_what_the_tables_hold(spark, log_dir, song_dir, tables, tmp_path, name):
    events = read_json(spark, f"{log_dir}/*/*/*.json", schemas.EVENT_LOG)
    songs = read_json(spark, song_dir, schemas.CATALOGUE, recursive=True)
    for _ in range(2):
        report = build_star(spark, events, songs, str(tmp_path), name, hot_share=0.3)
    profile = PROFILES[name]
    for table in ALL:
        written = spark.read.parquet(f"{tmp_path}/{table}")
        columns = list(profile.columns[table])
        want = tables[name][table].toDF(*columns, *tables[name][table].columns[len(columns) :])
        if table == "songplays" and profile.key != "md5":
            columns = columns[1:]
            assert written.select(profile.columns[table][0]).distinct().count() == want.count()
        assert rows(written.select(*columns)) == rows(want.select(*columns))
    checks = {(r.table_name, r.check_name.split("(")[0]): r.passed for r in report.collect()}
    assert all(checks[table, "non_empty"] for table in ALL)
    # the declared keys do not hold where the rules keep several rows per key
    assert checks["users", "unique_key"] == (profile.users == "upsert")
    # the plays are apart by milliseconds, but not all by seconds
    assert checks["time", "unique_key"] == (name != "scheduled")
    assert checks["songplays", "unique_key"] == (name != "scheduled")


def test_lake_is_partitioned(spark, events, songs, tmp_path):
    build_star(spark, events, songs, str(tmp_path), "lake")
    assert sorted(p.name for p in (tmp_path / "songplays").glob("year=*")) == ["year=2018"]
    assert sorted(p.name for p in (tmp_path / "time" / "year=2018").glob("month=*")) == ["month=11", "month=12"]
    assert sorted(p.name for p in (tmp_path / "songs").glob("year=*")) == ["year=0", "year=1999"]


def test_fact_of_lake_is_written_as_the_join_gives_it(spark, events, songs, tmp_path):
    """Rows of the fact are neither shuffled nor sorted, plays without a time or with repeated songs included."""
    undated = events.where("song = 'Song 1'").withColumn("ts", F.lit(None).cast("long"))
    log, many = events.union(undated), songs.union(songs)
    dated, rest = star.fact_by_month(log, many, PROFILES["lake"])
    want = rows(star_tables(log, many, "lake", only=["songplays"])["songplays"].drop("songplay_id"))
    assert rows(dated.union(rest).drop("songplay_id")) == want
    assert rest.count() > 0 and rest.where("start_time IS NOT NULL").isEmpty()
    plan = dated.sortWithinPartitions("year", "month")._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("SortMergeJoin")]
    assert "Sort " not in above and "Exchange" not in above
    report = build_star(spark, log, many, str(tmp_path), "lake").where("table_name = 'songplays'")
    written = spark.read.parquet(str(tmp_path / "songplays"))
    assert rows(written.select(*dated.columns).drop("songplay_id")) == want
    assert written.select("songplay_id").distinct().count() == len(want)
    assert {r.check_name: r.detail for r in report.collect()}["non_empty"] == f"{len(want)} rows"


def test_checks_of_written_tables(spark, events, songs, tmp_path):
    build_star(spark, events, songs, str(tmp_path), "scheduled")
    report = {(r.table_name, r.check_name): r.passed for r in check_star(spark, str(tmp_path), "scheduled", limits=True).collect()}
    assert report["songplays", "not_null(playid)"]
    assert not report["users", "not_null(userid)"]
    assert not report["songs", "not_null(songid)"]
    assert report["songs", "not_null(title)"]
    assert report["users", "length(level<=4)"]
    register_views(spark, str(tmp_path), ALL)
    checks = [(f"SELECT count(*) FROM {table} WHERE {profile_key} IS NULL", 0) for table, profile_key in (
        ("users", "userid"), ("songs", "songid"), ("artists", "artistid"), ("songplays", "playid"), ("time", "start_time"),
    )]
    assert [r.passed for r in check_sql(spark, checks).collect()] == [False, False, True, True, True]


def test_failed_checks_raise_together(spark, events, songs, tmp_path):
    with pytest.raises(ValueError) as error:
        build_star(spark, events, songs, str(tmp_path), "warehouse", check=True)
    assert "users: unique_key(user_id)" in str(error.value)
    assert "artists: unique_key(artist_id)" in str(error.value)


def test_appending_load_continues_keys_and_upserts(spark, events, songs, tmp_path):
    early, late = events.filter("ts < 1541203200000"), events.filter("ts >= 1541203200000")
    assert early.count() + late.count() == len(EVENTS)
    out = str(tmp_path)
    build_star(spark, early, songs, out, "rowwise", fresh=False)
    first = spark.read.parquet(f"{out}/songplays").count()
    changed = late.withColumn("level", F.when(F.col("userId") == "26", F.col("level")).otherwise("gone"))
    back = events.filter("userId = '10'").limit(1).withColumn("level", F.lit("again")).withColumn("firstName", F.lit("New"))
    build_star(spark, changed.union(back), songs, out, "rowwise", fresh=False)
    plays = spark.read.parquet(f"{out}/songplays")
    assert sorted(r[0] for r in plays.select("songplay_id").collect()) == list(range(1, plays.count() + 1))
    assert plays.count() == first + 5
    users = {r.user_id: (r.first_name, r.level) for r in spark.read.parquet(f"{out}/users").collect()}
    assert users == {8: ("First8", "free"), 10: ("First10", "again"), 26: ("First26", "paid")}
    assert spark.read.parquet(f"{out}/songs").count() == 5
    assert spark.read.parquet(f"{out}/time").count() == plays.count()


@pytest.fixture(scope="module")
def halves(spark, events, songs, tmp_path_factory):
    """A star of two loads, each run once."""
    out = str(tmp_path_factory.mktemp("halves"))
    for part in (events.filter("sessionId < 183"), events.filter("sessionId >= 183")):
        build_star(spark, part, songs, out, "rowwise", fresh=False)
    return out


def test_repeated_loads_change_nothing(spark, events, songs, halves, tmp_path):
    out = str(tmp_path)
    for part in (events.filter("sessionId < 183"), events.filter("sessionId >= 183")):
        for _ in range(2):
            report = build_star(spark, part, songs, out, "rowwise", fresh=False)
    for table in ALL:
        assert rows(spark.read.parquet(f"{out}/{table}")) == rows(spark.read.parquet(f"{halves}/{table}"))
    assert ledger.records(spark, out) == ledger.records(spark, halves)
    assert len(ledger.records(spark, out)) == 2
    # what was counted while writing is what a scan counts
    assert rows(report) == rows(check_star(spark, out, "rowwise"))


def test_distinct_dimensions_take_only_rows_they_lack(spark, events, songs, tmp_path):
    out, whole = str(tmp_path / "halves"), str(tmp_path / "whole")
    for part in (events.filter("sessionId < 183"), events.filter("sessionId >= 183")):
        build_star(spark, part, songs, out, "warehouse", fresh=False)
    build_star(spark, events, songs, whole, "warehouse")
    for table in ("users", "artists"):
        assert rows(spark.read.parquet(f"{out}/{table}")) == rows(spark.read.parquet(f"{whole}/{table}"))


def test_same_rows_under_another_name_are_a_load_of_their_own(spark, events, songs, tmp_path):
    out = str(tmp_path)
    for name in ("monday", "tuesday", "monday"):
        build_star(spark, events, songs, out, "rowwise", fresh=False, load=name)
    plays = spark.read.parquet(f"{out}/songplays")
    assert sorted(r[0] for r in plays.select("songplay_id").collect()) == list(range(1, 17))
    assert [r["load"] for r in ledger.records(spark, out)] == ["monday", "tuesday"]
    build_star(spark, events, songs, out, "rowwise")
    assert spark.read.parquet(f"{out}/songplays").count() == 8
    assert len(ledger.records(spark, out)) == 1


@pytest.mark.parametrize("step", ["write", "rename", "record"])
def test_a_load_that_breaks_off_is_finished_or_leaves_nothing(spark, events, songs, halves, tmp_path, monkeypatch, step):
    out, whole = str(tmp_path / "broken"), halves
    early, late = events.filter("sessionId < 183"), events.filter("sessionId >= 183")
    build_star(spark, early, songs, out, "rowwise", fresh=False)
    before = {t: rows(spark.read.parquet(f"{out}/{t}")) for t in ALL}
    calls = []

    def fails(*_, **__):
        calls.append(1)
        if step != "rename" or len(calls) == 2:
            raise OSError("gone")
        return real(*_, **__)

    place = {"write": (star, "write_table"), "rename": (ledger, "replace_path"), "record": (ledger, "write_small")}[step]
    real = getattr(*place)
    if step == "record":
        # the first small file says that all tables are complete, the second is the ledger's record
        def fails(spark_, path, text):
            if "/_ledger/" in path:
                raise OSError("gone")
            real(spark_, path, text)

    with monkeypatch.context() as patch:
        patch.setattr(*place, fails)
        with pytest.raises(OSError, match="gone"):
            build_star(spark, late, songs, out, "rowwise", fresh=False)
    if step == "write":
        assert {t: rows(spark.read.parquet(f"{out}/{t}")) for t in ALL} == before
    build_star(spark, late, songs, out, "rowwise", fresh=False)
    for table in ALL:
        drop = ["songplay_id"] if table == "songplays" else []
        assert rows(spark.read.parquet(f"{out}/{table}").drop(*drop)) == rows(spark.read.parquet(f"{whole}/{table}").drop(*drop))
    assert not ledger.list_folders(spark, f"{out}/_loads")


def test_checks_of_a_load_scan_each_table_once(spark, events, songs, tmp_path):
    report = build_star(spark, events, songs, str(tmp_path), "rowwise")
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == len(ALL)
    assert rows(report) == rows(check_star(spark, str(tmp_path), "rowwise"))


def test_different_times_of_matched_plays_need_no_row_per_match(spark, events, songs):
    """The catalogue five times over: the times stay the same, and the plan keeps plays as they are instead of multiplying them."""
    many = songs
    for _ in range(4):
        many = many.union(songs)
    whole = star_tables(events, many, "warehouse", only=["songplays", "time"])["time"]
    alone = star_tables(events, many, "warehouse", only=["time"])["time"]
    assert rows(alone) == rows(whole) and alone.count() == 6
    assert "LeftSemi" in alone._jdf.queryExecution().optimizedPlan().toString()


def test_event_log_joins_orders_with_customers_before_line_items(spark):
    plan = event_log(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {key: next(line.index("Join") for line in plan if "Join" in line and f"({key}#" in line) for key in ("l_orderkey", "o_custkey")}
    assert depth["o_custkey"] > depth["l_orderkey"]


def test_a_retried_load_does_not_derive_its_rows_again(spark, monkeypatch):
    from importlib import import_module

    registry, plans = import_module("tablewright.registry.star"), []
    build = registry.build_star

    def seen(spark, rows, *rest, **options):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return build(spark, rows, *rest, **options)

    monkeypatch.setattr(registry, "build_star", seen)
    assert import_module("tablewright.registry").QUERIES["star_rowwise_reloaded"](spark, SF_DIR).count() > 0
    assert len(plans) == 4 and not any("Join" in plan for plan in plans)


def many_matches(events, songs):
    """Plays of every title many times over, equal ones, ones in one second, without a time, and without a title; songs twice over."""
    twin = events.where("song = 'Twin'")
    later = twin.withColumn("after", F.explode(F.sequence(F.lit(1000), F.lit(20000), F.lit(1000)))).withColumn("ts", F.col("ts") + F.col("after")).drop("after")
    log = events.unionAll(twin).unionAll(later).unionAll(events.withColumn("location", F.lit("Else")))
    log = log.unionAll(events.withColumn("ts", F.lit(None).cast("long"))).unionAll(events.withColumn("song", F.lit(None).cast("string")))
    return log, songs.unionAll(songs).unionAll(songs.withColumn("song_id", F.concat(F.lit("X"), "song_id")))


def numbered_by_a_window(log, songs):
    """The fact numbered by one window over all rows."""
    plain = star_tables(log, songs, "warehouse", only=["songplays"])["songplays"].drop("songplay_id")
    return plain.withColumn("songplay_id", F.row_number().over(Window.orderBy(*star.FACT_ORDER)) - 1)


def test_fact_in_order_sorts_plays_not_rows(spark, events, songs):
    log, many = many_matches(events, songs)
    numbered = star_tables(log, many, "warehouse", only=["songplays"], number_in_order=True)["songplays"]
    want = numbered_by_a_window(log, many)
    assert rows(numbered) == rows(want.select(*numbered.columns)) and numbered.count() > 100
    later = star_tables(log, many, "warehouse", only=["songplays"], number_in_order=True, key_start=7)["songplays"]
    assert rows(later.select("songplay_id")) == rows(want.select(F.col("songplay_id") + 7))
    # no play shares its place: rows come from the join as they are
    apart = star._fact_in_order(star._slim(star._typed_events(events, PROFILES["warehouse"])), songs, PROFILES["warehouse"], 0)
    plan = apart._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan and apart.count() == 8


@pytest.mark.parametrize("share", [200_000, 3])
def test_fact_of_warehouse_is_numbered_song_by_song(spark, events, songs, tmp_path, monkeypatch, share):
    """Rows of the fact are neither shuffled nor sorted; those of a song lie and are numbered in a row, by time."""
    monkeypatch.setattr(star, "SHARE_PLAYS", share)
    log, many = many_matches(events, songs)
    fact, multiplied = star.fact_by_song(log, many, PROFILES["warehouse"])
    assert multiplied and not star.fact_by_song(events, songs, PROFILES["warehouse"])[1]
    want = rows(star_tables(log, many, "warehouse", only=["songplays"])["songplays"].drop("songplay_id"))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("SortMergeJoin")]
    assert "Sort " not in above and "Exchange" not in above
    report = build_star(spark, log, many, str(tmp_path), "warehouse").where("table_name = 'songplays'")
    written = spark.read.parquet(str(tmp_path / "songplays"))
    assert rows(written.drop("songplay_id").select(*schemas.STAR_COLUMNS["songplays"][1:])) == rows(fact.drop("songplay_id")) == want
    assert sorted(r[0] for r in written.select("songplay_id").collect()) == list(range(len(want)))
    assert {r.check_name: r.passed for r in report.collect()}["unique_key(songplay_id)"]
    if share > 3:
        lies = written.where("song_id = 'XS4'").select("songplay_id", "start_time").orderBy("songplay_id").collect()
        assert [r.songplay_id for r in lies] == list(range(lies[0].songplay_id, lies[0].songplay_id + len(lies))) and len(lies) > 20
        times = [str(r.start_time or "") for r in lies]
        assert times == sorted(times)


def test_multiplied_fact_is_read_by_song_without_its_other_rows(spark, events, songs, tmp_path):
    """What the join gives is written in less than a byte a row for its numbers, and a read of one song skips the pages of others."""
    plays = spark.range(0, 60, 1, 4).select(F.col("id").alias("n"))
    log = events.where("song = 'Song 1' AND userId = '8'").crossJoin(plays).withColumn("ts", F.col("ts") + F.col("n") * 60_000).drop("n")
    many = songs.where("song_id = 'S1'").crossJoin(spark.range(0, 4000, 1, 4)).withColumn("song_id", F.concat(F.lit("S"), "id")).drop("id")
    build_star(spark, log, many, str(tmp_path), "warehouse")
    path = str(tmp_path / "songplays")
    table = spark.read.parquet(path)
    assert table.count() == 240_000
    assert sum(f.stat().st_size for f in (tmp_path / "songplays").glob("*.parquet")) < 240_000
    one = table.where("song_id = 'S77'")
    assert one.count() == 60
    found = one.select("songplay_id")
    found.collect()

    def scanned(node):
        metrics = node.metrics()
        return (metrics.apply("numOutputRows").value() if metrics.contains("numOutputRows") and "Scan" in node.nodeName() else 0) + sum(
            scanned(node.children().apply(i)) for i in range(node.children().size())
        )

    plan = found._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    assert 60 <= scanned(plan) < 60_000


def test_second_load_of_a_warehouse_goes_on_with_multiplied_rows(spark, events, songs, tmp_path):
    log, many = many_matches(events, songs)
    for part in (log.where("sessionId < 183"), log.where("sessionId >= 183")):
        for _ in range(2):
            build_star(spark, part, many, str(tmp_path), "warehouse", fresh=False)
    written = spark.read.parquet(str(tmp_path / "songplays"))
    want = rows(star_tables(log, many, "warehouse", only=["songplays"])["songplays"].drop("songplay_id"))
    assert rows(written.select(*schemas.STAR_COLUMNS["songplays"][1:])) == want
    assert sorted(r[0] for r in written.select("songplay_id").collect()) == list(range(len(want)))


def test_calendar_of_a_multiplied_fact_is_taken_from_its_plays(spark, events, songs, tmp_path, monkeypatch):
    """The times were read back from the fact, which holds many rows a play."""
    log, many = many_matches(events, songs)
    sources = []

    def noted(source, *options):
        sources.append(source._jdf.queryExecution().optimizedPlan().toString())
        return calendar(source, *options)

    calendar = star.calendar
    monkeypatch.setattr(star, "calendar", noted)
    out = str(tmp_path / "star")
    star.build_star(spark, log, many, out, "warehouse")
    assert len(sources) == 1 and "LeftSemi" in sources[0]
    times = spark.read.parquet(f"{out}/songplays").select("start_time").distinct()
    # the calendar has no row for plays without a time
    assert rows(times.dropna()) == rows(spark.read.parquet(f"{out}/time").select("start_time").dropna()) and times.count() > 2
