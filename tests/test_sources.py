from datetime import date

import pytest
from conftest import EVENTS, SONGS, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import schemas
from tablewright.operators import check_rejects, filter_filled, split_typed
from tablewright.sources import (
    create_table,
    dated_path,
    drop_table,
    load_table,
    publish_table,
    read_csv,
    read_csv_rejects,
    read_json,
    read_parquet,
    stage,
    write_bucketed,
    write_csv,
    write_table,
)
from tablewright.storage import list_files, stash


def test_json_by_glob_and_recursive_are_the_same(spark, song_dir, log_dir):
    glob = read_json(spark, f"{song_dir}/*/*/*/*.json", schemas.CATALOGUE)
    recursive = read_json(spark, song_dir, schemas.CATALOGUE, recursive=True)
    assert glob.count() == len(SONGS)
    assert rows(glob) == rows(recursive)
    log = read_json(spark, f"{log_dir}/*/*/*.json", schemas.EVENT_LOG)
    assert log.count() == len(EVENTS)
    assert log.filter("registration = 1512345678901.0").count() == len(EVENTS)
    assert log.select("userAgent").first()[0] == '"Agent/1.0 (X; Y)"'


def test_dated_path_is_padded(spark, log_dir):
    template = "{year}/{month}/{year}-{month}-{day}-events.json"
    assert dated_path(template, date(2018, 1, 5)) == "2018/01/2018-01-05-events.json"
    assert dated_path(template, date(2018, 1, 5), pad=False) == "2018/1/2018-1-5-events.json"
    day = read_json(spark, f"{log_dir}/{dated_path(template, date(2018, 11, 2))}", schemas.EVENT_LOG)
    assert day.count() == 2


def test_stage_with_mapping_replaces_the_target(spark, log_dir, tmp_path):
    schema = T.StructType([T.StructField("song_title", T.StringType()), T.StructField("ts", T.LongType())])
    target = str(tmp_path / "staged")
    for _ in range(2):
        staged = stage(
            spark, f"{log_dir}/*/*/*.json", schema, {"song_title": "song"}, target=target
        )
    assert staged.columns == ["song_title", "ts"]
    assert staged.count() == len(EVENTS)
    assert staged.filter("song_title = 'Twin'").count() == 1


def test_stage_by_name(spark, song_dir):
    staged = stage(spark, song_dir, schemas.CATALOGUE, recursive=True)
    assert staged.filter("song_id = 'S1' and artist_latitude = 1.5").count() == 1


HEAD = "artist,auth,firstName,gender,itemInSession,lastName,length,level,location,method,page,registration,sessionId,song,status,ts,userId"


@pytest.fixture
def csv_dir(tmp_path):
    folder = tmp_path / "events"
    folder.mkdir()
    (folder / "a.csv").write_text(
        f'{HEAD}\nBand A,Logged In,Ann,F,1,Lee,200.5,free,"Town, ST",PUT,NextSong,1.51235E+12,137,"Song ""1""",200,1.52468E+12,8\n'
        ",Logged In,Ann,F,0,Lee,,free,\"Town, ST\",GET,Home,1.51235E+12,137,,200,1.52468E+12,8\n"
    )
    (folder / "b.csv").write_text(f"{HEAD}\nBand B,Logged In,Bo,M,0,Ray,100.25,paid,Town,PUT,NextSong,1.5E+12,140,Twin,200,1.53E+12,9\n")
    return str(folder)


def test_csv_of_a_directory(spark, csv_dir):
    df = read_csv(spark, csv_dir, schemas.EVENT_CSV)
    assert df.count() == 3
    assert df.filter("ts = 1524680000000 and location = 'Town, ST' and song = 'Song \"1\"'").count() == 1
    assert filter_filled(df, "artist").count() == 2


def test_csv_header_must_fit_the_schema(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path), schema).collect()


def test_delimited_without_header_takes_the_first_line_as_data(spark, tmp_path):
    (tmp_path / "x.csv").write_text("City;Count\nHere;5\nThere;\n")
    schema = T.StructType([T.StructField("City", T.StringType()), T.StructField("Count", T.IntegerType())])
    assert rows(read_csv(spark, str(tmp_path), schema, sep=";")) == [("Here", 5), ("There", None)]
    assert rows(read_csv(spark, str(tmp_path), schema, sep=";", header=False)) == [
        ("City", None), ("Here", 5), ("There", None),
    ]


def test_quoted_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", x'), (2, "b")], "n int, t string")
    write_csv(df.coalesce(1), str(tmp_path / "out"), quote_all=True)
    (part,) = (tmp_path / "out").glob("*.csv")
    assert part.read_text().splitlines() == ['"n","t"', '"1","say ""hi"", x"', '"2","b"']
    assert rows(read_csv(spark, str(tmp_path / "out"), df.schema)) == rows(df)


def test_partitioned_write_replaces_all_or_touched(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("p"))
    write_table(df, path, partition_by=["p"])
    write_table(df.filter("p = 1").withColumn("id", F.col("id") + 1000), path, partition_by=["p"], touched_only=True)
    found = read_parquet(spark, path)
    assert found.count() == 100
    assert found.filter("id >= 1000").select("p").distinct().collect() == [(1,)]
    write_table(df.filter("p = 2"), path, partition_by=["p"])
    assert read_parquet(spark, path).select("p").distinct().collect() == [(2,)]


def test_null_partition_value_comes_back_as_null(spark, tmp_path):
    df = spark.createDataFrame([(1, 2018), (2, None)], "id int, year int")
    write_table(df, str(tmp_path / "t"), partition_by=["year"])
    assert rows(read_parquet(spark, str(tmp_path / "t")).select("id", "year")) == [(1, 2018), (2, None)]


def test_clustered_write_orders_files_and_splits_a_hot_key(spark, tmp_path):
    path = str(tmp_path / "t")
    hot = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("s"))
    # the rows are too few to fill several partitions of the usual size
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_table(hot, path, cluster_by=["k"], sort_by=["s"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    found = read_parquet(spark, path)
    assert rows(found) == rows(hot)
    files = found.select("k", F.input_file_name().alias("f"))
    assert files.filter("k = 7").select("f").distinct().count() > 1
    bounds = sorted(tuple(r)[1:] for r in files.groupBy("f").agg(F.min("k"), F.max("k")).collect())
    assert all(before[1] <= after[0] for before, after in zip(bounds, bounds[1:]))


def test_load_by_position(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    load_table(df, path, ["playid", "level"])
    load_table(df, path, ["playid", "level"])
    assert rows(read_parquet(spark, path)) == [(1, "a"), (1, "a")]
    load_table(df, path, ["userid", "level"], mode="truncate")
    assert read_parquet(spark, path).columns == ["userid", "level"]
    assert read_parquet(spark, path).count() == 1
    with pytest.raises(ValueError, match="target columns"):
        load_table(df, path, ["only"])
    with pytest.raises(ValueError, match="append or truncate"):
        load_table(df, path, ["a", "b"], mode="merge")


def test_catalog_table_life(spark):
    drop_table(spark, "plays")
    create_table(spark, "plays", schemas.STAR["users"])
    create_table(spark, "plays", schemas.STAR["users"])
    with pytest.raises(Exception, match="(?i)exists"):
        create_table(spark, "plays", schemas.STAR["users"], if_not_exists=False)
    load_table(spark.createDataFrame([("paid", 8)], "a string, b int"), "plays", ["level", "user_id"])
    load_table(spark.createDataFrame([("free", 9)], "a string, b int"), "plays", ["level", "user_id"])
    assert rows(spark.table("plays")) == [(8, None, None, None, "paid"), (9, None, None, None, "free")]
    load_table(spark.createDataFrame([(10,)], "b int"), "plays", ["user_id"], mode="truncate")
    assert rows(spark.table("plays")) == [(10, None, None, None, None)]
    with pytest.raises(ValueError, match="no columns"):
        load_table(spark.createDataFrame([(1,)], "b int"), "plays", ["nothing"])
    drop_table(spark, "plays")
    assert not spark.catalog.tableExists("plays")


def test_publish_refreshes_from_its_own_content(spark, tmp_path):
    base = str(tmp_path / "pub")
    publish_table(spark.range(3), "pub", base)
    publish_table(spark.table("pub").withColumn("id", F.col("id") + 10), "pub", base)
    assert rows(spark.table("pub")) == [(10,), (11,), (12,)]
    drop_table(spark, "pub")


def test_bucketed_join_needs_no_shuffle(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") * 2).alias("v"))
    write_bucketed(df, "left_t", ["id"], 4, path=str(tmp_path / "l"))
    write_bucketed(df.withColumnRenamed("v", "w"), "right_t", ["id"], 4, path=str(tmp_path / "r"))
    joined = spark.table("left_t").hint("merge").join(spark.table("right_t"), "id")
    assert joined.count() == 1000
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    drop_table(spark, "left_t")
    drop_table(spark, "right_t")


def test_csv_keeps_line_breaks_quotes_and_separators(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a\nb "c", d'), (2, "e\r\nf;"), (3, None), (4, ""), (5, "\\")], "id int, v string")
    for quote_all in (True, False):
        write_csv(df.coalesce(1), str(tmp_path / f"{quote_all}"), quote_all, records_per_file=2)
        assert len(list((tmp_path / f"{quote_all}").glob("*.csv"))) == 3
        back = read_csv(spark, str(tmp_path / f"{quote_all}"), df.schema)
        assert rows(back) == rows(df.replace({"": None}, subset=["v"]))


def test_fast_csv_reading_fails_on_a_broken_record(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb")], "id int, v string")
    write_csv(df, str(tmp_path / "out"))
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        read_csv(spark, str(tmp_path / "out"), df.schema, multiline=False).collect()


FAULTY = """id,name,n
1,a,5
2,b
x,c,7
5,f,9,extra
6,"li
ne",8
7,,
8,"q ""x"", y",many
,,
9,"open,1
"""
THREE = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("n", T.IntegerType())])


def test_records_that_do_not_fit_are_rejected(spark, tmp_path):
    (tmp_path / "a.csv").write_text(FAULTY)
    good, rejects = read_csv_rejects(spark, str(tmp_path), THREE)
    assert rows(good) == rows(spark.createDataFrame([(1, "a", 5), (6, "li\nne", 8), (7, None, None), (None, None, None)], THREE))
    found = {r.record: r.reasons for r in rejects.collect()}
    assert found == {
        "2,b": ["not 3 fields"],
        "x,c,7": ["id: no bigint"],
        "5,f,9,extra": ["not 3 fields"],
        '8,"q ""x"", y",many': ["n: no int"],
        '9,"open,1': ["not 3 fields"],
    }
    assert {r.file.rsplit("/", 1)[1] for r in rejects.collect()} == {"a.csv"}
    # what is read does not change what is rejected
    assert sorted(r[0] or "" for r in good.select("name").collect()) == ["", "", "a", "li\nne"]
    assert good.count() == 4
    assert rejects.count() == 5
    assert [tuple(r)[2:] for r in check_rejects(rejects, "a", 5).collect()] == [(True, "5 rejected")]
    strict, missing = read_csv_rejects(spark, str(tmp_path), THREE, required=["id"])
    assert strict.count() == 3
    assert missing.where("array_contains(reasons, 'id: missing')").count() == 1


def test_texts_split_by_their_types(spark):
    texts = spark.createDataFrame([("1", "2020-01-01", "x"), ("one", "2020-13-01", "y"), (None, None, "z")], "id string, day string, other string")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType())])
    good, rejects = split_typed(texts, schema)
    assert rows(good) == [(None, None), (1, date(2020, 1, 1))]
    assert [tuple(r) for r in rejects.collect()] == [("one", "2020-13-01", "y", ["id: no bigint", "day: no date"])]
    assert split_typed(texts.limit(0), schema)[1].count() == 0


def test_stashed_tables_are_compressed_whatever_the_session_says(spark, tmp_path):
    name = "spark.sql.parquet.compression.codec"
    before = spark.conf.get(name)
    spark.conf.set(name, "snappy")
    try:
        assert stash(spark.range(5), "numbers", str(tmp_path / "numbers")).count() == 5
    finally:
        spark.conf.set(name, before)
    files = list_files(spark, str(tmp_path / "numbers"))
    assert files and all(f.endswith(".zstd.parquet") for f in files)
