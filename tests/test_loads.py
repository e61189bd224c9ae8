"""Keys over several loads, upserts into files, and roll-ups that grow."""

import json

from conftest import rows
from pyspark.sql import functions as F

from tablewright.plans import lake
from tablewright.sources import KeyHistory, ledger, upsert_files, write_table
from tablewright.streaming import RollUp, compact_rollup, incremental_load, read_rollup


def test_keys_repeated_over_loads(spark, tmp_path):
    history = KeyHistory(spark, str(tmp_path / "keys"), ["a", "b"])
    first = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    second = spark.createDataFrame([(2, None), (3, "y")], "a int, b string")
    for _ in range(2):
        # a load does not meet itself
        assert rows(history.repeated(first, "one")) == [(1, "x", 2, False)]
        history.record(first, "one")
    assert rows(history.repeated(second, "two")) == [(2, None, 1, True)]
    assert [tuple(r)[2:] for r in history.check(second, "two", "t").collect()] == [(False, "1 repeated keys")]
    history.record(second, "two")
    assert history.repeated(second.limit(0), "three").count() == 0
    assert [tuple(r)[2:] for r in history.check(second.where("a = 4"), "three", "t").collect()] == [(True, "0 repeated keys")]


def test_only_files_with_changed_keys_are_rewritten(spark, tmp_path):
    root, schema = str(tmp_path), "k long, at long, v string"
    base = spark.range(8000).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("at"), F.lit("old").alias("v"))
    write_table(base.repartitionByRange(8, "k"), f"{root}/t")
    before = set(ledger.list_files(spark, f"{root}/t"))
    assert len(before) == 8
    changes = spark.createDataFrame([(10, 2, "new"), (10, 1, "older"), (11, 0, "late"), (9000, 1, "added"), (12, 2, None)], schema)
    replaced = upsert_files(spark, root, "t", changes, ["k"], ["at"], load="monday")
    after = set(ledger.list_files(spark, f"{root}/t"))
    assert len(replaced) == 1
    assert before - after == set(replaced)
    read = spark.read.parquet(f"{root}/t")
    assert read.count() == 8001
    # of changes to one key the last wins, one older than the row does not; a NULL overwrites
    assert rows(read.where("v is null or v <> 'old'")) == [(10, 2, "new"), (12, 2, None), (9000, 1, "added")]
    # the same load again reads and writes nothing
    assert upsert_files(spark, root, "t", changes, ["k"], ["at"], load="monday") == []
    assert set(ledger.list_files(spark, f"{root}/t")) == after
    # new keys only: no file is touched
    assert upsert_files(spark, root, "t", changes.limit(0).union(spark.createDataFrame([(9001, 1, "z")], schema)), ["k"], ["at"]) == []
    assert spark.read.parquet(f"{root}/t").count() == 8002


def test_an_upsert_that_breaks_off_is_finished(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    rows_ = spark.createDataFrame([(k, 1, "old") for k in range(20)], "k long, at long, v string")
    upsert_files(spark, root, "t", rows_, ["k"], ["at"])
    changes = spark.createDataFrame([(3, 2, "new")], rows_.schema)

    def fails(*_):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        # the new files are in place, the old ones not gone
        patch.setattr(ledger, "remove_path", fails)
        try:
            upsert_files(spark, root, "t", changes, ["k"], ["at"], load="x")
            raise AssertionError("the load did not break off")
        except OSError:
            pass
    upsert_files(spark, root, "t", changes, ["k"], ["at"], load="x")
    read = spark.read.parquet(f"{root}/t")
    assert read.count() == 20
    assert [r.v for r in read.where("k = 3").collect()] == ["new"]


def test_roll_up_over_batches(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()
    rollup = RollUp("sums", ["k"], averages=["x"], sums=["y"])

    def drop(name, *values):
        (landing / f"{name}.json").write_text("".join(json.dumps(dict(zip("kxy", v, strict=True))) + "\n" for v in values))
        return incremental_load(spark, str(landing), "k string, x double, y long", out, rollups=[rollup])

    assert drop("a", ("a", 1.0, 1), ("a", None, 2), ("b", None, None)) == [0]
    assert drop("b", ("a", 4.0, 4), (None, 2.0, 1)) == [1]
    want = [(None, 2.0, 1), ("a", 2.5, 7), ("b", None, None)]
    for _ in range(2):
        assert rows(read_rollup(spark, out, rollup)) == want
        compact_rollup(spark, out, rollup)
    # old folders that a broken compaction leaves do not count
    spark.createDataFrame([("a", 9.0, 9, 9)], "k string, sum_x double, sum_y long, n_x long").write.parquet(f"{out}/sums/batch=1")
    assert rows(read_rollup(spark, out, rollup)) == want
    assert drop("c", ("b", 3.0, 3)) == [2]
    assert rows(read_rollup(spark, out, rollup)) == [(None, 2.0, 1), ("a", 2.5, 7), ("b", 3.0, 3)]


def test_readers_of_a_lake_see_one_version(spark, tmp_path, monkeypatch):
    """The old tables stay whole until every new one is written."""
    out = str(tmp_path)
    tables = lambda n: {name: spark.range(n).withColumn("name", F.lit(name)) for name in ("one", "two")}
    monkeypatch.setattr(lake, "PARTITIONS", {})
    monkeypatch.setattr(lake, "lake_tables", lambda *_: tables(3))
    lake.build_lake(spark, None, None, None, out)
    seen, write = [], lake.write_table

    def watched(df, path, *args, **options):
        write(df, path, *args, **options)
        seen.append({name: spark.read.parquet(f"{out}/{name}").count() for name in ("one", "two")})

    monkeypatch.setattr(lake, "write_table", watched)
    monkeypatch.setattr(lake, "lake_tables", lambda *_: tables(5))
    report = lake.build_lake(spark, None, None, None, out)
    assert seen == [{"one": 3, "two": 3}] * 2
    assert all(r.passed for r in report.collect())
    assert spark.read.parquet(f"{out}/two").count() == 5
