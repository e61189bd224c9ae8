import pytest
from conftest import rows

from tablewright.sources import Release, current_release, drop_releases, read_release, write_table


def _write(spark, release, table, value):
    write_table(spark.range(3).selectExpr("id", f"'{value}' AS version"), release.path(table))


def _versions(spark, root):
    return {name: {r.version for r in df.collect()} for name, df in read_release(spark, root).items()}


def test_readers_see_one_version_between_all_steps(spark, tmp_path):
    root = str(tmp_path / "star")
    assert current_release(spark, root) is None
    with pytest.raises(FileNotFoundError):
        read_release(spark, root)
    seen = []
    for version in ("one", "two"):
        release = Release(spark, root)
        for table in ("plays", "songs"):
            _write(spark, release, table, version)
            seen.append(_versions(spark, root) if current_release(spark, root) else None)
        assert release.publish() == len(seen) // 2
        seen[-1] = (seen[-1], _versions(spark, root))
    one, two = ({"plays": {v}, "songs": {v}} for v in ("one", "two"))
    assert seen == [None, (None, one), one, (one, two)]


def test_a_table_that_is_not_written_stays_and_a_reader_keeps_its_version(spark, tmp_path):
    root = str(tmp_path / "star")
    first = Release(spark, root)
    _write(spark, first, "plays", "one")
    _write(spark, first, "songs", "one")
    first.publish()
    reader = read_release(spark, root)
    second = Release(spark, root)
    _write(spark, second, "plays", "two")
    second.publish()
    assert _versions(spark, root) == {"plays": {"two"}, "songs": {"one"}}
    assert {r.version for r in reader["plays"].collect()} == {"one"}
    left = Release(spark, root)
    _write(spark, left, "plays", "never published")
    drop_releases(spark, root, keep=1)
    assert _versions(spark, root) == {"plays": {"two"}, "songs": {"one"}}
    assert current_release(spark, root) == 2
    assert len([p for p in (tmp_path / "star" / "_versions").rglob("plays")]) == 1


def test_of_two_releases_at_once_one_stands(spark, tmp_path):
    root = str(tmp_path / "star")
    one, other = Release(spark, root), Release(spark, root)
    _write(spark, one, "plays", "one")
    _write(spark, other, "plays", "other")
    one.publish()
    with pytest.raises(RuntimeError, match="meanwhile"):
        other.publish()
    assert _versions(spark, root) == {"plays": {"one"}}
    assert [p.name for p in (tmp_path / "star" / "_releases").glob("[!.]*")] == ["0000000001.json"]
    for bad in ("", "a/b", "_x"):
        with pytest.raises(ValueError):
            one.path(bad)
    with pytest.raises(ValueError):
        drop_releases(spark, root, keep=0)


def _rows_read(df):
    """Rows that the scan of a plan without shuffles hands on, after it has run."""
    found = rows(df)
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return found, leaf.metrics().apply("numOutputRows").value()


def test_index_skips_row_groups(spark, tmp_path):
    # keys that lie in no order, so every file holds nearly their whole range
    table = spark.range(60_000).selectExpr("id AS day", "xxhash64(id) AS key")
    asked = table.where("day = 31234").first().key
    read = {}
    for name, index in (("plain", ()), ("indexed", ("key",))):
        write_table(table, str(tmp_path / name), cluster_by=["day"], files=110, index=index)
        assert len(list((tmp_path / name).glob("*.parquet"))) >= 100
        found, read[name] = _rows_read(spark.read.parquet(str(tmp_path / name)).where(f"key = {asked}").select("day"))
        assert found == [(31234,)]
    assert read["plain"] > 50_000 and read["indexed"] < 6_000
    size = {name: sum(p.stat().st_size for p in (tmp_path / name).glob("*.parquet")) for name in read}
    assert size["indexed"] - size["plain"] < 110 * 80_000
    with pytest.raises(ValueError, match="index"):
        write_table(table, str(tmp_path / "none"), index=["missing"])
