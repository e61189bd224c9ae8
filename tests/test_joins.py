import pytest
from conftest import rows
from pyspark.sql import functions as F

from tablewright.operators import filter_equal, filter_filled, filter_not_null, hot_keys, lookup_one, natural_join, project


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame(
        [(1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, None, "x"), (5, "a", None)], "id int, t string, n string"
    )
    right = spark.createDataFrame(
        [("a", "x", "S1"), ("a", "x", "S2"), ("c", "x", "S3"), (None, "x", "S4")], "title string, name string, sid string"
    )
    return left, right


ON = [("t", "title"), ("n", "name")]


def test_inner_fans_out_and_null_keys_never_match(sides):
    assert rows(natural_join(*sides, ON, take=["sid"]).select("id", "sid")) == [
        (1, "S1"), (1, "S2"), (2, "S1"), (2, "S2"),
    ]


def test_left_keeps_misses_and_null_keys(sides):
    assert rows(natural_join(*sides, ON, "left", ["sid"]).select("id", "sid")) == [
        (1, "S1"), (1, "S2"), (2, "S1"), (2, "S2"), (3, None), (4, None), (5, None),
    ]


def test_lookup_takes_the_smallest_match(sides):
    found = lookup_one(*sides, ON, ["sid"])
    assert rows(found.select("id", "sid")) == [(1, "S1"), (2, "S1"), (3, None), (4, None), (5, None)]


def test_all_columns_of_both_sides(sides):
    assert natural_join(*sides, ON).columns == ["id", "t", "n", "title", "name", "sid"]


def test_self_join(spark):
    df = spark.createDataFrame([(1, 1), (2, 1)], "id int, k int")
    assert natural_join(df, df, [("k", "k")], take=["id"]).count() == 4


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salting_changes_no_row(spark, how):
    """One key holds a third of the rows, another third has none; equal copies of rows are among them."""
    left = spark.range(6000).select(
        (F.col("id") % 50).alias("id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 100).alias("k"),
    )
    right = spark.range(120).select((F.col("id") % 60).alias("key"), F.col("id").alias("sid"))
    hot = hot_keys(left, ["k"], 0.2)
    assert len(hot) == 1
    salted = natural_join(left, right, [("k", "key")], how, ["sid"], hot)
    plain = left.join(right, left.k == right.key, how).select("id", "k", "sid")
    assert rows(salted) == rows(plain)


def test_salt_spreads_the_hot_key(spark):
    left = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("v"), F.lit(7).cast("bigint").alias("k"))
    right = spark.createDataFrame([(7, "S")], "key bigint, sid string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = natural_join(left, right, [("k", "key")], take=["sid"], hot=hot_keys(left, ["k"], 0.5))
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
    assert sum(sizes) == 4000
    assert len(sizes) > 1


def test_null_keys_can_pass_the_join_unshuffled(spark):
    left = spark.range(0, 4000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.col("id") % 5).alias("k"), "id")
    right = spark.range(5).select(F.col("id").alias("key"), F.col("id").cast("string").alias("sid"))
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(s) for s in settings]
    for s, value in zip(settings, ("-1", "false"), strict=True):
        spark.conf.set(s, value)
    try:
        joined = natural_join(left, right, [("k", "key")], "left", ["sid"], spread_nulls=True)
        nulls = [r[1] for r in joined.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()]
        plain = natural_join(left, right, [("k", "key")], "left", ["sid"])
        assert rows(joined) == rows(plain)
    finally:
        for s, value in zip(settings, before, strict=True):
            spark.conf.set(s, value)
    assert len(nulls) == 8
    assert max(nulls) <= 2 * min(nulls)


def test_hot_keys_finds_only_large_shares(spark):
    even = spark.range(10_000).select((F.col("id") % 1000).alias("k"))
    assert hot_keys(even, ["k"], 0.05) == []
    with pytest.raises(ValueError, match="at least"):
        hot_keys(even, ["k"], 0.0001)


def test_salted_keys_must_have_equal_types(spark):
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([(1,)], "key bigint")
    with pytest.raises(ValueError, match="equal types"):
        natural_join(left, right, [("k", "key")], hot=[1])
    with pytest.raises(ValueError, match="inner or left"):
        natural_join(left, right, [("k", "key")], how="full")


def test_filters_and_projection(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "x")], "a int, b string")
    assert rows(filter_filled(df, "b")) == [(3, "x")]
    assert rows(filter_not_null(df, "b")) == [(1, ""), (3, "x")]
    assert rows(filter_equal(df, a=1, b="")) == [(1, "")]
    assert project(df, {"id": "a", "two": F.col("a") * 2}).columns == ["id", "two"]
    assert project(df, ["b"]).columns == ["b"]


@pytest.mark.parametrize("salted", [False, True])
def test_rows_of_a_key_that_multiplies_come_out_side_by_side(spark, tmp_path, salted):
    """200 plays in a scattered order of a key with 200 matches, beside as many of others: a play's matches repeat in one order, so files stay small."""
    left = spark.range(4000).select("id", F.concat(F.lit("t"), F.pmod(F.xxhash64("id"), F.lit(20))).alias("t"))
    right = spark.range(4000).select(F.concat(F.lit("t"), F.pmod(F.xxhash64("id"), F.lit(20))).alias("title"), F.col("id").alias("sid"))
    hot = hot_keys(left, ["t"], 0.04) if salted else []
    joined = natural_join(left, right, [("t", "title")], take=["sid"], hot=hot, salts=4, side_by_side=True).select("id", "sid")
    plain = natural_join(left, right, [("t", "title")], take=["sid"]).select("id", "sid")
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    size = {}
    for name, df in (("sorted", joined), ("plain", plain)):
        df.coalesce(1).write.parquet(str(tmp_path / name))
        size[name] = sum(f.stat().st_size for f in (tmp_path / name).glob("*.parquet"))
    assert size["sorted"] < size["plain"] / 2
    assert spark.read.parquet(str(tmp_path / "sorted")).exceptAll(spark.read.parquet(str(tmp_path / "plain"))).isEmpty()
    assert joined.count() == plain.count() > 700_000
