import random
from datetime import date, datetime

from conftest import rows

from tablewright.operators import (
    calendar,
    calendar_union,
    concat_rows,
    dim_distinct,
    dim_first,
    dim_upsert,
    last_wins,
    roll_up,
    row_counts,
    table_upsert,
)

SEEN = [
    # key, order, name, level
    (1, 10, "Ann", "free"),
    (1, 30, "Anna", None),
    (1, 20, "Anne", "paid"),
    (2, 10, None, "paid"),
    (2, 20, "Bo", "free"),
    (None, 5, "Nobody", "free"),
]


def seen(spark):
    return spark.createDataFrame(SEEN, "k int, o int, name string, level string")


def test_distinct_keeps_versions(spark):
    df = seen(spark)
    assert rows(dim_distinct(df.union(df), ["k", "level"], not_null=["k"])) == [
        (1, None), (1, "free"), (1, "paid"), (2, "free"), (2, "paid"),
    ]


def test_first_wins(spark):
    assert rows(dim_first(seen(spark), ["k"], ["o"], ["k", "name", "level"])) == [
        (None, "Nobody", "free"), (1, "Ann", "free"), (2, None, "paid"),
    ]


def test_upsert_keeps_some_columns_and_a_null_overwrites(spark):
    assert rows(dim_upsert(seen(spark), ["k"], ["o"], ["name"], ["level"])) == [
        (None, "Nobody", "free"), (1, "Ann", None), (2, None, "free"),
    ]


def test_last_wins_takes_the_whole_row(spark):
    assert rows(last_wins(seen(spark), ["k"], ["o"], ["k", "name", "level"])) == [
        (None, "Nobody", "free"), (1, "Anna", None), (2, "Bo", "free"),
    ]


def test_ties_do_not_depend_on_row_order(spark):
    data = [(1, 0, c) for c in "dbca"]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, o int, v string").repartition(3)
        assert rows(dim_first(df, ["k"], ["o"], ["k", "v"])) == [(1, "a")]
        assert rows(last_wins(df, ["k"], ["o"], ["k", "v"])) == [(1, "d")]


def test_table_upsert_against_a_dictionary(spark):
    """A third of the changes share one key."""
    rng = random.Random(7)
    base = {k: (k, rng.randrange(50), f"b{k}") for k in range(40)}
    changes = [(5 if rng.random() < 0.33 else rng.randrange(80), rng.randrange(100), f"c{i}") for i in range(300)]
    want = dict(base)
    for row in sorted(changes, key=lambda r: (r[1], r[2])):
        if row[0] not in want or want[row[0]][1:] < row[1:]:
            want[row[0]] = row
    schema = "k int, o int, v string"
    merged = table_upsert(
        spark.createDataFrame(list(base.values()), schema), spark.createDataFrame(changes, schema), ["k"], ["o"]
    )
    assert rows(merged) == sorted(want.values(), key=lambda r: [(True, str(v)) for v in r])
    alone = table_upsert(None, spark.createDataFrame(changes, schema), ["k"], ["o"])
    assert alone.count() == len({row[0] for row in changes})


def test_calendar_with_and_without_duplicates(spark):
    t = datetime(2018, 12, 31, 23, 59, 59, 999000)
    df = spark.createDataFrame([(t,), (t,)], "ts timestamp_ntz")
    assert rows(calendar(df, "ts")) == [(t, 23, 31, 1, 12, 2018, 0)]
    assert rows(calendar(df, "ts", "sun0", distinct=False, as_text=["month", "weekday"])) == [
        (t, 23, 31, 1, "12", 2018, "1")
    ] * 2


def test_calendar_of_two_columns_has_one_null_row(spark):
    df = spark.createDataFrame(
        [(date(2016, 4, 30), None), (date(2016, 5, 1), date(2016, 4, 30)), (None, None)], "a date, b date"
    )
    want = [
        (None,) * 6,
        (date(2016, 4, 30), 30, 17, 4, 2016, 7),
        (date(2016, 5, 1), 1, 17, 5, 2016, 1),
    ]
    assert rows(calendar_union((df, ["a", "b"]))) == want
    assert rows(calendar_union((df, ["a"]), (df, ["b"]))) == want


def test_roll_up_keeps_column_order_and_skips_nulls(spark):
    df = spark.createDataFrame(
        [("X", "a", 10.0, 1), ("X", "a", None, None), ("X", "b", 5.0, 3), ("Y", "a", None, None)],
        "state string, race string, age double, n int",
    )
    rolled = roll_up(df, ["state", "race"], averages=["age"], sums=["n"])
    assert rolled.columns == ["state", "race", "age", "n"]
    assert rows(rolled) == [("X", "a", 10.0, 1), ("X", "b", 5.0, 3), ("Y", "a", None, None)]


def test_row_counts_with_and_without_key(spark):
    data = [(1, "a"), (1, "a"), (1, "b"), (2, None), (2, None), (3, "c"), (None, "d"), (None, "d"), (None, "e")]
    df = spark.createDataFrame(data, "k int, v string")
    assert row_counts(df).first() == (9, 6)
    assert row_counts(df, ["k"]).first() == (9, 6, 3)
    assert row_counts(df.limit(0)).first() == (0, 0)
    assert row_counts(df.limit(0), ["k"]).first() == (0, 0, 0)


def test_concat_is_by_position(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    assert rows(concat_rows(a, a.toDF("c", "d"))) == [(1, "x"), (1, "x")]
