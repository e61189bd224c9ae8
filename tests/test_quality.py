import pytest
from conftest import rows
from pyspark.sql import functions as F

from tablewright.operators import (
    check_key,
    check_length,
    check_non_empty,
    check_not_null,
    check_sql,
    check_unique,
    duplicate_keys,
    raise_on_failure,
    run_checks,
)


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "long")], "k int, v string")


def test_non_empty(spark, df):
    assert rows(check_non_empty(df, "t")) == [("t", "non_empty", True, "4 rows")]
    assert rows(check_non_empty(df.limit(0), "t")) == [("t", "non_empty", False, "0 rows")]


@pytest.mark.parametrize("key", [[], ["k"]])
def test_unique_reports_what_it_found(df, key):
    assert rows(check_unique(df, "t", key)) == [("t", "unique_rows", False, "4 rows, 3 distinct")]
    assert rows(check_unique(df.dropDuplicates(), "t", key)) == [("t", "unique_rows", True, "3 rows, 3 distinct")]


def test_not_null_of_several_columns(df):
    assert rows(check_not_null(df, ["k", "v"], "t")) == [
        ("t", "not_null(k)", True, "0 null"), ("t", "not_null(v)", False, "1 null"),
    ]


def test_key(df):
    assert rows(duplicate_keys(df, ["k"])) == [(1, 2)]
    assert rows(check_key(df, ["k"], "t")) == [("t", "unique_key(k)", False, "1 repeated keys")]
    assert rows(check_key(df.filter("k > 1"), ["k"], "t")) == [("t", "unique_key(k)", True, "0 repeated keys")]


def test_length(df):
    assert rows(check_length(df, {"v": 3}, "t")) == [("t", "length(v<=3)", False, "1 too long")]


def test_sql_checks(spark, df):
    df.createOrReplaceTempView("checked")
    report = check_sql(
        spark,
        [
            ("SELECT count(*) FROM checked WHERE k IS NULL", 0),
            ("SELECT count(*) FROM checked WHERE v IS NULL", 0),
            ("SELECT v FROM checked WHERE k > 99", "x"),
            ("SELECT v, k FROM checked WHERE k = 3", "long"),
        ],
    )
    assert [r.passed for r in report.collect()] == [True, False, False, True]
    with pytest.raises(ValueError) as error:
        raise_on_failure(report)
    assert "v IS NULL (1, expected 0)" in str(error.value)
    assert "k > 99 (NULL, expected x)" in str(error.value)


def test_report_of_written_tables(spark, df, tmp_path):
    df.write.parquet(f"{tmp_path}/bad")
    df.filter("k > 1").write.parquet(f"{tmp_path}/good")
    report = run_checks(
        spark,
        str(tmp_path),
        ["good", "bad"],
        keys={"good": ["k"]},
        not_null={"good": ["k"], "bad": ["v"]},
        extra=[lambda d, name: check_length(d, {"v": 4}, name)],
    )
    assert {(r.table_name, r.check_name): r.passed for r in report.collect()} == {
        ("good", "non_empty"): True,
        ("good", "unique_rows"): True,
        ("good", "not_null(k)"): True,
        ("good", "unique_key(k)"): True,
        ("good", "length(v<=4)"): True,
        ("bad", "non_empty"): True,
        ("bad", "unique_rows"): False,
        ("bad", "not_null(v)"): False,
        ("bad", "length(v<=4)"): True,
    }
    raise_on_failure(report.filter("table_name = 'good'"))


@pytest.mark.parametrize("extra", ["", "SELECT 5L, 'other'", "SELECT 5L, 'a5'", "SELECT NULL, 'x'", "SELECT NULL, 'x' UNION ALL SELECT NULL, 'y' UNION ALL SELECT -2147483648L, 'z'"])
def test_numbered_counts_are_row_counts(spark, extra):
    from tablewright.operators import numbered_counts, row_counts

    df = spark.range(-300, 5000, 1, 3).select(F.col("id").alias("k"), F.concat(F.lit("a"), "id").alias("v")).where("k % 7 <> 3")
    if extra:
        df = df.unionAll(spark.sql(extra))
    found = numbered_counts(df, "k")
    assert found.columns == ["n", "n_distinct", "n_repeated"]
    assert found.collect() == row_counts(df, ["k"]).select(*found.columns).collect()
    assert numbered_counts(df.withColumn("k", F.col("k").cast("int")), "k").collect() == row_counts(df.withColumn("k", F.col("k").cast("int")), ["k"]).select(*found.columns).collect()


def test_checks_of_many_numbered_rows_shuffle_blocks_of_keys(spark, tmp_path):
    from tablewright.operators import quality

    spark.range(0, 1000, 1, 2).selectExpr("id AS k", "'x' AS v").write.parquet(str(tmp_path / "t"))
    options = {"tables": ["t"], "keys": {"t": ["k"]}}
    few = quality.run_checks(spark, str(tmp_path), counts={"t": {"n": 1000}}, **options)
    many = quality.run_checks(spark, str(tmp_path), counts={"t": {"n": quality.NUMBERED_ROWS}}, **options)
    assert [r.detail for r in few.collect()][1:] == [r.detail for r in many.collect()][1:] == ["1000 rows, 1000 distinct", "0 repeated keys"]
    assert "bit_or" in many._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" not in few._jdf.queryExecution().optimizedPlan().toString()


def test_checks_of_different_numbers_read_the_numbers_only(spark, tmp_path):
    """A join with the blocks of repeated keys shuffled all rows, though there were none."""
    from tablewright.operators import numbered_counts

    spark.range(0, 1000, 1, 2).selectExpr("id AS k", "'x' AS v").write.parquet(str(tmp_path / "t"))
    found = numbered_counts(spark.read.parquet(str(tmp_path / "t")), "k")
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.collect() == [(1000, 1000, 0)]
