"""Physical plans: what must reach the scan, and what must not appear."""

import os
import re

import pytest

from tablewright.operators import natural_join
from tablewright.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")

# these write files or run streams before they return
LAZY = [n for n in QUERIES if not n.startswith(("src_", "sink_", "load_", "stage_", "stream_", "lookups_", "ddl_")) and not n.endswith(("_built", "_checked", "_written", "_written_dims", "_appended", "_reloaded"))]


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cartesian_no_window_over_all_rows(spark, name):
    text = plan(spark, name)
    for word in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text
    # only the partition sizes of a sequence key are summed in one task, in the order of the partitions
    for window in re.findall(r"Window \[.*", text):
        if "SinglePartition" in text:
            assert re.search(r"_part#\d+L? ASC", window), window


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(spark, "filter_page_user")
    assert "EqualTo(event_type,purchase)" in text
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text


def test_upsert_is_one_shuffle(spark):
    text = plan(spark, "dim_upsert_column")
    assert text.count("Exchange") == 1
    assert "partial_max" in text


def test_calendar_groups_one_column(spark):
    text = plan(spark, "calendar_wh")
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in text
    assert text.count("Exchange") == 1
    assert "hashpartitioning(start_time" in text


def test_two_dates_of_a_table_are_one_scan(spark):
    assert plan(spark, "calendar_two_columns").count("FileScan") == 1


def test_uniqueness_shuffles_fingerprints_and_keys_only(spark):
    text = plan(spark, "dq_unique_keyed")
    assert text.count("FileScan") == 1
    exchanges = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert exchanges
    for columns in exchanges:
        assert re.fullmatch(r"((_key\d+|_mark\d)#\d+L?, )+\d+", columns), columns


def test_null_checks_are_one_scan(spark):
    assert plan(spark, "dq_null_columns").count("FileScan") == 1


def test_report_scans_each_table_twice(spark):
    assert plan(spark, "dq_report").count("FileScan") == 4


def test_filter_and_columns_pass_a_left_join(spark):
    lines, part = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("lineitem", "part"))
    joined = natural_join(lines, part, [("l_partkey", "p_partkey")], "left", ["p_name"])
    text = joined.select("l_orderkey", "p_name").where("l_orderkey < 10")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_orderkey,10)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text


def test_lookup_of_a_clustered_table_pushes_the_key(spark):
    assert "EqualTo(conv_id,1)" in plan(spark, "lookup_by_key")


def test_grouping_a_bucketed_table_by_its_key_needs_no_shuffle(spark):
    grouped = QUERIES["sink_bucketed"](spark, SF_DIR).groupBy("l_orderkey").count()
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = grouped._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert "Bucketed: true" in text
    assert "Exchange" not in text
