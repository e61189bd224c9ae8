"""Data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import (
    check_key,
    check_length,
    check_non_empty,
    check_not_null,
    check_sql,
    check_unique,
    concat_rows,
    duplicate_keys,
    row_counts,
    run_checks,
)
from tablewright.registry.base import query, table
from tablewright.sources import KeyHistory, write_table
from tablewright.storage import scratch_path, stash


@query(
    "dq_non_empty",
    "SELECT 'orders' AS table_name, count(*) AS cnt, count(*) > 0 AS passed FROM orders "
    "UNION ALL SELECT 'nation', count(*), count(*) > 0 FROM nation",
)
def dq_non_empty(spark, sf_dir):
    checks = [check_non_empty(table(spark, sf_dir, name), name) for name in ("orders", "nation")]
    count = F.split_part("detail", F.lit(" "), F.lit(1)).cast("bigint").alias("cnt")
    return concat_rows(*checks).select("table_name", count, "passed")


@query(
    "dq_unique_rows",
    "SELECT 'lineitem' AS table_name, (SELECT count(*) FROM lineitem) AS n, "
    "(SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS n_distinct",
)
def dq_unique_rows(spark, sf_dir):
    counts = row_counts(table(spark, sf_dir, "lineitem"))
    return counts.select(F.lit("lineitem").alias("table_name"), "n", "n_distinct")


@query("dq_null_keys", "SELECT 'orders' AS table_name, count(*) AS nulls FROM orders WHERE o_orderkey IS NULL")
def dq_null_keys(spark, sf_dir):
    report = check_not_null(table(spark, sf_dir, "orders"), ["o_orderkey"], "orders")
    return report.select("table_name", F.split_part("detail", F.lit(" "), F.lit(1)).cast("bigint").alias("nulls"))


@query(
    "dq_null_columns",
    """
    SELECT 'orders' AS table_name, 'not_null(flag)' AS check_name, false AS passed,
        count(*)::VARCHAR || ' null' AS detail FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'orders', 'not_null(o_orderkey)', true, count(*)::VARCHAR || ' null' FROM orders WHERE o_orderkey IS NULL
    """,
)
def dq_null_columns(spark, sf_dir):
    """Several columns of a table in one pass."""
    flag = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", flag.alias("flag"))
    return check_not_null(orders, ["flag", "o_orderkey"], "orders")


@query(
    "dq_expected",
    """
    SELECT 'o_custkey orphan' AS check_name, count(*) AS actual, 0::BIGINT AS expected, count(*)=0 AS passed
    FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey=o.o_custkey)
    """,
)
def dq_expected(spark, sf_dir):
    sql = f"""
        SELECT count(*) FROM parquet.`{sf_dir}/orders.parquet` o
        WHERE NOT EXISTS (SELECT 1 FROM parquet.`{sf_dir}/customer.parquet` c WHERE c.c_custkey = o.o_custkey)
    """
    report = check_sql(spark, [(sql, 0)])
    return report.select(
        F.lit("o_custkey orphan").alias("check_name"),
        F.split_part("detail", F.lit(","), F.lit(1)).cast("bigint").alias("actual"),
        F.lit(0).cast("bigint").alias("expected"),
        "passed",
    )


@query(
    "dq_key_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem GROUP BY 1,2 HAVING count(*) > 1",
)
def dq_key_unique(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_key_unique_loads",
    """
    WITH loads AS (SELECT l_linenumber::BIGINT AS load_number, l_orderkey, count(*) AS cnt FROM lineitem WHERE l_linenumber IN (1, 2, 3) GROUP BY 1, 2)
    SELECT load_number, l_orderkey, cnt, load_number > min(load_number) OVER (PARTITION BY l_orderkey) AS earlier FROM loads
    QUALIFY cnt > 1 OR earlier
    """,
)
def dq_key_unique_loads(spark, sf_dir):
    """Orders that a load holds twice or an earlier one has brought, of three loads; each is checked against the fingerprints of the others, and again once it is recorded."""
    history = KeyHistory(spark, scratch_path(spark, "key-history"), ["l_orderkey"])
    lines, found = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), None
    for load in (1, 2, 3):
        rows = lines.where(F.col("l_linenumber") == load)
        repeated = stash(history.repeated(rows, str(load)), "repeated-keys")
        history.record(rows, str(load))
        if history.repeated(rows, str(load)).count() != repeated.count():
            raise RuntimeError("a load that is checked again finds its own keys")
        own = repeated.select(F.lit(load).cast("long").alias("load_number"), "l_orderkey", "cnt", "earlier")
        found = own if found is None else found.unionAll(own)
    return found


@query(
    "dq_length",
    """
    SELECT 'customer' AS table_name, 'length(c_mktsegment<=9)' AS check_name, count(*) = 0 AS passed,
        count(*)::VARCHAR || ' too long' AS detail FROM customer WHERE length(c_mktsegment) > 9
    """,
)
def dq_length(spark, sf_dir):
    return check_length(table(spark, sf_dir, "customer"), {"c_mktsegment": 9}, "customer")


@query(
    "dq_report",
    """
    WITH s AS (SELECT count(*) AS n FROM supplier), l AS (SELECT l_orderkey, l_linenumber FROM lineitem),
    d AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM l)), r AS (SELECT count(*) AS n FROM (
        SELECT l_orderkey, l_linenumber FROM l GROUP BY 1,2 HAVING count(*) > 1))
    SELECT 'supplier' AS table_name, 'non_empty' AS check_name, n > 0 AS passed, n || ' rows' AS detail FROM s
    UNION ALL SELECT 'supplier', 'unique_rows', true, n || ' rows, ' || n || ' distinct' FROM s
    UNION ALL SELECT 'supplier', 'not_null(s_suppkey)', true, '0 null'
    UNION ALL SELECT 'supplier', 'unique_key(s_suppkey)', true, '0 repeated keys'
    UNION ALL SELECT 'lines', 'non_empty', count(*) > 0, count(*) || ' rows' FROM l
    UNION ALL SELECT 'lines', 'unique_rows', count(*) = d.n, count(*) || ' rows, ' || d.n || ' distinct' FROM l, d GROUP BY d.n
    UNION ALL SELECT 'lines', 'unique_key(l_orderkey, l_linenumber)', n = 0, n || ' repeated keys' FROM r
    """,
)
def dq_report(spark, sf_dir):
    """Checks of two written tables in one report."""
    base = scratch_path(spark, "checked")
    write_table(table(spark, sf_dir, "supplier"), f"{base}/supplier")
    write_table(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), f"{base}/lines")
    keys = {"supplier": ["s_suppkey"], "lines": ["l_orderkey", "l_linenumber"]}
    return run_checks(spark, base, ["supplier", "lines"], keys=keys, not_null={"supplier": ["s_suppkey"]})


@query(
    "dq_key_summary",
    """
    SELECT 'lineitem' AS table_name, 'unique_key(l_orderkey)' AS check_name, count(*) = 0 AS passed,
        count(*)::VARCHAR || ' repeated keys' AS detail
    FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
    """,
)
def dq_key_summary(spark, sf_dir):
    return check_key(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "lineitem")


@query(
    "dq_unique_summary",
    """
    SELECT 'events' AS table_name, 'unique_rows' AS check_name, n = d AS passed,
        n || ' rows, ' || d || ' distinct' AS detail
    FROM (SELECT count(*) AS n FROM events), (SELECT count(*) AS d FROM (SELECT DISTINCT * FROM events))
    """,
)
def dq_unique_summary(spark, sf_dir):
    return check_unique(table(spark, sf_dir, "events"), "events")


@query(
    "dq_unique_keyed",
    "SELECT (SELECT count(*) FROM lineitem) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS n_distinct",
)
def dq_unique_keyed(spark, sf_dir):
    """Whole rows are compared only where the key repeats."""
    counts = row_counts(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return counts.select("n", "n_distinct")
