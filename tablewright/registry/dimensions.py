"""Dimensions, calendars and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import (
    calendar,
    calendar_union,
    concat_rows,
    dim_distinct,
    dim_first,
    dim_upsert,
    filter_equal,
    last_wins,
    roll_up,
    table_upsert,
)
from tablewright.registry.base import query, table
from tablewright.sources import upsert_files
from tablewright.storage import scratch_path

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LAST_LINE = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
"""


@query(
    "dim_distinct_row",
    "SELECT DISTINCT user_id, event_type AS level FROM events WHERE event_type IN ('purchase','view')",
)
def dim_distinct_row(spark, sf_dir):
    events = table(spark, sf_dir, "events").filter(F.col("event_type").isin("purchase", "view"))
    return dim_distinct(events.withColumnRenamed("event_type", "level"), ["user_id", "level"], not_null=["user_id"])


@query(
    "dim_first_wins",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1
    """,
)
def dim_first_wins(spark, sf_dir):
    return dim_first(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER, LINE_COLUMNS)


@query(
    "dim_upsert_column",
    "SELECT user_id, arg_min(props, (ts, event_id)) AS first_props, arg_max(event_type, (ts, event_id)) AS level "
    "FROM events GROUP BY user_id",
)
def dim_upsert_column(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", F.col("props").alias("first_props"), F.col("event_type").alias("level")
    )
    return dim_upsert(events, ["user_id"], ["ts", "event_id"], ["first_props"], ["level"])


@query("table_upsert_last_wins", LAST_LINE)
def table_upsert_last_wins(spark, sf_dir):
    return last_wins(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER, LINE_COLUMNS)


@query("table_upsert_merge", LAST_LINE)
def table_upsert_merge(spark, sf_dir):
    """A keyed table of the open lines, upserted with the others, equals the upsert of all lines."""
    lines = table(spark, sf_dir, "lineitem").select(*dict.fromkeys([*LINE_COLUMNS, *LINE_ORDER, "l_linestatus"]))
    base = last_wins(filter_equal(lines, l_linestatus="O"), LINE_KEY, LINE_ORDER)
    changes = filter_equal(lines, l_linestatus="F")
    return table_upsert(base, changes, LINE_KEY, LINE_ORDER).select(*LINE_COLUMNS)


@query("table_upsert_files", LAST_LINE)
def table_upsert_files(spark, sf_dir):
    """As before, into a written table of which only the files with changed keys are rewritten."""
    root = scratch_path(spark, "upsert-files")
    lines = table(spark, sf_dir, "lineitem").select(*dict.fromkeys([*LINE_COLUMNS, *LINE_ORDER, "l_linestatus"]))
    upsert_files(spark, root, "lines", filter_equal(lines, l_linestatus="O"), LINE_KEY, LINE_ORDER)
    upsert_files(spark, root, "lines", filter_equal(lines, l_linestatus="F"), LINE_KEY, LINE_ORDER)
    return spark.read.parquet(f"{root}/lines").select(*LINE_COLUMNS)


@query(
    "calendar_rows",
    """
    SELECT t AS start_time, hour(t)::INT AS hour, day(t)::INT AS day, week(t)::INT AS week, month(t)::INT AS month,
        year(t)::INT AS year, (isodow(t)-1)::INT AS weekday
    FROM (SELECT ts AS t FROM events WHERE event_type='purchase')
    """,
)
def calendar_rows(spark, sf_dir):
    purchases = filter_equal(table(spark, sf_dir, "events"), event_type="purchase")
    return calendar(purchases, "ts", weekday="mon0", distinct=False)


@query(
    "calendar_distinct",
    """
    SELECT DISTINCT t AS start_time, hour(t)::INT AS hour, day(t)::INT AS day, week(t)::INT AS week,
        month(t)::INT AS month, year(t)::INT AS year, (dayofweek(t)+1)::INT AS weekday
    FROM (SELECT date_trunc('hour', ts) AS t FROM events)
    """,
)
def calendar_distinct(spark, sf_dir):
    hours = table(spark, sf_dir, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("t"))
    return calendar(hours, "t", weekday="sun1")


@query(
    "calendar_wh",
    """
    SELECT DISTINCT t AS start_time, hour(t)::INT AS hour, month(t)::VARCHAR AS month, dayofweek(t)::VARCHAR AS weekday
    FROM (SELECT o_orderdate AS t FROM orders)
    """,
)
def calendar_wh(spark, sf_dir):
    rows = calendar(table(spark, sf_dir, "orders"), "o_orderdate", weekday="sun0", as_text=["month", "weekday"])
    return rows.select("start_time", "hour", "month", "weekday")


@query(
    "calendar_two_dates",
    """
    SELECT DISTINCT d AS datetime, day(d)::INT AS day, week(d)::INT AS week, month(d)::INT AS month,
        year(d)::INT AS year, (dayofweek(d)+1)::INT AS weekday
    FROM (SELECT o_orderdate::DATE AS d FROM orders UNION ALL
          SELECT CASE WHEN l_returnflag='R' THEN NULL ELSE l_shipdate::DATE END FROM lineitem)
    """,
)
def calendar_two_dates(spark, sf_dir):
    ordered = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    shipped = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.to_date("l_shipdate")).alias("d")
    )
    return calendar_union((ordered, ["d"]), (shipped, ["d"]))


@query(
    "calendar_two_columns",
    """
    SELECT DISTINCT d AS datetime, day(d)::INT AS day, week(d)::INT AS week, month(d)::INT AS month,
        year(d)::INT AS year, (dayofweek(d)+1)::INT AS weekday
    FROM (SELECT l_shipdate::DATE AS d FROM lineitem UNION ALL
          SELECT (l_shipdate + INTERVAL 180 DAY)::DATE FROM lineitem)
    """,
)
def calendar_two_columns(spark, sf_dir):
    """Both dates in one table: one scan."""
    dates = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("a"))
    return calendar_union((dates.withColumn("b", F.date_add("a", 180)), ["a", "b"]))


@query(
    "union_rows",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def union_rows(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return concat_rows(customers, table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"))


@query(
    "rollup_group",
    """
    SELECT n.n_name, n.n_nationkey, c.c_mktsegment, round(avg(c.c_acctbal), 4) AS avg_bal,
        sum(c.c_custkey)::BIGINT AS sum_key, count(*) AS cnt
    FROM customer c JOIN nation n ON c.c_nationkey=n.n_nationkey GROUP BY 1,2,3
    """,
)
def rollup_group(spark, sf_dir):
    cities = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    rows = cities.select(
        "n_name",
        "n_nationkey",
        "c_mktsegment",
        F.col("c_acctbal").alias("avg_bal"),
        F.col("c_custkey").alias("sum_key"),
        F.lit(1).alias("cnt"),
    )
    rolled = roll_up(rows, ["n_name", "n_nationkey", "c_mktsegment"], averages=["avg_bal"], sums=["sum_key", "cnt"])
    return rolled.withColumn("avg_bal", F.round("avg_bal", 4))
