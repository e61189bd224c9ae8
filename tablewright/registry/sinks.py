"""Writers: a table is written by the library and read back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import filter_equal
from tablewright.registry.base import query, table
from tablewright.sources import (
    create_table,
    drop_table,
    load_table,
    publish_table,
    read_csv,
    read_parquet,
    register_views,
    write_bucketed,
    write_csv,
    write_table,
)
from tablewright.storage import scratch_path

ORDER_KEYS = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"
LINE_KEYS = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("sink_parquet", ORDER_KEYS)
def sink_parquet(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    write_table(_orders(spark, sf_dir), path)
    return read_parquet(spark, path)


@query(
    "sink_parquet_partitioned",
    "SELECT o_orderkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month FROM orders",
)
def sink_parquet_partitioned(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    orders = table(spark, sf_dir, "orders")
    dated = orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    write_table(dated, path, partition_by=["year", "month"])
    return read_parquet(spark, path)


@query(
    "sink_partitions_touched",
    "SELECT o_orderkey, CASE WHEN year(o_orderdate) < 2000 THEN 0 ELSE o_custkey END AS o_custkey, "
    "year(o_orderdate)::INT AS year FROM orders",
)
def sink_partitions_touched(spark, sf_dir):
    """Reload some partitions of a table; the others stay as they were."""
    path = scratch_path(spark, "parquet")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    write_table(orders, path, partition_by=["year"])
    early = orders.filter(F.col("year") < 2000).withColumn("o_custkey", F.lit(0).cast("bigint"))
    write_table(early, path, partition_by=["year"], touched_only=True)
    return read_parquet(spark, path)


@query("sink_csv_quoted", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def sink_csv_quoted(spark, sf_dir):
    path = scratch_path(spark, "csv")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    write_csv(customer, path, quote_all=True)
    return read_csv(spark, path, customer.schema)


@query("sink_csv_text", "SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents")
def sink_csv_text(spark, sf_dir):
    """Whole documents, with line breaks and quotes, through quoted files of bounded size and back."""
    path = scratch_path(spark, "csv")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    write_csv(documents, path, quote_all=True, records_per_file=10_000)
    return read_csv(spark, path, documents.schema)


@query("sink_csv_lines", "SELECT count(*) AS lines FROM customer")
def sink_csv_lines(spark, sf_dir):
    """Lines of the written file without its header."""
    return sink_csv_quoted(spark, sf_dir).agg(F.count("*").alias("lines"))


@query("sink_clustered", LINE_KEYS)
def sink_clustered(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    write_table(lines, path, cluster_by=["l_orderkey"], sort_by=["l_linenumber"])
    return read_parquet(spark, path)


@query("sink_bucketed", LINE_KEYS)
def sink_bucketed(spark, sf_dir):
    path, name = scratch_path(spark, "parquet"), f"lines_{uuid4().hex}"
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    write_bucketed(lines, name, ["l_orderkey"], buckets=8, sort_by=["l_orderkey", "l_linenumber"], path=path)
    # by its name, so that the bucketing is known
    return spark.table(name)


@query(
    "sink_views",
    "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
)
def sink_views(spark, sf_dir):
    """Written tables, registered under their names and joined in SQL."""
    base, suffix = scratch_path(spark, "views"), uuid4().hex
    names = [f"{name}_{suffix}" for name in ("customer", "nation")]
    for name in names:
        write_table(table(spark, sf_dir, name.split("_")[0]), f"{base}/{name}")
    register_views(spark, base, names)
    customer, nation = names
    return spark.sql(
        f"SELECT n_name, count(*) AS customers FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey GROUP BY n_name"
    )


@query(
    "load_append",
    "SELECT event_id FROM events WHERE event_type='click' UNION ALL "
    "SELECT event_id FROM events WHERE event_type='view'",
)
def load_append(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    events = table(spark, sf_dir, "events")
    for kind in ("click", "view"):
        load_table(filter_equal(events, event_type=kind).select("event_id"), path, ["event_id"])
    return read_parquet(spark, path)


@query("load_overwrite", "SELECT user_id AS userid, event_id AS playid FROM events WHERE event_type='view'")
def load_overwrite(spark, sf_dir):
    """The second load replaces the first; target columns are matched by position."""
    path = scratch_path(spark, "parquet")
    events = table(spark, sf_dir, "events")
    for kind in ("click", "view"):
        rows = filter_equal(events, event_type=kind).select("user_id", "event_id")
        load_table(rows, path, ["userid", "playid"], mode="truncate")
    return read_parquet(spark, path)


@query(
    "ddl_roundtrip",
    "SELECT o_orderkey AS playid, o_custkey AS userid, CAST(NULL AS VARCHAR) AS level FROM orders",
)
def ddl_roundtrip(spark, sf_dir):
    """Declare a table, insert with a column list, drop the table; columns not listed are NULL."""
    path, name = scratch_path(spark, "parquet"), f"plays_{uuid4().hex}"
    schema = T.StructType(
        [
            T.StructField("playid", T.LongType()),
            T.StructField("userid", T.LongType()),
            T.StructField("level", T.StringType()),
        ]
    )
    create_table(spark, name, schema, path=path)
    create_table(spark, name, schema, path=path)
    load_table(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), name, ["userid", "playid"])
    drop_table(spark, name)
    return spark.read.schema(schema).parquet(path)


@query("load_publish", "SELECT o_orderkey, o_custkey + 1 AS o_custkey FROM orders")
def load_publish(spark, sf_dir):
    """Refresh a table from its own previous content."""
    base, name = scratch_path(spark, "publish"), f"orders_{uuid4().hex}"
    publish_table(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), name, base)
    path = publish_table(spark.table(name).withColumn("o_custkey", F.col("o_custkey") + 1), name, base)
    drop_table(spark, name)
    return read_parquet(spark, path)
