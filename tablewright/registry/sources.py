"""File formats: a table is written in a format by Spark and read back with the library's reader."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import epoch_millis
from tablewright.operators import check_rejects, split_typed
from tablewright.registry.base import query, table
from tablewright.sources import dated_path, read_csv, read_csv_rejects, read_json, read_parquet, stage, write_csv
from tablewright.storage import scratch_path

EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)
TURN = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
DAY_TEMPLATE = "year={year}/month={month}/date={year}-{month}-{day}"


def _json_by_day(spark, sf_dir):
    """Events as JSON lines in folders year / month / date."""
    path = scratch_path(spark, "json")
    events = table(spark, sf_dir, "events").withColumns(
        {"year": F.year("ts"), "month": F.lpad(F.month("ts").cast("string"), 2, "0"), "date": F.to_date("ts")}
    )
    columns = [*EVENT.names, "year", "month", "date"]
    events.select(*columns).hint("rebalance", "date").write.partitionBy("year", "month", "date").json(path)
    return path


@query("src_json_schema", "SELECT event_id, user_id, event_type, value FROM events")
def src_json_schema(spark, sf_dir):
    return read_json(spark, _json_by_day(spark, sf_dir), EVENT, recursive=True)


@query("src_json_glob", "SELECT event_id, user_id, event_type, value FROM events")
def src_json_glob(spark, sf_dir):
    return read_json(spark, f"{_json_by_day(spark, sf_dir)}/*/*/*/*.json", EVENT)


@query(
    "src_path_template",
    "SELECT event_id, user_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'",
)
def src_path_template(spark, sf_dir):
    path = f"{_json_by_day(spark, sf_dir)}/{dated_path(DAY_TEMPLATE, date(2024, 1, 5))}"
    return read_json(spark, path, EVENT).select("event_id", "user_id", "event_type")


@query("src_csv_headed", "SELECT conv_id, turn, role, nullif(text, '') AS text FROM conversations")
def src_csv_headed(spark, sf_dir):
    """Texts hold line breaks, quotes and separators."""
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "conversations").select(*TURN.names), path)
    return read_csv(spark, path, TURN)


@query("src_csv_delim", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv_delim(spark, sf_dir):
    path = scratch_path(spark, "csv")
    customer = table(spark, sf_dir, "customer").select(*CUSTOMER.names)
    customer.write.option("sep", ";").option("header", True).csv(path)
    return read_csv(spark, path, CUSTOMER, sep=";")


@query("src_parquet_glob", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def src_parquet_glob(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    table(spark, sf_dir, "orders").write.parquet(path)
    return read_parquet(spark, f"{path}/*.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "stage_mapped",
    "SELECT event_id, user_id, event_type, value, (epoch_us(ts) // 1000)::BIGINT AS ts_ms FROM events",
)
def stage_mapped(spark, sf_dir):
    path = scratch_path(spark, "json")
    mapping = {"event_id": "id", "user_id": "userId", "event_type": "page", "value": "length", "ts_ms": "ts"}
    events = table(spark, sf_dir, "events").withColumn("ts_ms", epoch_millis("ts"))
    events.select(*[F.col(column).alias(field) for column, field in mapping.items()]).write.json(path)
    schema = T.StructType([*EVENT.fields, T.StructField("ts_ms", T.LongType())])
    return stage(spark, path, schema, mapping, target=scratch_path(spark, "staging"))


HOLDER = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("nation", T.IntegerType())])
# a record of each kind: whole, too short, no number, too long, an empty field
LINES = [
    ("0", "c_custkey || ',' || c_name || ',' || c_nationkey"),
    ("1", "c_custkey || ',' || c_name"),
    ("2", "'x' || c_custkey || ',' || c_name || ',n' || c_nationkey"),
    ("3", "c_custkey || ',' || c_name || ',' || c_nationkey || ',more'"),
    ("4", "c_custkey || ',' || c_name || ','"),
]
LINE_SQL = f"CASE c_custkey % 5 {' '.join(f'WHEN {k} THEN {line}' for k, line in LINES)} END"
REASONS_SQL = "CASE c_custkey % 5 WHEN 2 THEN 'id: no bigint; nation: no int' ELSE 'not 3 fields' END"


def _faulty_files(spark, sf_dir):
    path = scratch_path(spark, "csv-faulty")
    lines = table(spark, sf_dir, "customer").select(F.expr(LINE_SQL).alias("value"))
    lines.write.option("lineSep", "\n").text(path)
    return path


@query(
    "src_csv_rejects",
    f"""
    SELECT CASE WHEN c_custkey % 5 IN (0, 4) THEN c_custkey END AS id, CASE WHEN c_custkey % 5 IN (0, 4) THEN c_name END AS name,
        CASE WHEN c_custkey % 5 = 0 THEN c_nationkey END::INT AS nation, CASE WHEN c_custkey % 5 NOT IN (0, 4) THEN {LINE_SQL} END AS record,
        CASE WHEN c_custkey % 5 NOT IN (0, 4) THEN {REASONS_SQL} END AS reasons
    FROM customer
    """,
)
def src_csv_rejects(spark, sf_dir):
    """Rows that fit and records that do not, each once."""
    good, rejects = read_csv_rejects(spark, _faulty_files(spark, sf_dir), HOLDER, header=False)
    rejects = rejects.select("record", F.array_join("reasons", "; ").alias("reasons"))
    return good.unionByName(rejects, allowMissingColumns=True)


@query(
    "dq_rejects",
    """
    SELECT 'holders' AS table_name, 'rejects(<=0)' AS check_name, count(*) = 0 AS passed, count(*) || ' rejected' AS detail
    FROM customer WHERE c_custkey % 5 NOT IN (0, 4)
    """,
)
def dq_rejects(spark, sf_dir):
    """The rejected records of a source, counted."""
    return check_rejects(read_csv_rejects(spark, _faulty_files(spark, sf_dir), HOLDER, header=False)[1], "holders")


@query(
    "cast_rejects",
    """
    SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS id, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate::DATE END AS day,
        CASE WHEN o_orderkey % 7 = 0 THEN 'k' || o_orderkey END AS raw, CASE WHEN o_orderkey % 7 = 0 THEN 'id: no bigint' END AS reasons
    FROM orders
    """,
)
def cast_rejects(spark, sf_dir):
    """Texts cast to their types; rows that do not fit, with the reason."""
    key = F.col("o_orderkey").cast("string")
    texts = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("k"), key)).otherwise(key).alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType())])
    good, rejects = split_typed(texts, schema)
    rejects = rejects.select(F.col("id").alias("raw"), F.array_join("reasons", "; ").alias("reasons"))
    return good.unionByName(rejects, allowMissingColumns=True)
