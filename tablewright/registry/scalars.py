"""Filters, projections and column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import (
    cast_or_null,
    content_key,
    cut_to_second,
    epoch_millis,
    from_epoch_millis,
    from_epoch_millis_cut,
    item_of_split,
    parse_date,
    timestamp_text,
    whole_decimal,
)
from tablewright.operators import filter_equal, filter_filled, filter_not_null, monotonic_key, project, sequence_key
from tablewright.registry.base import query, table


@query(
    "filter_page_user",
    "SELECT event_id, user_id FROM events WHERE event_type='purchase' AND user_id IS NOT NULL",
)
def filter_page_user(spark, sf_dir):
    purchases = filter_equal(table(spark, sf_dir, "events"), event_type="purchase")
    return filter_not_null(purchases, "user_id").select("event_id", "user_id")


@query("filter_blank", "SELECT conv_id, turn, role FROM conversations WHERE role <> ''")
def filter_blank(spark, sf_dir):
    return filter_filled(table(spark, sf_dir, "conversations"), "role").select("conv_id", "turn", "role")


@query("project_rename", "SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS level FROM customer")
def project_rename(spark, sf_dir):
    return project(table(spark, sf_dir, "customer"), {"user_id": "c_custkey", "name": "c_name", "level": "c_mktsegment"})


@query(
    "cast_text",
    "SELECT event_id, CAST(user_id AS VARCHAR) AS user_txt, CAST(CAST(user_id AS VARCHAR) AS INT) AS user_int FROM events",
)
def cast_text(spark, sf_dir):
    texts = table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("user_txt"))
    return texts.withColumn("user_int", cast_or_null("user_txt", "int"))


@query(
    "cast_bad_text",
    "SELECT event_id, TRY_CAST(CASE WHEN event_type='error' THEN '' ELSE CAST(user_id AS VARCHAR) END AS INT) AS user_int FROM events",
)
def cast_bad_text(spark, sf_dir):
    """A blank id is no error but NULL."""
    text = F.when(F.col("event_type") == "error", "").otherwise(F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", cast_or_null(text, "int").alias("user_int"))


@query(
    "ts_epoch_ms",
    "SELECT event_id, (epoch_us(ts) // 1000)::BIGINT AS ts_ms, date_trunc('second', ts) AS start_time FROM events",
)
def ts_epoch_ms(spark, sf_dir):
    millis = table(spark, sf_dir, "events").select("event_id", epoch_millis("ts").alias("ts_ms"))
    return millis.withColumn("start_time", from_epoch_millis_cut("ts_ms"))


@query("ts_epoch_kept", "SELECT event_id, date_trunc('millisecond', ts) AS start_time FROM events")
def ts_epoch_kept(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", from_epoch_millis(epoch_millis("ts")).alias("start_time"))


@query(
    "parse_dates",
    "SELECT o_orderkey, CASE WHEN o_orderstatus='P' THEN NULL ELSE o_orderdate::DATE END AS dtaddto FROM orders",
)
def parse_dates(spark, sf_dir):
    text = F.when(F.col("o_orderstatus") == "P", "D/S").otherwise(F.date_format("o_orderdate", "MMddyyyy"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("dtaddto"))
    return orders.withColumn("dtaddto", parse_date("dtaddto", "MMddyyyy"))


@query(
    "split_pair",
    "SELECT p_partkey, split_part(p_name,' ',1) AS a, split_part(p_name,' ',2) AS b FROM part",
)
def split_pair(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    items = {name: item_of_split("p_name", " ", i) for i, name in enumerate("ab")}
    return parts.withColumns(items).drop("p_name")


@query("dec_scale0", "SELECT p_partkey, trunc(p_retailprice)::BIGINT::DECIMAL(18,0) AS price0 FROM part")
def dec_scale0(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", whole_decimal("p_retailprice").alias("price0"))


@query(
    "key_md5",
    "SELECT event_id, md5(concat(user_id::VARCHAR, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S'))) AS playid FROM events",
)
def key_md5(spark, sf_dir):
    key = content_key("user_id", cut_to_second("ts"))
    return table(spark, sf_dir, "events").select("event_id", key.alias("playid"))


@query("ts_text", "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS start_time FROM events")
def ts_text(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", timestamp_text("ts").alias("start_time"))


@query(
    "key_sequence",
    "SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1)::BIGINT AS songplay_id FROM events",
)
def key_sequence(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "event_id")
    numbered = sequence_key(events, "songplay_id", 0, ["ts", "event_id"], order_is_unique=True)
    return numbered.select("event_id", "songplay_id")


@query(
    "key_sequence_ties",
    "SELECT l_returnflag, l_linestatus, row_number() OVER (ORDER BY l_returnflag, l_linestatus) AS id FROM lineitem",
)
def key_sequence_ties(spark, sf_dir):
    """Order columns with few values: each value holds a large share of the rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus")
    return sequence_key(lines, "id", 1, ["l_returnflag", "l_linestatus"])


@query(
    "key_sequence_unordered",
    "SELECT count(*) AS n, count(*) AS n_distinct, min(event_id) * 0 + 1 AS lowest, count(*) AS highest FROM events",
)
def key_sequence_unordered(spark, sf_dir):
    """Numbering in no set order: the numbers still have no gap and no repeat."""
    numbered = sequence_key(table(spark, sf_dir, "events").select("event_id"), "id", 1)
    return _key_facts(numbered, "id")


@query("key_monotonic", "SELECT count(*) AS n, count(*) AS n_distinct FROM lineitem")
def key_monotonic(spark, sf_dir):
    """The ids differ from run to run; that they are unique does not."""
    keyed = monotonic_key(table(spark, sf_dir, "lineitem").select("l_orderkey"), "id")
    return _key_facts(keyed, "id").select("n", "n_distinct")


def _key_facts(df, key):
    counts = df.groupBy(key).agg(F.count("*").alias("copies"))
    return counts.agg(
        F.sum("copies").alias("n"),
        F.count("*").alias("n_distinct"),
        F.min(key).alias("lowest"),
        F.max(key).alias("highest"),
    )
