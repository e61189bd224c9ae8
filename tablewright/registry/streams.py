"""Incremental load of events that arrive as JSON files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.registry.base import query, table
from tablewright.registry.derived import catalogue, event_log
from tablewright.registry.star import BASE, CATALOGUE_ORDER, EVENT_ORDER, FACT_TAIL, TABLES
from tablewright.schemas import STAR_COLUMNS
from tablewright.storage import scratch_path
from tablewright.streaming import (
    AppendFact,
    IncrementalStar,
    RollUp,
    UpsertDimension,
    compact_dimension,
    compact_rollup,
    incremental_load,
    read_dimension,
    read_fact,
    read_rollup,
)

SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts_us", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("props", T.StringType()),
    ]
)
USERS = UpsertDimension(
    "users",
    key=["user_id"],
    order=["ts_us", "event_id"],
    keep_first=["first_props"],
    take_last=["level"],
    prepare=lambda staged: staged.withColumns({"first_props": F.col("props"), "level": F.col("event_type")}),
)
PLAYS = AppendFact(
    "plays",
    build=lambda staged: staged.filter(F.col("event_type") == "purchase").select("event_id", "user_id"),
)
# small enough that the test tables come in several batches
MAX_FILES = 4
USERS_SQL = """
    SELECT user_id, arg_min(props, (ts, event_id)) AS first_props, arg_max(event_type, (ts, event_id)) AS level
    FROM events GROUP BY user_id
"""


def _drop_files(spark, sf_dir, path, early):
    events = table(spark, sf_dir, "events")
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts"))
    half = F.col("ts") < F.expr("TIMESTAMP_NTZ'2024-01-16 00:00:00'")
    rows = events.filter(half if early else ~half).withColumn("ts_us", micros)
    rows.select(*SCHEMA.names).repartition(6, "event_id").write.mode("append").json(path)


def _loaded(spark, sf_dir):
    """The later half of the events arrives first, then the earlier; a third run finds nothing new."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "incremental")
    for early in (False, True):
        _drop_files(spark, sf_dir, landing, early)
        incremental_load(spark, landing, SCHEMA, out, [PLAYS], [USERS], MAX_FILES)
    if incremental_load(spark, landing, SCHEMA, out, [PLAYS], [USERS], MAX_FILES):
        raise RuntimeError("a run without new files loaded a batch")
    return out


@query("stream_incremental", USERS_SQL)
def stream_incremental(spark, sf_dir):
    return read_dimension(spark, _loaded(spark, sf_dir), USERS)


@query("stream_incremental_compacted", USERS_SQL)
def stream_incremental_compacted(spark, sf_dir):
    out = _loaded(spark, sf_dir)
    compact_dimension(spark, out, USERS)
    return read_dimension(spark, out, USERS)


@query("stream_incremental_fact", "SELECT event_id, user_id FROM events WHERE event_type='purchase'")
def stream_incremental_fact(spark, sf_dir):
    """Every play exactly once."""
    return read_fact(spark, _loaded(spark, sf_dir), "plays")


NUMBERED = AppendFact("numbered", lambda staged: staged.select("event_id", "user_id"), number="event_key", number_order=["event_id"])


@query("stream_key_sequence", "SELECT row_number() OVER (ORDER BY event_id) AS event_key, event_id, user_id FROM events")
def stream_key_sequence(spark, sf_dir):
    """Three batches in the order of their events; the second breaks off once its rows are written, and is run again."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "incremental")
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    cuts = events.agg(F.percentile_approx("event_id", F.array(F.lit(1 / 3), F.lit(2 / 3)))).first()[0]
    broken = UpsertDimension("users", ["user_id"], ["event_id"], [], [], lambda rows: rows.withColumn("user_id", F.raise_error(F.lit("broken off")).cast("long")))
    for batch, (low, high) in enumerate(zip([None, *cuts], [*cuts, None], strict=True)):
        part = events if low is None else events.where(F.col("event_id") > low)
        (part if high is None else part.where(F.col("event_id") <= high)).write.mode("append").json(landing)
        if batch == 1:
            try:
                incremental_load(spark, landing, SCHEMA, out, [NUMBERED], [broken])
            except Exception as error:
                if "broken off" not in str(error):
                    raise
        incremental_load(spark, landing, SCHEMA, out, [NUMBERED])
    return read_fact(spark, out, "numbered")


CITY = T.StructType(
    [
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_mktsegment", T.StringType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_custkey", T.LongType()),
    ]
)
BALANCES = RollUp(
    "balances",
    ["c_nationkey", "c_mktsegment"],
    averages=["avg_key"],
    sums=["cents", "cnt"],
    prepare=lambda staged: staged.select(
        "c_nationkey", "c_mktsegment", F.col("c_custkey").alias("avg_key"), F.round(F.col("c_acctbal") * 100).cast("long").alias("cents"), F.lit(1).alias("cnt")
    ),
)


@query(
    "stream_rollup",
    """
    SELECT c_nationkey, c_mktsegment, avg(c_custkey) AS avg_key, sum(round(c_acctbal * 100)::BIGINT)::BIGINT AS cents, count(*) AS cnt
    FROM customer GROUP BY 1, 2
    """,
)
def stream_rollup(spark, sf_dir):
    """Files of three runs, the last one late for keys that are long there; batches are merged in between."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "incremental")
    rows = table(spark, sf_dir, "customer").select(*CITY.names)
    for part in (1, 2, 0):
        rows.where(F.col("c_custkey") % 3 == part).repartition(2, "c_custkey").write.mode("append").json(landing)
        incremental_load(spark, landing, CITY, out, rollups=[BALANCES], max_files=1)
        if part == 2:
            compact_rollup(spark, out, BALANCES)
    return read_rollup(spark, out, BALANCES)


def _star(spark, sf_dir):
    """Two runs: the whole catalogue each time, and half the log."""
    star = IncrementalStar(scratch_path(spark, "incremental-star"), event_order=EVENT_ORDER, catalogue_order=CATALOGUE_ORDER)
    songs, logs = scratch_path(spark, "landing-songs"), scratch_path(spark, "landing-logs")
    log = event_log(spark, sf_dir)
    for late in (False, True):
        catalogue(spark, sf_dir).repartition("song_id").write.mode("append").json(songs, compression="gzip")
        log.where((F.col("sessionId") % 2 == 0) == late).write.mode("append").json(logs, compression="gzip")
        star.load(spark, songs, logs)
    return star


def _register_star(name: str, sql: str, columns: list[str]) -> None:
    @query(f"stream_star_{name}", f"WITH {BASE} {sql}")
    def run(spark, sf_dir):
        return _star(spark, sf_dir).read(spark, name).select(*columns)


_PLAYS = ["start_time", "user_id", *FACT_TAIL.split(", ")]
_register_star("songplays", f"SELECT {', '.join(_PLAYS)} FROM ({TABLES['rowwise']['songplays']})", _PLAYS)
for _name in ("users", "artists"):
    _register_star(_name, TABLES["rowwise"][_name], list(STAR_COLUMNS[_name]))
