"""Point reads and the lookup tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright import schemas
from tablewright.operators import concat_rows, filter_equal
from tablewright.plans import build_lookups
from tablewright.plans.lookup_tables import song_of_item, songs_of_session, users_of_song
from tablewright.registry.base import query, table
from tablewright.registry.derived import EVENT_SQL, event_log
from tablewright.sources import read_parquet, write_csv, write_table
from tablewright.storage import scratch_path


def _clustered_turns(spark, sf_dir, files=None):
    path = scratch_path(spark, "turns")
    write_table(table(spark, sf_dir, "conversations"), path, cluster_by=["conv_id"], sort_by=["turn"], files=files, index=["conv_id"])
    return read_parquet(spark, path)


@query("lookup_by_key", "SELECT role, text FROM conversations WHERE conv_id=1 AND turn=0")
def lookup_by_key(spark, sf_dir):
    """One row of a table of 120 files."""
    return filter_equal(_clustered_turns(spark, sf_dir, files=120), conv_id=1, turn=0).select("role", "text")


@query("lookup_partition_sorted", "SELECT turn, role, text FROM conversations WHERE conv_id=1 ORDER BY turn")
def lookup_partition_sorted(spark, sf_dir):
    return filter_equal(_clustered_turns(spark, sf_dir), conv_id=1).orderBy("turn").select("turn", "role", "text")


@query("lookup_indexed", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_custkey=10")
def lookup_indexed(spark, sf_dir):
    """Files are ranges of days, so each may hold any customer: the index of the customers says which do."""
    path = scratch_path(spark, "orders")
    write_table(table(spark, sf_dir, "orders"), path, cluster_by=["o_orderdate"], sort_by=["o_orderkey"], files=120, index=["o_custkey"])
    return filter_equal(read_parquet(spark, path), o_custkey=10).select("o_orderkey", "o_orderdate", "o_totalprice")


@query(
    "lookup_inverted",
    """
    SELECT DISTINCT c.c_custkey, c.c_name FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey
    JOIN customer c ON o.o_custkey=c.c_custkey WHERE l.l_partkey=10
    """,
)
def lookup_inverted(spark, sf_dir):
    """Users are made distinct by key before their names are fetched."""
    lines = filter_equal(table(spark, sf_dir, "lineitem"), l_partkey=10).select("l_orderkey").dropDuplicates()
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    buyers = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return customers.join(buyers, F.col("c_custkey") == F.col("o_custkey"), "left_semi")


# Of rows with one key the last by these columns stays, settled by the values on ties.
ORDER = ("sessionId", "itemInSession")
EVENTS = f"WITH log AS (SELECT * FROM ({EVENT_SQL}) WHERE page = 'NextSong' AND userId <> '')"
PLAIN = {
    "music_history": (
        ["sessionId", "itemInSession"],
        {"sessionId": "sessionId::INT", "itemInSession": "itemInSession::INT", "artist_name": "artist",
         "song_title": "song", "song_length": "length"},
    ),
    "user_history": (
        ["userId", "sessionId", "itemInSession"],
        {"userId": "userId::INT", "sessionId": "sessionId::INT", "itemInSession": "itemInSession::INT",
         "song_title": "song", "artist_name": "artist", "firstName": "firstName", "lastName": "lastName"},
    ),
    "song_playlist_session": (
        ["song_title", "userId"],
        {"song_title": "song", "userId": "userId::INT", "firstName": "firstName", "lastName": "lastName"},
    ),
}


def _lookup_sql(name: str) -> str:
    key, columns = PLAIN[name]
    ties = [*(f"log.{c}" for c in ORDER), *(expr for c, expr in columns.items() if c not in key)]
    return f"""
        {EVENTS} SELECT {', '.join(f'{expr} AS {c}' for c, expr in columns.items())} FROM log
        QUALIFY row_number() OVER (PARTITION BY {', '.join(columns[c] for c in key)}
            ORDER BY {', '.join(f'{c} DESC' for c in ties)}) = 1
    """


def _built(spark, sf_dir, only=tuple(PLAIN)):
    """Plays as a folder of CSV files, then consolidated and loaded into the lookup tables."""
    raw = scratch_path(spark, "event-csv")
    plays = event_log(spark, sf_dir).filter((F.col("page") == "NextSong") & (F.col("userId") != ""))
    write_csv(plays.select(*[F.col(f.name).cast(f.dataType) for f in schemas.EVENT_CSV.fields]), raw, compression="gzip")
    return build_lookups(spark, raw, scratch_path(spark, "lookups"), ORDER, only)


def _register(name: str) -> None:
    @query(f"lookups_{name}", _lookup_sql(name))
    def run(spark, sf_dir):
        return _built(spark, sf_dir, [name])[name]


for _name in PLAIN:
    _register(_name)


@query(
    "lookups_song_of_item",
    f"SELECT artist_name, song_title, song_length FROM ({_lookup_sql('music_history')}) WHERE sessionId=7 AND itemInSession=1",
)
def lookups_song_of_item(spark, sf_dir):
    return song_of_item(_built(spark, sf_dir, ["music_history"])["music_history"], 7, 1)


@query(
    "lookups_songs_of_session",
    f"SELECT artist_name, song_title, firstName, lastName FROM ({_lookup_sql('user_history')}) "
    "WHERE userId=899 AND sessionId=0 ORDER BY itemInSession",
)
def lookups_songs_of_session(spark, sf_dir):
    return songs_of_session(_built(spark, sf_dir, ["user_history"])["user_history"], 899, 0)


@query(
    "lookups_users_of_song",
    f"SELECT firstName, lastName FROM ({_lookup_sql('song_playlist_session')}) WHERE song_title='small ring ECONOMY'",
)
def lookups_users_of_song(spark, sf_dir):
    return users_of_song(_built(spark, sf_dir, ["song_playlist_session"])["song_playlist_session"], "small ring ECONOMY")


@query(
    "lookups_built",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS cnt FROM ({_lookup_sql(name)})" for name in PLAIN
    ),
)
def lookups_built(spark, sf_dir):
    """All three tables from one consolidation."""
    counts = [
        df.agg(F.count("*").alias("cnt")).select(F.lit(name).alias("table_name"), "cnt")
        for name, df in _built(spark, sf_dir).items()
    ]
    return concat_rows(*counts)
