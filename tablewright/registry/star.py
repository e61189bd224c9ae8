"""The star schema in its four profiles, on the derived event log and catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import concat_rows
from tablewright.plans import PROFILES, build_star, star_tables
from tablewright.registry.base import query
from tablewright.registry.derived import CATALOGUE_SQL, EVENT_SQL, catalogue, event_log
from tablewright.schemas import PRIMARY_KEYS, REQUIRED, STAR_COLUMNS
from tablewright.storage import scratch_path, stash

EVENT_ORDER = ("ts", "sessionId", "itemInSession")
CATALOGUE_ORDER = ("duration", "title")

BASE = f"log AS ({EVENT_SQL}), cat AS ({CATALOGUE_SQL})"
MS = "make_timestamp(ts * 1000)"
SECOND = "make_timestamp(ts // 1000 * 1000000)"
INT_USER = "TRY_CAST(userId AS INT)"
PLAYED = "page = 'NextSong'"
FACT_TAIL = "level, song_id, artist_id, session_id, location, user_agent"
ROW_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in ("start_time", "session_id", "user_id", "level", "song_id", "artist_id", "location", "user_agent")
)

SONGS_FIRST = """
    SELECT song_id, title, artist_id, year, duration FROM cat
    QUALIFY row_number() OVER (PARTITION BY song_id ORDER BY duration, title, artist_id, year) = 1
"""
ARTISTS_LAST = """
    SELECT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude,
        artist_longitude AS longitude FROM cat
    QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY duration DESC, title DESC, artist_location DESC,
        artist_latitude DESC NULLS LAST, artist_longitude DESC NULLS LAST) = 1
"""
ARTISTS_DISTINCT = (
    "SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude, "
    "artist_longitude AS longitude FROM cat"
)
SONGS_DISTINCT = "SELECT DISTINCT song_id, title, artist_id, year, duration FROM cat"


def users_distinct(user_id: str, where: str) -> str:
    return (
        f"SELECT DISTINCT {user_id} AS user_id, firstName AS first_name, lastName AS last_name, gender, level "
        f"FROM log WHERE {where}"
    )


def calendar_sql(source: str, weekday: str, distinct: bool, text: bool) -> str:
    kind = "VARCHAR" if text else "INT"
    return f"""
        SELECT {'DISTINCT' if distinct else ''} t AS start_time, hour(t)::INT AS hour, day(t)::INT AS day,
            week(t)::INT AS week, month(t)::{kind} AS month, year(t)::INT AS year, ({weekday})::{kind} AS weekday
        FROM ({source})
    """


def play_columns(start: str, user_id: str) -> str:
    return (
        f"{start} AS start_time, {user_id} AS user_id, level, song_id, artist_id, sessionId AS session_id, "
        "location, userAgent AS user_agent"
    )


ROWWISE_FACT = f"""
    SELECT {play_columns(MS, INT_USER)} FROM log
    LEFT JOIN (SELECT title, name, duration, min((s.song_id, s.artist_id)) AS pick
               FROM ({SONGS_FIRST}) s JOIN ({ARTISTS_LAST}) a ON s.artist_id = a.artist_id GROUP BY 1, 2, 3) k
        ON log.song = k.title AND log.artist = k.name AND log.length = k.duration
    WHERE {PLAYED}
""".replace("song_id, artist_id, sessionId", "pick[1] AS song_id, pick[2] AS artist_id, sessionId")
WAREHOUSE_FACT = (
    f"SELECT {play_columns(SECOND, INT_USER)} FROM log JOIN cat ON log.artist = cat.artist_name AND log.song = cat.title"
)
LAKE_FACT = f"""
    SELECT {play_columns(SECOND, "userId")} FROM log
    JOIN cat ON log.artist = cat.artist_name AND log.song = cat.title WHERE {PLAYED} AND userId <> ''
"""
SCHEDULED_FACT = f"""
    SELECT {play_columns(SECOND, INT_USER)} FROM log
    LEFT JOIN cat ON log.song = cat.title AND log.artist = cat.artist_name AND log.length = cat.duration WHERE {PLAYED}
"""

TABLES = {
    "rowwise": {
        "songplays": f"SELECT row_number() OVER (ORDER BY {ROW_ORDER}) AS songplay_id, start_time, user_id, {FACT_TAIL} FROM ({ROWWISE_FACT})",
        "users": f"""
            SELECT user_id, min(first_name) AS first_name, min(last_name) AS last_name, min(gender) AS gender,
                arg_max(level, (ts, sessionId, itemInSession, level)) AS level
            FROM (SELECT {INT_USER} AS user_id, firstName AS first_name, lastName AS last_name, gender, level,
                      ts, sessionId, itemInSession FROM log WHERE {PLAYED})
            WHERE user_id IS NOT NULL GROUP BY user_id
        """,
        "songs": SONGS_FIRST,
        "artists": ARTISTS_LAST,
        "time": calendar_sql(f"SELECT {MS} AS t FROM log WHERE {PLAYED}", "isodow(t) - 1", False, True),
    },
    "warehouse": {
        "songplays": f"SELECT row_number() OVER (ORDER BY {ROW_ORDER}) - 1 AS songplay_id, start_time, user_id, {FACT_TAIL} FROM ({WAREHOUSE_FACT})",
        "users": users_distinct(INT_USER, f"{INT_USER} IS NOT NULL"),
        "songs": "SELECT song_id, title, artist_id, year, duration FROM cat",
        "artists": ARTISTS_DISTINCT,
        "time": calendar_sql(f"SELECT start_time AS t FROM ({WAREHOUSE_FACT})", "dayofweek(t)", True, True),
    },
    "lake": {
        "songplays": f"SELECT start_time, user_id, {FACT_TAIL}, year(start_time)::INT AS year, month(start_time)::INT AS month FROM ({LAKE_FACT})",
        "users": users_distinct("userId", f"{PLAYED} AND userId <> ''"),
        "songs": SONGS_DISTINCT,
        "artists": ARTISTS_DISTINCT,
        "time": calendar_sql(f"SELECT {SECOND} AS t FROM log WHERE {PLAYED} AND userId <> ''", "dayofweek(t) + 1", True, False),
    },
    "scheduled": {
        "songplays": f"SELECT md5(concat(session_id::VARCHAR, strftime(start_time, '%Y-%m-%d %H:%M:%S'))) AS songplay_id, start_time, user_id, {FACT_TAIL} FROM ({SCHEDULED_FACT})",
        "users": users_distinct(INT_USER, PLAYED),
        "songs": SONGS_DISTINCT,
        "artists": ARTISTS_DISTINCT,
        "time": calendar_sql(f"SELECT start_time AS t FROM ({SCHEDULED_FACT})", "dayofweek(t)", False, True),
    },
}


def _register(profile: str, name: str) -> None:
    @query(f"star_{profile}_{name}", f"WITH {BASE} {TABLES[profile][name]}")
    def run(spark, sf_dir):
        df = star_tables(
            event_log(spark, sf_dir),
            catalogue(spark, sf_dir),
            profile,
            EVENT_ORDER,
            CATALOGUE_ORDER,
            only=[name],
            number_in_order=True,
        )[name]
        # monotonic ids differ from run to run
        return df.drop("songplay_id") if PROFILES[profile].key == "monotonic" else df


for _profile in PROFILES:
    for _name in STAR_COLUMNS:
        _register(_profile, _name)


def _counts_sql(profile: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{profile}' AS profile, '{name}' AS table_name, count(*) AS cnt FROM ({sql})"
        for name, sql in TABLES[profile].items()
    )


def _register_built(profile: str) -> None:
    @query(f"star_{profile}_built", f"WITH {BASE} {_counts_sql(profile)}")
    def run(spark, sf_dir):
        """Stage and write all tables; the number of rows written."""
        out = scratch_path(spark, f"star-{profile}")
        build_star(
            spark,
            event_log(spark, sf_dir),
            catalogue(spark, sf_dir),
            out,
            profile,
            event_order=EVENT_ORDER,
            catalogue_order=CATALOGUE_ORDER,
        )
        counts = []
        for name in STAR_COLUMNS:
            rows = spark.read.parquet(f"{out}/{name}").agg(F.count("*").alias("cnt"))
            counts.append(rows.select(F.lit(profile).alias("profile"), F.lit(name).alias("table_name"), "cnt"))
        return concat_rows(*counts)


def _report_sql(profile: str) -> str:
    """What the checks of a profile's written tables must report."""
    parts, tables = [], []
    for table, sql in TABLES[profile].items():
        names = dict(zip(STAR_COLUMNS[table], PROFILES[profile].columns[table], strict=True))
        (key,) = PRIMARY_KEYS[table]
        if table == "songplays" and PROFILES[profile].key == "monotonic":
            sql = f"SELECT row_number() OVER () AS songplay_id, * FROM ({sql})"
        tables.append(f"t_{table} AS ({sql})")
        checks = [
            ("non_empty", "n > 0", "n || ' rows'", f"SELECT count(*) AS n FROM t_{table}"),
            (
                "unique_rows",
                "n = d",
                "n || ' rows, ' || d || ' distinct'",
                f"SELECT (SELECT count(*) FROM t_{table}) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM t_{table})) AS d",
            ),
            (
                f"unique_key({names[key]})",
                "n = 0",
                "n || ' repeated keys'",
                f"SELECT count(*) AS n FROM (SELECT {key} FROM t_{table} GROUP BY 1 HAVING count(*) > 1)",
            ),
        ]
        for column in dict.fromkeys([key, *REQUIRED[table]]):
            nulls = f"SELECT count(*) AS n FROM t_{table} WHERE {column} IS NULL"
            checks.append((f"not_null({names[column]})", "n = 0", "n || ' null'", nulls))
        parts += [
            f"SELECT '{table}' AS table_name, '{check}' AS check_name, {passed} AS passed, {detail} AS detail FROM ({counts})"
            for check, passed, detail, counts in checks
        ]
    return f"WITH {BASE}, {', '.join(tables)} " + " UNION ALL ".join(parts)


def _register_written(profile: str) -> None:
    options = {"event_order": EVENT_ORDER, "catalogue_order": CATALOGUE_ORDER}

    @query(f"star_{profile}_checked", _report_sql(profile))
    def checked(spark, sf_dir):
        """The check report of the tables that a load has written."""
        out = scratch_path(spark, f"star-{profile}")
        return build_star(spark, event_log(spark, sf_dir), catalogue(spark, sf_dir), out, profile, **options)

    by_content = PROFILES[profile].key == "md5"
    fact = TABLES[profile]["songplays"]
    columns = f"start_time, user_id, {FACT_TAIL}" + (", songplay_id" if by_content else "")

    @query(f"star_{profile}_written", f"WITH {BASE} SELECT {columns} FROM ({fact})")
    def written(spark, sf_dir):
        """The fact table as it has been written; numbers depend on the order in which rows lie and are left out."""
        out = scratch_path(spark, f"star-{profile}")
        build_star(spark, event_log(spark, sf_dir), catalogue(spark, sf_dir), out, profile, **options)
        names = dict(zip(PROFILES[profile].columns["songplays"], STAR_COLUMNS["songplays"], strict=True))
        rows = spark.read.parquet(f"{out}/songplays").withColumnsRenamed(names)
        return rows.select(*[c for c in STAR_COLUMNS["songplays"] if by_content or c != "songplay_id"])


@query("star_rowwise_appended", f"WITH {BASE} SELECT start_time, user_id, {FACT_TAIL} FROM ({ROWWISE_FACT})")
def star_rowwise_appended(spark, sf_dir):
    """Half the log with the catalogue, then the other half without new songs: the rows of a load in one go."""
    out, log, songs = scratch_path(spark, "star-appended"), event_log(spark, sf_dir), catalogue(spark, sf_dir)
    even = F.col("sessionId") % 2 == 0
    options = {"event_order": EVENT_ORDER, "catalogue_order": CATALOGUE_ORDER}
    build_star(spark, log.where(even), songs, out, "rowwise", **options)
    build_star(spark, log.where(~even), songs.limit(0), out, "rowwise", fresh=False, **options)
    return spark.read.parquet(f"{out}/songplays").drop("songplay_id")


def _register_reloaded(profile: str) -> None:
    options = {"event_order": EVENT_ORDER, "catalogue_order": CATALOGUE_ORDER}
    fact = TABLES[profile]["songplays"]

    def reloaded(spark, sf_dir):
        """Half the log, then the other, each load with a retry: a star of loads that ran once."""
        out, log, songs = scratch_path(spark, f"star-{profile}"), event_log(spark, sf_dir), catalogue(spark, sf_dir)
        even = F.col("sessionId") % 2 == 0
        for half in (log.where(even), log.where(~even)):
            # the retry loads the rows that have come, so they are derived once
            part = stash(half, "half")
            for _ in range(2):
                build_star(spark, part, songs, out, profile, fresh=False, **options)
        return out

    @query(f"star_{profile}_reloaded", f"WITH {BASE} SELECT start_time, user_id, {FACT_TAIL} FROM ({fact})")
    def plays(spark, sf_dir):
        return spark.read.parquet(f"{reloaded(spark, sf_dir)}/songplays").drop("songplay_id")


def _written_dims_sql(profile: str) -> str:
    dims = [f"SELECT '{name}' AS table_name, * FROM ({sql})" for name, sql in TABLES[profile].items() if name != "songplays"]
    return f"WITH {BASE} " + " UNION ALL BY NAME ".join(dims)


def _register_written_dims(profile: str) -> None:
    @query(f"star_{profile}_written_dims", _written_dims_sql(profile))
    def run(spark, sf_dir):
        """The rows of all dimensions as they have been written; a column that a dimension lacks is NULL."""
        out = scratch_path(spark, f"star-{profile}")
        options = {"event_order": EVENT_ORDER, "catalogue_order": CATALOGUE_ORDER}
        build_star(spark, event_log(spark, sf_dir), catalogue(spark, sf_dir), out, profile, **options)
        rows = None
        for name in TABLES[profile]:
            if name == "songplays":
                continue
            names = dict(zip(PROFILES[profile].columns[name], STAR_COLUMNS[name], strict=True))
            own = spark.read.parquet(f"{out}/{name}").withColumnsRenamed(names).withColumn("table_name", F.lit(name))
            rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
        return rows


for _profile in PROFILES:
    _register_built(_profile)
    _register_written(_profile)
    _register_written_dims(_profile)
for _profile in ("rowwise", "warehouse"):
    _register_reloaded(_profile)
