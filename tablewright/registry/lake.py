"""The arrivals lake on derived records, demographics and airports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright import schemas
from tablewright.operators import concat_rows
from tablewright.plans import build_lake, lake_tables
from tablewright.plans.lake import I94, RESIDENT, VISAS, records_at_airports, records_in_states
from tablewright.registry.base import query
from tablewright.registry.derived import (
    AIRPORTS_SQL,
    ARRIVALS_SQL,
    DEMOGRAPHICS_SQL,
    airports,
    arrivals,
    demographics,
)
from tablewright.sources import read_csv, read_release, write_csv
from tablewright.storage import scratch_path, stash

BASE = f"WITH rec AS ({ARRIVALS_SQL}), dem AS ({DEMOGRAPHICS_SQL}), air AS ({AIRPORTS_SQL})"
FILED = "TRY_STRPTIME(dtadfile, '%Y%m%d')::DATE"
ADMITTED_TO = "TRY_STRPTIME(dtaddto, '%m%d%Y')::DATE"
I94_SQL = f"""
    SELECT DISTINCT {', '.join(I94)}, {FILED} AS dtadfile_date, {ADMITTED_TO} AS dtaddto_date
    FROM rec WHERE cicid IS NOT NULL
"""
SUMS = ["Male_Pop", "Female_Pop", "Total_Pop", "Num_Veterans", "Num_Foreign_born", "Count"]
STATES_SQL = f"""
    SELECT State, State_Code, Race, round(avg(Median_Age), 4) AS Median_Age,
        round(avg(Avg_Household_Size), 4) AS Avg_Household_Size,
        {', '.join(f'sum({c})::BIGINT AS {c}' for c in SUMS)}
    FROM dem GROUP BY State, State_Code, Race
"""
PLACES_SQL = """
    SELECT DISTINCT * EXCLUDE (coordinates), split_part(coordinates, ', ', 1) AS latitude,
        CASE WHEN contains(coordinates, ', ') THEN split_part(coordinates, ', ', 2) END AS longitude
    FROM air WHERE ident IS NOT NULL
"""

TABLES = {
    "resident_table": f"SELECT DISTINCT {', '.join(RESIDENT)} FROM rec WHERE cicid IS NOT NULL",
    "visas_table": f"SELECT DISTINCT {', '.join(VISAS)} FROM rec WHERE cicid IS NOT NULL",
    "i94_table": I94_SQL,
    "time_table": f"""
        SELECT DISTINCT d AS datetime, day(d)::INT AS day, week(d)::INT AS week, month(d)::INT AS month,
            year(d)::INT AS year, (dayofweek(d)+1)::INT AS weekday
        FROM (SELECT {FILED} AS d FROM rec UNION ALL SELECT {ADMITTED_TO} FROM rec)
    """,
    "cities_table": "SELECT DISTINCT * FROM dem WHERE City IS NOT NULL",
    "states_table": STATES_SQL,
    "airports_table": PLACES_SQL,
}


def _tables(spark, sf_dir):
    return lake_tables(arrivals(spark, sf_dir), demographics(spark, sf_dir), airports(spark, sf_dir))


def _rounded(states):
    return states.withColumns({c: F.round(c, 4) for c in ("Median_Age", "Avg_Household_Size")})


def _register(name: str) -> None:
    @query(f"lake_{name}", f"{BASE} {TABLES[name]}")
    def run(spark, sf_dir):
        df = _tables(spark, sf_dir)[name]
        return _rounded(df) if name == "states_table" else df


for _name in TABLES:
    _register(_name)


def _built(spark, sf_dir, released=False):
    """Records come as Parquet, the rest as delimited files; then all seven tables are written. The folder, and the check report."""
    out = scratch_path(spark, "lake")
    demographics(spark, sf_dir).write.option("sep", ";").option("header", True).csv(f"{out}/raw/demographics")
    write_csv(airports(spark, sf_dir), f"{out}/raw/airports")
    report = build_lake(
        spark,
        stash(arrivals(spark, sf_dir), "records", f"{out}/raw/records"),
        read_csv(spark, f"{out}/raw/demographics", schemas.DEMOGRAPHICS, sep=";"),
        read_csv(spark, f"{out}/raw/airports", schemas.AIRPORTS),
        out,
        released=released,
    )
    return out, report


CHECKS_SQL = " UNION ALL ".join(
    f"""
    SELECT '{name}' AS table_name, 'non_empty' AS check_name, count(*) > 0 AS passed, count(*) || ' rows' AS detail FROM ({sql})
    UNION ALL SELECT '{name}', 'unique_rows', count(*) = (SELECT count(*) FROM (SELECT DISTINCT * FROM ({sql}))),
        count(*) || ' rows, ' || (SELECT count(*) FROM (SELECT DISTINCT * FROM ({sql}))) || ' distinct' FROM ({sql})
    """
    for name, sql in TABLES.items()
)


@query("lake_checked", f"{BASE} {CHECKS_SQL}")
def lake_checked(spark, sf_dir):
    """The check report of the tables that a build has written."""
    return _built(spark, sf_dir)[1]


@query("lake_written", f"{BASE} " + " UNION ALL BY NAME ".join(f"SELECT '{n}' AS table_name, * FROM ({sql})" for n, sql in TABLES.items()))
def lake_written(spark, sf_dir):
    """The rows of all seven tables as they have been written; a column that a table lacks is NULL."""
    out, rows = _built(spark, sf_dir)[0], None
    for name in TABLES:
        own = spark.read.parquet(f"{out}/{name}").withColumn("table_name", F.lit(name))
        own = _rounded(own) if name == "states_table" else own
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
    return rows


@query(
    "lake_released",
    f"{BASE} SELECT i.cicid, i.i94port, a.name, t.day FROM ({I94_SQL}) i JOIN ({PLACES_SQL}) a ON i.i94port = a.iata_code "
    f"JOIN ({TABLES['time_table']}) t ON i.dtadfile_date = t.datetime",
)
def lake_released(spark, sf_dir):
    """Records with airport and calendar, all three tables taken from one release of the lake."""
    seen = read_release(spark, _built(spark, sf_dir, released=True)[0])
    joined = records_at_airports(seen["i94_table"], seen["airports_table"])
    days = seen["time_table"].select(F.col("datetime").alias("dtadfile_date"), "day")
    return joined.join(days, "dtadfile_date").select("cicid", "i94port", "name", "day")


@query(
    "lake_built",
    f"{BASE} " + " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS cnt FROM ({sql})" for n, sql in TABLES.items()),
)
def lake_built(spark, sf_dir):
    """The number of rows of each table that a build has written."""
    out, _ = _built(spark, sf_dir)
    counts = [
        spark.read.parquet(f"{out}/{name}").agg(F.count("*").alias("cnt")).select(F.lit(name).alias("table_name"), "cnt")
        for name in TABLES
    ]
    return concat_rows(*counts)


@query(
    "lake_records_at_airports",
    f"{BASE} SELECT i.cicid, i.i94port, i.dtadfile_date, a.name, a.latitude, a.longitude FROM ({I94_SQL}) i "
    f"JOIN ({PLACES_SQL}) a ON i.i94port = a.iata_code",
)
def lake_records_at_airports(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    joined = records_at_airports(tables["i94_table"], tables["airports_table"])
    return joined.select("cicid", "i94port", "dtadfile_date", "name", "latitude", "longitude")


@query(
    "lake_records_in_states",
    f"{BASE} SELECT i.cicid, i.i94addr, s.Race, s.Total_Pop FROM ({I94_SQL}) i "
    f"JOIN ({STATES_SQL}) s ON i.i94addr = s.State_Code",
)
def lake_records_in_states(spark, sf_dir):
    """A record per race of its state."""
    tables = _tables(spark, sf_dir)
    joined = records_in_states(tables["i94_table"], tables["states_table"])
    return joined.select("cicid", "i94addr", "Race", "Total_Pop")
