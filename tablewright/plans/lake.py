"""Lake of arrival records, city demographics and airports."""

from __future__ import annotations

from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import item_of_split, parse_date
from tablewright.operators import calendar_union, dim_distinct, observe_faults, raise_on_failure, roll_up, run_checks
from tablewright.sources import Load, Release, write_table
from tablewright.sources.ledger import finish_loads
from tablewright.storage import run_together

# Columns of the target tables and the date patterns of the records.
RESIDENT = ["admnum", "i94bir", "occup", "biryear", "gender"]
VISAS = ["cicid", "i94visa", "visapost", "visatype"]
I94 = [
    "cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "i94mode", "i94addr", "depdate",
    "dtadfile", "entdepa", "entdepd", "entdepu", "matflag", "dtaddto", "airline", "admnum", "fltno",
]
STATE_KEYS = ["State", "State_Code", "Race"]
STATE_AVERAGES = ["Median_Age", "Avg_Household_Size"]
STATE_SUMS = ["Male_Pop", "Female_Pop", "Total_Pop", "Num_Veterans", "Num_Foreign_born", "Count"]
FILED = ("dtadfile", "yyyyMMdd")
ADMITTED_TO = ("dtaddto", "MMddyyyy")

PARTITIONS = {"time_table": ("year", "month")}


def with_dates(records: DataFrame) -> DataFrame:
    """Add the two dates as dates beside their text; text that is no date gives NULL."""
    return records.withColumns({f"{c}_date": parse_date(c, pattern) for c, pattern in (FILED, ADMITTED_TO)})


def split_coordinates(airports: DataFrame, as_double: bool = False) -> DataFrame:
    """Replace ``coordinates`` by its first and second item."""
    kind = "double" if as_double else "string"
    items = {
        name: item_of_split("coordinates", ", ", i).try_cast(kind) for i, name in enumerate(("latitude", "longitude"))
    }
    return airports.withColumns(items).drop("coordinates")


def lake_tables(records: DataFrame, demographics: DataFrame, airports: DataFrame) -> dict[str, DataFrame]:
    """The seven tables as frames."""
    # the two texts repeat over the records, so the different ones are taken before they are parsed
    dated = with_dates(records.select(FILED[0], ADMITTED_TO[0]).dropDuplicates())
    date_columns = ["dtadfile_date", "dtaddto_date"]
    places = split_coordinates(airports)
    return {
        "resident_table": dim_distinct(records.filter(F.col("cicid").isNotNull()), RESIDENT),
        "visas_table": dim_distinct(records, VISAS, not_null=["cicid"]),
        "i94_table": with_dates(dim_distinct(records, I94, not_null=["cicid"])),
        "time_table": calendar_union((dated, date_columns)),
        "cities_table": dim_distinct(demographics, demographics.columns, not_null=["City"]),
        "states_table": roll_up(demographics, STATE_KEYS, STATE_AVERAGES, STATE_SUMS),
        "airports_table": dim_distinct(places, places.columns, not_null=["ident"]),
    }


def build_lake(
    spark: SparkSession,
    records: DataFrame,
    demographics: DataFrame,
    airports: DataFrame,
    out: str,
    check: bool = False,
    released: bool = False,
) -> DataFrame:
    """Write the seven tables below ``out`` and return the check report for all of them.

    All are written aside, counted meanwhile, and then put in the place of older ones together; a build that breaks off before leaves
    the old tables as they were. The checks scan each table once, for repeated rows.

    ``released`` makes the tables a release of ``out`` instead, to be read with ``read_release``: readers then see all seven change at
    one moment, and only if the checks pass where ``check`` is set.
    """
    tables, out = lake_tables(records, demographics, airports), out.rstrip("/")
    this: Load | Release
    if released:
        this = Release(spark, out)
    else:
        finish_loads(spark, out)
        this = Load(spark, out, uuid4().hex, fresh=True)
    seen = {}

    def write(name: str, df: DataFrame) -> None:
        def observe(rows: DataFrame) -> DataFrame:
            rows, seen[name] = observe_faults(rows, {})
            return rows

        write_table(df, this.path(name), PARTITIONS.get(name, ()), observe=observe)

    run_together(spark, [partial(write, name, df) for name, df in tables.items()])
    counts = {name: mark.get for name, mark in seen.items()}
    if isinstance(this, Release):
        report = run_checks(spark, f"{out}/{this.folder}", list(tables), counts=counts)
        if check:
            raise_on_failure(report)
        this.publish()
        return report
    this.publish({"counts": counts})
    report = run_checks(spark, out, list(tables), counts=counts)
    if check:
        raise_on_failure(report)
    return report


def records_at_airports(i94: DataFrame, airports: DataFrame) -> DataFrame:
    """Arrival records with the airport of their port code; all columns of both."""
    return i94.join(airports, F.col("i94port") == F.col("iata_code"))


def records_in_states(i94: DataFrame, states: DataFrame) -> DataFrame:
    """Arrival records with their state's figures: a row per race of the state."""
    return i94.join(states, F.col("i94addr") == F.col("State_Code"))
