from datetime import date

import pytest
from conftest import rows

from tablewright import schemas
from tablewright.plans import build_lake, lake_tables
from tablewright.plans.lake import records_at_airports, records_in_states, split_coordinates
from tablewright.sources import read_csv


def record(cicid, **other):
    row = dict.fromkeys(schemas.ARRIVALS.names)
    row.update(cicid=cicid, i94yr=2016.0, admnum=1.5, gender="F", i94port="NYC", i94addr="NY", visatype="B2", **other)
    return tuple(row[c] for c in schemas.ARRIVALS.names)


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    records = spark.createDataFrame(
        [
            record(1.0, dtadfile="20160430", dtaddto="10292016"),
            record(1.0, dtadfile="20160430", dtaddto="10292016"),
            record(2.0, dtadfile="20160501", dtaddto="D/S"),
            record(3.0, dtadfile="2016", dtaddto="04302016"),
            record(None, dtadfile=None, dtaddto=None),
        ],
        schemas.ARRIVALS,
    )
    cities = spark.createDataFrame(
        [
            ("Here", "New York", 30.0, 10, 20, 30, 1, 2, 2.5, "NY", "White", 5),
            ("There", "New York", 40.0, 1, 2, 3, None, 2, 3.5, "NY", "White", 6),
            ("There", "New York", 40.0, 1, 2, 3, None, 2, 3.5, "NY", "Asian", 7),
            ("Else", "Ohio", 20.0, 1, 1, 2, 1, 1, 2.0, "OH", "White", 8),
            (None, "Ohio", None, None, None, None, None, None, None, "OH", "White", None),
        ],
        schemas.DEMOGRAPHICS,
    )
    names = schemas.AIRPORTS.names
    blank = dict.fromkeys(names)
    airports = spark.createDataFrame(
        [
            tuple({**blank, **a}[c] for c in names)
            for a in (
                {"ident": "K1", "name": "One", "iata_code": "NYC", "coordinates": "-73.9, 40.7"},
                {"ident": "K1", "name": "One", "iata_code": "NYC", "coordinates": "-73.9, 40.7"},
                {"ident": "K2", "name": "Two", "coordinates": "-73.9"},
                {"ident": "K3", "name": "Three", "coordinates": ""},
                {"ident": "K4", "name": "Four"},
                {"name": "No ident", "coordinates": "1, 2"},
            )
        ],
        schemas.AIRPORTS,
    )
    root = tmp_path_factory.mktemp("sources")
    frames = []
    for name, df in (("records", records), ("cities", cities), ("airports", airports)):
        df.coalesce(1).write.parquet(f"{root}/{name}")
        frames.append(spark.read.parquet(f"{root}/{name}"))
    return tuple(frames)


def test_tables(sources):
    tables = lake_tables(*sources)
    assert {name: df.count() for name, df in tables.items()} == {
        "resident_table": 1,
        "visas_table": 3,
        "i94_table": 3,
        "time_table": 4,
        "cities_table": 4,
        "states_table": 3,
        "airports_table": 4,
    }
    assert "cicid" not in tables["resident_table"].columns
    assert rows(tables["i94_table"].select("cicid", "dtadfile", "dtadfile_date", "dtaddto_date")) == [
        (1.0, "20160430", date(2016, 4, 30), date(2016, 10, 29)),
        (2.0, "20160501", date(2016, 5, 1), None),
        (3.0, "2016", None, date(2016, 4, 30)),
    ]
    assert rows(tables["time_table"])[0] == (None,) * 6
    assert (date(2016, 10, 29), 29, 43, 10, 2016, 7) in rows(tables["time_table"])
    assert rows(tables["states_table"].filter("State = 'New York'")) == [
        ("New York", 35.0, 11, 22, 33, 1, 4, 3.0, "NY", "White", 11),
        ("New York", 40.0, 1, 2, 3, None, 2, 3.5, "NY", "Asian", 7),
    ]
    assert rows(tables["airports_table"].select("ident", "latitude", "longitude")) == [
        ("K1", "-73.9", "40.7"), ("K2", "-73.9", None), ("K3", "", None), ("K4", None, None),
    ]


def test_coordinates_as_numbers(sources):
    found = split_coordinates(sources[2], as_double=True).filter("ident is not null").dropDuplicates()
    assert rows(found.select("ident", "latitude", "longitude")) == [
        ("K1", -73.9, 40.7), ("K2", -73.9, None), ("K3", None, None), ("K4", None, None),
    ]


def test_build_and_query(spark, sources, tmp_path):
    records, cities, airports = sources
    cities.write.option("sep", ";").option("header", True).csv(f"{tmp_path}/raw/cities")
    airports.write.option("header", True).csv(f"{tmp_path}/raw/airports")
    report = build_lake(
        spark,
        records,
        read_csv(spark, f"{tmp_path}/raw/cities", schemas.DEMOGRAPHICS, sep=";"),
        read_csv(spark, f"{tmp_path}/raw/airports", schemas.AIRPORTS),
        str(tmp_path / "out"),
        check=True,
    )
    assert {r.check_name for r in report.collect()} == {"non_empty", "unique_rows"}
    assert report.count() == 14
    written = {n: spark.read.parquet(f"{tmp_path}/out/{n}") for n in ("i94_table", "airports_table", "states_table", "time_table")}
    assert written["time_table"].filter("datetime is null and year is null").count() == 1
    assert records_at_airports(written["i94_table"], written["airports_table"]).count() == 3
    # a row per race of the state
    assert records_in_states(written["i94_table"], written["states_table"]).count() == 6


def test_dates_of_the_calendar_are_parsed_once_per_text(sources):
    text = lake_tables(*sources)["time_table"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [dtadfile" in text
