from datetime import date, datetime, timedelta
from decimal import Decimal
from hashlib import md5

import pytest
from conftest import millis
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.functions import (
    blank_to_null,
    calendar_parts,
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


def one(spark, value, kind, *columns):
    return tuple(spark.createDataFrame([(value,)], f"x {kind}").select(*columns).first())


def test_epoch_kept_and_cut(spark):
    ms = millis("2018-11-01T21:07:13.457")
    kept, cut = one(spark, ms, "bigint", from_epoch_millis("x"), from_epoch_millis_cut("x"))
    assert kept == datetime(2018, 11, 1, 21, 7, 13, 457000)
    assert cut == datetime(2018, 11, 1, 21, 7, 13)
    assert one(spark, None, "bigint", from_epoch_millis("x"), from_epoch_millis_cut("x")) == (None, None)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    """02:30 on that day does not exist in New York."""
    wall = datetime(2024, 3, 10, 2, 30, 1, 999999)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(millis("2024-03-10T02:30:01.999"),)], "x bigint")
        df = df.select("x", from_epoch_millis("x").alias("t"))
        found = df.select(
            F.col("t").cast("string"), epoch_millis("t"), timestamp_text("t"), *calendar_parts("t")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found[:3] == ("2024-03-10 02:30:01.999", millis("2024-03-10T02:30:01.999"), "2024-03-10 02:30:01")
    assert found[3:] == (2, 10, 10, 3, 2024, 6)
    assert wall.weekday() == 6


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.datetimes(datetime(1970, 1, 1), datetime(2100, 1, 1)), min_size=1, max_size=20))
def test_calendar_parts_against_datetime(spark, times):
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    found = df.select("t", epoch_millis("t"), cut_to_second("t"), *calendar_parts("t", "mon0")).collect()
    for row, t in zip(found, times, strict=True):
        assert row[1] == (t - datetime(1970, 1, 1)) // timedelta(milliseconds=1)
        assert row[2] == t.replace(microsecond=0)
        assert tuple(row[3:]) == (t.hour, t.day, t.isocalendar().week, t.month, t.year, t.weekday())


def test_weekday_conventions_and_text_parts(spark):
    sunday = datetime(2018, 12, 30, 5)
    numbers = [
        one(spark, sunday, "timestamp_ntz", calendar_parts("x", kind)[-1])[0] for kind in ("mon0", "sun0", "sun1")
    ]
    assert numbers == [6, 0, 1]
    assert one(spark, sunday, "timestamp_ntz", *calendar_parts("x", "sun0", ["month", "weekday"])) == (
        5, 30, 52, "12", 2018, "0",
    )
    with pytest.raises(ValueError, match="weekday convention"):
        calendar_parts("x", "sat0")


def test_iso_week_one_in_december(spark):
    assert one(spark, datetime(2018, 12, 31), "timestamp_ntz", calendar_parts("x")[2]) == (1,)


@pytest.mark.parametrize("text", ["", "D/S", "2018", "20181301", "02302018", None])
def test_bad_dates_are_null(spark, text):
    assert one(spark, text, "string", parse_date("x", "MMddyyyy"), parse_date("x", "yyyyMMdd")) == (None, None)


def test_good_dates(spark):
    assert one(spark, "20160430", "string", parse_date("x", "yyyyMMdd")) == (date(2016, 4, 30),)
    assert one(spark, "10292016", "string", parse_date("x", "MMddyyyy")) == (date(2016, 10, 29),)


@pytest.mark.parametrize(
    ("text", "items"),
    [("-74.9, 40.1", ("-74.9", "40.1")), ("-74.9", ("-74.9", None)), ("", ("", None)), (None, (None, None))],
)
def test_item_of_split(spark, text, items):
    assert one(spark, text, "string", item_of_split("x", ", ", 0), item_of_split("x", ", ", 1)) == items


def test_split_takes_the_delimiter_literally(spark):
    assert one(spark, "a.b|c", "string", item_of_split("x", "|", 1), item_of_split("x", ".", 0)) == ("c", "a")


def test_text_casts(spark):
    assert one(spark, "", "string", blank_to_null("x"), cast_or_null("x", "int")) == (None, None)
    assert one(spark, "12", "string", blank_to_null("x"), cast_or_null("x", "int")) == ("12", 12)


def test_content_key(spark):
    df = spark.createDataFrame([(137, datetime(2018, 11, 1, 21, 7, 13)), (None, datetime(2018, 1, 1))], "a int, b timestamp_ntz")
    found = [r[0] for r in df.select(content_key("a", "b")).collect()]
    assert found == [md5(b"1372018-11-01 21:07:13").hexdigest(), None]


@pytest.mark.parametrize(("value", "whole"), [(246.6, 246), (-1.9, -1), (None, None)])
def test_whole_decimal_cuts(spark, value, whole):
    found = one(spark, value, "double", whole_decimal("x"))[0]
    assert found == (None if whole is None else Decimal(whole))
