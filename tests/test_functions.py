"""Columns: bounds, missing values and odd input."""

from datetime import date, datetime, time

import pytest
from pyspark.sql import functions as F

from headway.functions import bands, texts, times
from headway.functions.geometry import manhattan_km


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "json, expected",
    [
        ('"2025-05-11T08:00:00"', datetime(2025, 5, 11, 8)),
        ('"2025-05-11 08:00:00.5"', datetime(2025, 5, 11, 8, 0, 0, 500000)),
        ('"2025-05-11T08:00:00+02:00"', datetime(2025, 5, 11, 6)),
        ("1715414400", datetime(2024, 5, 11, 8)),
        ("1715414400.25", datetime(2024, 5, 11, 8, 0, 0, 250000)),
        ("9999999999999999", None),
        ("1e300", None),
        ('"2025"', None),
        ('"1715414400"', None),
        ('"soon"', None),
        ('""', None),
        ("true", None),
        ("null", None),
        (None, None),
    ],
)
def test_parse_time(spark, json, expected):
    value = F.try_parse_json(F.lit(json).cast("string"))
    assert one(spark, times.parse_time(value)) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-05-11T02:00:00+02:00", datetime(2025, 5, 11)),
        ("2025-05-11T02:00:00.25-0130", datetime(2025, 5, 11, 3, 30, 0, 250000)),
        ("2025-05-11 02:00:00Z", datetime(2025, 5, 11, 2)),
        ("2025-05-11T02:00", datetime(2025, 5, 11, 2)),
        ("2025-05-11", datetime(2025, 5, 11)),
    ],
)
def test_parse_timestamp_with_a_zone(spark, text, expected):
    assert one(spark, times.parse_timestamp(F.lit(text))) == expected


def test_ids_of_missing_parts_differ(spark):
    null = F.lit(None).cast("string")
    first = one(spark, texts.composite_id(null, F.lit("A"), F.lit(1)))
    assert first == "None-A-1" != one(spark, texts.composite_id(F.lit("A"), null, F.lit(1)))


def test_parse_timestamp_gives_null_for_bad_text(spark):
    assert one(spark, times.parse_timestamp(F.lit("31/12/2025"))) is None


@pytest.mark.parametrize(
    "moment, data, forecast, form",
    [
        ("2025-05-16 06:59:59", False, False, False),
        ("2025-05-16 07:00:00", True, True, True),
        ("2025-05-16 09:00:00", True, True, True),
        ("2025-05-16 09:00:01", False, True, True),
        ("2025-05-16 09:59:59", False, True, True),
        ("2025-05-16 16:30:00", True, False, True),
        ("2025-05-16 18:30:00", False, True, True),
        ("2025-05-16 19:59:00", False, True, False),
    ],
)
def test_peak_rules(spark, moment, data, forecast, form):
    rules = [times.is_peak(ts(moment), rule) for rule in ("data", "forecast", "form")]
    assert [one(spark, rule) for rule in rules] == [data, forecast, form]


@pytest.mark.parametrize(
    "day, weekend", [("2025-05-16", False), ("2025-05-17", True), ("2025-05-18", True)]
)
def test_weekend(spark, day, weekend):
    assert one(spark, times.is_weekend(ts(day))) is weekend


def test_seconds_drop_fractions(spark):
    assert one(spark, times.seconds_of_day(ts("2025-05-16 01:00:01.9"))) == 3601


def test_sine_time(spark):
    assert one(spark, times.sine_time(ts("2025-05-16 06:00:00"))) == pytest.approx(1.0)
    assert one(spark, times.sine_time(ts("2025-05-16 00:00:00"))) == 0.0


@pytest.mark.parametrize(
    "moment, inside",
    [
        ("2025-05-16 06:00:00", True),
        ("2025-05-16 05:59:59.999999", False),
        ("2025-05-16 22:00:00", True),
        ("2025-05-16 22:00:00.5", False),
        ("2025-05-17 10:00:00", False),
    ],
)
def test_between_times(spark, moment, inside):
    column = times.between_times(ts(moment), date(2025, 5, 16), time(6), time(22))
    assert one(spark, column) is inside


def test_hour_spine(spark):
    day = date(2025, 5, 16)
    hours = one(spark, times.hour_spine(day, time(6), time(22)))
    assert len(hours) == 17
    assert (hours[0], hours[-1]) == (datetime(2025, 5, 16, 6), datetime(2025, 5, 16, 22))
    assert one(spark, times.hour_spine(day, time(6), time(6))) == [datetime(2025, 5, 16, 6)]
    assert one(spark, times.hour_spine(day, time(9), time(6))) == []


def test_time_grid(spark):
    grid = one(spark, times.time_grid(ts("2025-05-16 23:50:00"), 30, 15))
    assert grid == [datetime(2025, 5, 16, 23, 50), datetime(2025, 5, 17, 0, 5)]
    assert one(spark, times.time_grid(ts("2025-05-16 23:50:00"), 10, 15)) == []


def test_hour_start_in_a_zone_with_summer_time(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Rome")
        # This local time does not exist in the zone; a zone-free timestamp can hold it.
        assert one(spark, times.hour_start(ts("2025-03-30 02:30:00"))) == datetime(2025, 3, 30, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize(
    "normal, traffic, level",
    [
        (100, 90, "no traffic/low"),
        (100, 110, "no traffic/low"),
        (1000, 1101, "medium"),
        (100, 130, "medium"),
        (1000, 1301, "heavy"),
        (10000, 19999, "heavy"),
        (100, 200, "severe/standstill"),
        (777, 814, "no traffic/low"),
        (660, 749, "medium"),
        (0, 10, None),
        (None, 10, None),
    ],
)
def test_traffic_level(spark, normal, traffic, level):
    delay = bands.delay_percent(F.lit(normal).cast("int"), F.lit(traffic))
    assert one(spark, bands.traffic_level(delay)) == level


def test_traffic_code(spark):
    names = ["no traffic/low", "medium", "heavy", "severe/standstill", "calm"]
    assert [one(spark, bands.traffic_code(F.lit(n))) for n in names] == [0, 1, 2, 3, None]


@pytest.mark.parametrize(
    "rate, color", [(0.7, [255, 0, 0]), (0.4, [255, 255, 0]), (0.39, [0, 255, 0])]
)
def test_colors(spark, rate, color):
    assert one(spark, bands.congestion_color(F.lit(rate))) == color


@pytest.mark.parametrize(
    "rate, status", [(0.8, "High"), (0.79, "Moderate"), (0.3, "Moderate"), (0.29, "Low")]
)
def test_status(spark, rate, status):
    assert one(spark, bands.congestion_status(F.lit(rate))) == status


def test_fares(spark):
    types = ["adult", "student", "senior", "dog"]
    assert [one(spark, bands.fare(F.lit(t))) for t in types] == [2.5, 1.25, 1.0, None]


def test_texts(spark):
    assert one(spark, texts.hour_interval(F.lit(7), F.lit(8))) == "7:00 - 9:00"
    assert one(spark, texts.long_date(F.lit(date(2025, 5, 5)))) == "Monday, 05 May 2025"
    assert one(spark, texts.route_label(F.lit("5"), F.lit("Centre"))) == "5 - Centre"
    assert one(spark, texts.first_character(F.lit("5/"))) == "5"
    assert one(spark, texts.iso_text(ts("2025-05-16 07:29:00"))) == "2025-05-16T07:29:00"
    assert one(spark, texts.composite_id(F.lit("247"), F.lit("5"), F.lit(3))) == "247-5-3"


def test_distance(spark):
    north = manhattan_km(F.lit(46.0), F.lit(11.0), F.lit(46.5), F.lit(11.0))
    assert one(spark, north) == pytest.approx(55.66)
    east = manhattan_km(F.lit(60.0), F.lit(11.0), F.lit(60.0), F.lit(12.0))
    assert one(spark, east) == pytest.approx(55.66)
