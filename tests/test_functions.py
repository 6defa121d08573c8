"""Edge values of the column functions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from railtide.functions import times, values


def apply(spark, column, data, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_parse_timestamp_is_day_first_and_null_on_junk(spark):
    got = apply(spark, times.parse_timestamp,
                ["03.04.2024 05:06", "03.04.2024 05:06:07", "2024-04-03 05:06:07", "03.04.2024", "3.4.2024 5:06",
                 "31.02.2024 00:00", "junk", "", None], "string")
    day = datetime(2024, 4, 3)
    assert got == [day.replace(hour=5, minute=6), day.replace(hour=5, minute=6, second=7),
                   day.replace(hour=5, minute=6, second=7), day, day.replace(hour=5, minute=6),
                   None, None, None, None]


def test_parse_timestamp_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Zurich")
    try:
        # This time does not exist in that zone.
        assert apply(spark, times.parse_timestamp, ["31.03.2024 02:30"], "string") == [datetime(2024, 3, 31, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_delay_class_edges(spark):
    got = apply(spark, values.delay_class, [-301.0, -300.0, -299.0, -60.0, -59.0, 60.0, 61.0, 300.0, 301.0, 600.0, 601.0, None], "double")
    assert got == ["very_early", "very_early", "early", "early", "on_time", "on_time", "slight_delay", "slight_delay",
                   "moderate_delay", "moderate_delay", "severe_delay", None]


def test_flags(spark):
    assert apply(spark, values.encode_flag, ["true", "TRUE", "False", "", None], "string") == [1, 1, 0, None, None]


def test_day_periods_wrap_midnight(spark):
    names = apply(spark, values.day_period, [3, 4, 6, 7, 9, 10, 15, 16, 18, 19, 22, 23, 0], "int")
    assert [n.split(" (")[0] for n in names] == [
        "Night", "Early Morning", "Early Morning", "Morning Rush", "Morning Rush", "Midday", "Midday",
        "Evening Rush", "Evening Rush", "Evening", "Evening", "Night", "Night"]


def test_rush_hours(spark):
    assert apply(spark, values.is_rush_hour, [6, 7, 9, 10, 15, 16, 18, 19, None], "int") == [0, 1, 1, 0, 0, 1, 1, 0, 0]


@pytest.mark.parametrize("month, dow, expected", [
    (1, 0, date(2024, 1, 7)), (1, 6, date(2024, 1, 6)), (9, 0, date(2024, 9, 1)), (9, 6, date(2024, 9, 7))])
def test_synthetic_datetime_falls_one_weekday_early(spark, month, dow, expected):
    df = spark.createDataFrame([(month, dow, 61)], "m int, d int, x int")
    got = df.select(times.synthetic_datetime(F.col("m"), F.col("d"), F.col("x"))).first()[0]
    assert got == datetime(expected.year, expected.month, expected.day, 1, 1)


def test_synthetic_datetime_without_place_is_null(spark):
    df = spark.createDataFrame([(13, 0, 0), (0, 0, 0), (None, 1, 1), (1, None, 1), (1, 1, None)], "m int, d int, x int")
    got = df.select(times.synthetic_datetime(F.col("m"), F.col("d"), F.col("x"))).collect()
    assert [r[0] for r in got] == [None] * 5


def test_delay_keeps_parts_of_seconds(spark):
    a, b = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1, 500000)
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    ahead, behind = df.select(times.delay_seconds(F.col("a"), F.col("b")),
                              times.delay_seconds(F.col("a"), F.col("b"), actual_first=False)).first()
    assert (ahead, behind) == (1.5, -1.5)


def test_on_time_counts_missing_as_late(spark):
    assert apply(spark, values.is_on_time, [60.0, -60.0, 61.0, None], "double") == [True, True, False, False]


def test_floor_hours(spark):
    got = apply(spark, times.floor_hours, [datetime(2024, 1, 1, 2, 59), datetime(2024, 1, 1, 23, 1)], "timestamp_ntz")
    assert got == [datetime(2024, 1, 1), datetime(2024, 1, 1, 21)]


def test_differences_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([("2024-03-31 01:58:00", "2024-03-31 03:02:00.25")], "a string, b string").selectExpr(
        "cast(a as timestamp_ntz) a", "cast(b as timestamp_ntz) b")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Zurich")
    try:
        assert df.select(times.delay_seconds(F.col("a"), F.col("b"))).first()[0] == 3840.25
        got = df.select(times.synthetic_datetime(F.lit(3), F.lit(6), F.lit(150)).cast("string"),
                        values.journey_id("date_line", F.col("a"), F.lit(7), F.lit(118))).first()
        assert tuple(got) == ("2024-03-02 02:30:00", "2024-03-31_7_0")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
