"""Flags, classes and other row-level values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from railtide.constants import DAY_PERIODS, DELAY_CLASSES, NULL_CATEGORY, RUSH_HOURS


def encode_flag(text: Column) -> Column:
    """``true`` / ``false`` in any case to 1 / 0; anything else is null."""
    low = F.lower(text)
    return F.when(low == "true", 1).when(low == "false", 0).cast("tinyint")


def category_text(value: Column, null_token: str = NULL_CATEGORY) -> Column:
    """A category as text; a missing one is a category of its own."""
    return F.coalesce(value.cast("string"), F.lit(null_token))


def to_number(value: Column) -> Column:
    """Double, or null when the value is not a number."""
    return value.try_cast("double")


def to_minutes(seconds: Column) -> Column:
    return seconds / 60


def delay_class(seconds: Column) -> Column:
    """Name of the right-closed delay class; null stays null."""
    *bounded, (_, last) = DELAY_CLASSES
    result = F.when(seconds.isNull(), None)
    for upper, label in bounded:
        result = result.when(seconds <= upper, label)
    return result.otherwise(last)


def day_period(hour: Column) -> Column:
    """Name of the day period of an hour 0-23."""
    result = None
    for label, start, end in DAY_PERIODS:
        inside = (hour >= start) & (hour < end) if start < end else (hour >= start) | (hour < end)
        result = F.when(inside, label) if result is None else result.when(inside, label)
    return result


def is_rush_hour(hour: Column) -> Column:
    inside = reduce(lambda a, b: a | b, (hour.between(lo, hi) for lo, hi in RUSH_HOURS))
    return F.coalesce(inside, F.lit(False)).cast("int")


def is_on_time(seconds: Column, tolerance: int = 60) -> Column:
    """A missing delay is not on time."""
    return F.coalesce(F.abs(seconds) <= tolerance, F.lit(False))


def above(value: Column, threshold: Column) -> Column:
    """``value > threshold`` where an unknown comparison is false."""
    return F.coalesce(value > threshold, F.lit(False))


def leg_distance(lat: Column, lon: Column, next_lat: Column, next_lon: Column) -> Column:
    """Straight distance in degrees to the next stop, 0 when there is none."""
    squared = F.pow(next_lat - lat, 2) + F.pow(next_lon - lon, 2)
    return F.coalesce(F.sqrt(squared), F.lit(0.0))


def journey_id(mode: str, when: Column, line: Column, minutes: Column, trip: Column | None = None) -> Column:
    """Key that ties the stops of one journey together.

    ``date_line``: calendar day and line. ``date_line_hour``: also the hour of departure.
    ``trip``: the operator's own trip id on that day.
    """
    date = F.to_date(when)
    if mode == "date_line":
        parts = [date, line, F.floor(minutes / 1440)]
    elif mode == "date_line_hour":
        parts = [date, line, F.floor(minutes / 60)]
    elif mode == "trip" and trip is not None:
        parts = [date, trip]
    else:
        raise ValueError(f"unknown journey mode {mode!r}")
    return F.concat_ws("_", *[category_text(p) for p in parts])
