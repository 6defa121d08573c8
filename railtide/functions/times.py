"""Timestamps, delays and calendar features."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_FIRST = r"^\s*(\d{1,2})[./-](\d{1,2})[./-](\d{4})"


def parse_timestamp(text: Column) -> Column:
    """Day-first or ISO text, with or without time of day, to a zone-free timestamp; bad text is null."""
    iso = F.regexp_replace(F.trim(text), DAY_FIRST, "$3-$2-$1")
    return iso.try_cast("timestamp_ntz")


def micros_between(start: Column, end: Column) -> Column:
    """Microseconds from start to end. Zone-free timestamps stay so, whatever the session's zone."""
    gap = end - start
    whole = [F.extract(F.lit(unit), gap).cast("bigint") * micros for unit, micros in
             (("DAY", 86_400_000_000), ("HOUR", 3_600_000_000), ("MINUTE", 60_000_000))]
    seconds = (F.extract(F.lit("SECOND"), gap) * 1_000_000).cast("bigint")
    return whole[0] + whole[1] + whole[2] + seconds


def delay_seconds(scheduled: Column, actual: Column, actual_first: bool = True) -> Column:
    """Seconds from schedule to actual. ``actual_first=False`` gives the older, opposite sign."""
    start, end = (scheduled, actual) if actual_first else (actual, scheduled)
    return micros_between(start, end) / F.lit(1e6)


def minutes_of_day(ts: Column) -> Column:
    return (F.hour(ts) * 60 + F.minute(ts)).cast("smallint")


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts).cast("tinyint")


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("tinyint")


def with_time_features(df: DataFrame, ts: str, prefix: str) -> DataFrame:
    """Add ``<prefix>_minutes``, ``_day_of_week``, ``_month`` and ``_is_weekend``."""
    c = F.col(ts)
    return df.withColumns({
        f"{prefix}_minutes": minutes_of_day(c),
        f"{prefix}_day_of_week": day_of_week(c),
        f"{prefix}_month": F.month(c).cast("tinyint"),
        f"{prefix}_is_weekend": is_weekend(c),
    })


def with_delays_and_times(df: DataFrame) -> DataFrame:
    """Arrival and departure delay and calendar features, for the sides whose columns exist."""
    for prefix in ("arr", "dep"):
        sched, prog = f"{prefix}_sched", f"{prefix}_prog"
        if sched in df.columns and prog in df.columns:
            df = df.withColumn(f"{prefix}_delay_s", delay_seconds(F.col(sched), F.col(prog)))
            df = with_time_features(df, sched, prefix)
    return df


def with_date_components(df: DataFrame, columns: list[str]) -> DataFrame:
    """Day, month, year, weekday, hour and minute of each listed timestamp column that exists."""
    parts = {"day": F.dayofmonth, "month": F.month, "year": F.year,
             "weekday": F.weekday, "hour": F.hour, "minute": F.minute}
    return df.withColumns({
        f"{c}_{name}": part(F.col(c))
        for c in columns if c in df.columns for name, part in parts.items()
    })


def from_epoch_millis(ms: Column) -> Column:
    return F.timestamp_add("MICROSECOND", ms.cast("bigint") * 1000,
                           F.lit("1970-01-01").cast("timestamp_ntz"))


def first_week_dates(year: int = 2024) -> list[list[datetime]]:
    """For each month, the date in its first week that stands for each day of week.

    Days of week count from Monday = 0 but are set against ISO weekdays (Monday = 1), so every date
    falls one weekday early. Kept, because existing merged tables are built that way.
    """
    firsts = [datetime(year, month, 1) for month in range(1, 13)]
    return [[first + timedelta(days=(dow - first.isoweekday()) % 7) for dow in range(7)] for first in firsts]


def synthetic_datetime(month: Column, dow: Column, minutes: Column) -> Column:
    """A datetime in the first week of the month, for tables that kept no date; null where it has no place.

    A lookup instead of date arithmetic, so that each input is evaluated once even where a filter on
    the result is pushed down to the scan.
    """
    dates = F.array(*[F.array(*[F.lit(d.isoformat()).cast("timestamp_ntz") for d in week]) for week in first_week_dates()])
    date = F.get(F.get(dates, month.cast("int") - 1), dow.cast("int"))
    return F.timestamp_add("MINUTE", minutes.cast("int"), date)


def floor_hours(ts: Column, hours: int = 3) -> Column:
    """Start of the ``hours``-long slot of the day; ``hours`` must divide 24."""
    if 24 % hours:
        raise ValueError("hours must divide 24")
    start = (F.hour(ts) - F.hour(ts) % hours)
    return F.timestamp_add("HOUR", start, F.to_date(ts).cast("timestamp_ntz"))


def hour_of_minutes(minutes: Column) -> Column:
    return F.floor(minutes / 60).cast("int")
