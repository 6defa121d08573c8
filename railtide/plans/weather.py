"""Processed stop events to the merged table with weather, and its coverage report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtide.functions.times import synthetic_datetime
from railtide.operators.asof import add_weather
from railtide.operators.clean import coerce_numeric
from railtide.operators.quality import stations_without_weather, time_diff_stats, weather_coverage
from railtide.session import leaves_nothing
from railtide.sinks.files import write_chunks, write_summary, write_table
from railtide.sources.files import read_processed, read_table, read_weather_csv

STATION = "station_name_encoded"


def with_datetime(df: DataFrame, mode: str = "actual") -> DataFrame:
    """``actual`` takes the departure time; ``synthetic`` rebuilds one for tables without dates."""
    if mode == "actual":
        return df.withColumn("datetime", F.col("dep_sched"))
    parts = ["dep_month", "dep_day_of_week", "dep_minutes"]
    numbers = coerce_numeric(df.select(*parts, *[c for c in df.columns if c not in parts]), parts)
    return numbers.withColumn("datetime", synthetic_datetime(*[F.col(c) for c in parts]))


def merge(events: DataFrame, weather: DataFrame, mode: str = "actual") -> DataFrame:
    return add_weather(with_datetime(events, mode), weather, station=STATION)


@leaves_nothing
def run(spark: SparkSession, processed_path: str, weather_path: str, out: str, mode: str = "actual",
        small_files: bool = False) -> None:
    """Write ``out/merged`` and, from the written table, the three parts of ``out/coverage``; all three
    are in ``out/coverage/report`` as JSON too."""
    df = merge(read_processed(spark, processed_path), read_weather_csv(spark, weather_path), mode)
    if small_files:
        write_chunks(df, f"{out}/merged")
    else:
        write_table(df, f"{out}/merged")
    written = read_table(spark, f"{out}/merged")
    write_table(weather_coverage(written, station=STATION), f"{out}/coverage/levels", files=1)
    write_table(stations_without_weather(written, STATION), f"{out}/coverage/stations", files=1)
    write_summary(time_diff_stats(written), f"{out}/coverage/time_diff")
    for part in ("levels", "stations"):
        write_summary(read_table(spark, f"{out}/coverage/{part}"), f"{out}/coverage/report/{part}")
    write_summary(spark.read.json(f"{out}/coverage/time_diff"), f"{out}/coverage/report/time_diff")
