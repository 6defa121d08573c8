"""Readers for stop events, weather, gazetteer and station tracking."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railtide.constants import (
    EXCLUDED_COLUMNS, GAZETTEER_SCHEMA, PROCESSED_HEADERS, RAW_COLUMNS, TRACKING_SCHEMA, WEATHER_MEASURES, WEATHER_SCHEMA,
)
from railtide.operators.tracking import refresh_status


def line_number() -> Column:
    """Sortable place of a row of a scanned text file."""
    return F.struct("_metadata.file_path", "_metadata.file_block_start",
                    F.monotonically_increasing_id().alias("line"))


def read_stop_csv(spark: SparkSession, path: str | list[str], sep: str = ";",
                  exclude: list[str] = EXCLUDED_COLUMNS, fixed_header: bool = True) -> DataFrame:
    """All-text stop events under our column names.

    With ``fixed_header`` every file must have the known header, and one that differs fails instead
    of shifting columns. Otherwise the header of the first file is taken, for dumps with fewer
    columns. Unwanted columns are pruned from the scan.
    """
    reader = spark.read.option("sep", sep).option("header", True)
    if fixed_header:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
        reader = reader.schema(schema).option("enforceSchema", False)
    raw = reader.csv(path)
    return raw.withColumnsRenamed({k: v for k, v in RAW_COLUMNS.items() if k in raw.columns}).drop(*exclude)


def read_table(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """Parquet from a folder, a list of files, or the files of a folder that match a pattern."""
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_processed(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """A processed or merged table under our names, also if it was written under its original headers.

    ``months`` (``yyyy-MM``) reads only the folders of those months where the table is partitioned
    by ``period``.
    """
    df = spark.read.parquet(path)
    df = df.withColumnsRenamed({theirs: ours for ours, theirs in PROCESSED_HEADERS.items() if theirs in df.columns})
    if months is None:
        return df
    return df.where(F.col("period").cast("string").isin(months)) if "period" in df.columns else filter_months(df, months)


def read_weather_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Typed weather with ``line_no``, its sortable place in the files; further columns are ignored.

    All files must have the same columns in the same order; one that differs fails instead of
    putting a measure under another one's name.
    """
    reader = spark.read.option("header", True)
    raw = reader.schema(reader.csv(path).schema).option("enforceSchema", False).csv(path)
    station = F.col("station_id").try_cast("double").cast("int").alias("station_id")
    time = F.col("valid_time").try_cast("timestamp_ntz").alias("valid_time")
    measures = [F.col(m).try_cast("float").alias(m) for m in WEATHER_MEASURES]
    typed = raw.select(station, time, *measures, line_number().alias("line_no"))
    kinds = {f.name: f.dataType for f in WEATHER_SCHEMA}
    return typed.select(*[F.col(c).cast(kinds[c]).alias(c) for c in kinds], "line_no")


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """The first six tab-separated fields of each place, with a sortable line number."""
    places = spark.read.schema(GAZETTEER_SCHEMA).option("sep", "\t").option("quote", "").csv(path)
    return places.select("*", line_number().alias("line_no")).where(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def empty_tracking(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TRACKING_SCHEMA)


def open_tracking(spark: SparkSession, path: str) -> DataFrame:
    """The tracking list with its states refreshed; created empty where there is none yet."""
    try:
        stored = spark.read.schema(TRACKING_SCHEMA).option("header", True).csv(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = empty_tracking(spark)
        empty.write.option("header", True).csv(path)
        return empty
    return refresh_status(stored)


def recent_months(months: int, as_of: date) -> list[str]:
    """``yyyy-MM`` of today and of each 30 days back, without repeats. A month can be skipped."""
    stamps = [(as_of - timedelta(days=30 * i)).strftime("%Y-%m") for i in range(months)]
    return list(dict.fromkeys(stamps))


def filter_months(df: DataFrame, months: list[str], column: str = "service_date") -> DataFrame:
    """Keep the listed months. The outer bounds are plain comparisons, which reach the scan."""
    first, last = min(months), max(months)
    start = date.fromisoformat(f"{first}-01")
    end = (date.fromisoformat(f"{last}-28") + timedelta(days=4)).replace(day=1)
    at = F.col(column)
    kind = df.schema[column].dataType.simpleString()
    bounds = (at >= F.lit(start).cast(kind)) & (at < F.lit(end).cast(kind))
    return df.where(bounds & F.date_format(F.to_date(at), "yyyy-MM").isin(months))
