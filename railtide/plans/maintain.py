"""Station upkeep: the missing list, corrections and the station table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtide.constants import TRACKING_SCHEMA
from railtide.operators.geo import apply_corrections, station_mapping
from railtide.operators.tracking import missing_stations, track, tracking_summary
from railtide.session import store
from railtide.sinks.files import read_version, write_csv, write_version
from railtide.sources.files import line_number, open_tracking

STATION = "station_name_encoded"


def detect_missing(spark: SparkSession, df: DataFrame, tracking_path: str, out_path: str,
                   as_of: str) -> DataFrame:
    """Write the tracking list with new stations appended to ``out_path``; returns its summary."""
    known = open_tracking(spark, tracking_path)
    missing = store(missing_stations(df, STATION), "missing")
    write_csv(track(known, missing, as_of), out_path, one_file=True)
    return tracking_summary(known, missing, as_of)


def apply_updates(spark: SparkSession, root: str, tracking_path: str, version: str) -> bool:
    """Write a corrected version of a versioned table; False when there is nothing to correct."""
    fixes = (
        spark.read.schema(TRACKING_SCHEMA).option("header", True).csv(tracking_path)
        .select("*", line_number().alias("line_no")).where("status = 'updated'")
    )
    if fixes.isEmpty():
        return False
    write_version(apply_corrections(read_version(spark, root), fixes, STATION), root, version)
    return True


def write_station_mapping(df: DataFrame, path: str) -> None:
    write_csv(station_mapping(df.withColumn("station_id", F.col(STATION))), path, ["station_id"], one_file=True)
