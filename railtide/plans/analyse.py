"""Processed table to delay statistics."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from railtide.operators import stats
from railtide.operators.clean import coerce_numeric, require_columns
from railtide.operators.encode import decode_category
from railtide.operators.quality import dataset_profile, describe_columns
from railtide.session import leaves_nothing, store
from railtide.sinks.files import write_csv, write_summary
from railtide.sources.files import read_processed

GEO_COLUMNS = ["lat", "lon", "geoname_id"]
STATION = "station_name_encoded"


@leaves_nothing
def run(spark: SparkSession, processed_path: str, encodings_path: str, out: str) -> None:
    """Write station statistics as CSV and every other statistic as a JSON summary under ``out``.

    The table is read for the station statistics, the counts of both delays, the minute means and
    the two descriptions of columns; everything else comes from the stored counts and means.
    """
    df = read_processed(spark, processed_path)
    has_geo = require_columns(df, stats.DELAYS, GEO_COLUMNS)
    df = coerce_numeric(df, stats.DELAYS)
    codes = spark.read.parquet(f"{encodings_path}/table")

    stations = store(decode_category(
        stats.station_stats(df, STATION), codes, "station_name", STATION, "station_name"), "stations")
    write_csv(stations, f"{out}/station_stats", [STATION], one_file=True)
    counts = store(stats.delay_counts(df), "counts")
    by_minute = store(stats.delay_by_minute(df), "by-minute")
    summaries = {
        "top_stations": stats.top_stations(stations, station=STATION),
        "outlier_stations": stats.outlier_stations(stations),
        "station_means": stats.station_mean_summary(stations),
        "station_mean_density": stats.density(stations, ["arr_delay_s_mean", "dep_delay_s_mean"]),
        "delay_stats": stats.delay_stats(None, unit_seconds=60, counts=counts),
        "delay_by_minute": by_minute,
        "hourly": stats.hourly_trend(None, by_minute),
        "periods": stats.delay_by_period(None, by_minute),
        "extreme_periods": stats.extreme_periods(None, by_minute),
        "histogram": stats.delay_histogram(None, counts=counts),
        "density": stats.density(None, stats.DELAYS, counts=counts),
        "on_time": stats.on_time_rate(None, counts=counts),
        "classes": stats.delay_classes(None, counts=counts),
        "profile": dataset_profile(df),
    }
    if has_geo:
        summaries["geo"] = describe_columns(df, GEO_COLUMNS)
    for name, summary in summaries.items():
        write_summary(summary, f"{out}/{name}")
    info = spark.range(1).select(
        F.current_timestamp().alias("analysis_date"), F.lit(has_geo).alias("has_geo_features"))
    write_summary(info, f"{out}/summary")
