"""The list of stations without coordinates and the state of their correction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtide.operators.geo import lacks_coordinates


def missing_stations(df: DataFrame, station: str = "station_id") -> DataFrame:
    return df.where(lacks_coordinates()).select(F.col(station).alias("encoded_id")).distinct()


def refresh_status(tracking: DataFrame) -> DataFrame:
    """``pending`` becomes ``updated`` once both new coordinates are there."""
    ready = ((F.col("status") == "pending") & F.col("new_latitude").isNotNull()
             & F.col("new_longitude").isNotNull())
    return tracking.withColumn("status", F.when(ready, "updated").otherwise(F.col("status")))


def untracked(tracking: DataFrame, missing: DataFrame, as_of: str) -> DataFrame:
    """Tracking rows for the missing stations that are not on the list yet."""
    return missing.join(tracking.select("encoded_id"), "encoded_id", "left_anti").select(
        "encoded_id",
        F.lit(None).cast("double").alias("new_latitude"),
        F.lit(None).cast("double").alias("new_longitude"),
        F.lit(as_of).alias("date_added"),
        F.lit("pending").alias("status"))


def track(tracking: DataFrame, missing: DataFrame, as_of: str) -> DataFrame:
    """The list with its states refreshed and the new stations appended."""
    refreshed = refresh_status(tracking)
    return refreshed.unionByName(untracked(refreshed, missing, as_of), allowMissingColumns=True)


def tracking_summary(tracking: DataFrame, missing: DataFrame, as_of: str) -> DataFrame:
    """Counts by state after the update, and how many stations were new."""
    known = refresh_status(tracking).withColumn("is_new", F.lit(False))
    new = untracked(tracking, missing, as_of).withColumn("is_new", F.lit(True))
    state = F.col("status")
    return known.unionByName(new, allowMissingColumns=True).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_new").alias("new_stations"),
        F.count_if(state == "pending").alias("pending"),
        F.count_if(state == "updated").alias("updated"),
        F.count_if(state == "invalid").alias("invalid"))
