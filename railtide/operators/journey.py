"""Features of a stop that depend on the other stops of its journey."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtide.constants import MAX_GROUP_ROWS, MISSING_COORDINATE
from railtide.functions.times import floor_hours
from railtide.functions.values import above, leg_distance
from railtide.operators.ordering import range_chunks
from railtide.operators.quantiles import as_lookup, exact_quantiles
from railtide.operators.skew import attach_group_aggregates, split_hot_groups

FEATURES = [
    "station_sequence", "remaining_stops", "prev_station_delay", "delay_trend",
    "route_distance", "cumulative_distance", "journey_progress",
]


def journey_features(df: DataFrame, order: list[str], journey: str = "journey_id",
                     delay: str = "dep_delay_s", sentinel_as_null: bool = False,
                     max_rows: int = MAX_GROUP_ROWS, counted_on: DataFrame | None = None) -> DataFrame:
    """Add the columns of ``FEATURES``; ``order`` must order the stops of a journey uniquely.

    A leg counts towards the stop it starts from, so the running distance of a stop already holds
    the leg to the next one. Unless ``sentinel_as_null`` is set, unknown coordinates take part in
    the distance as they are.

    Journeys of up to ``max_rows`` stops are one window each. Longer ones are cut into consecutive
    chunks, and each chunk gets from the others what its borders need. Journeys are counted on
    ``counted_on`` where that is a cheaper table with the same journeys.
    """
    rest, hot, hot_rows = split_hot_groups(df, [journey], max_rows, counted_on)
    result = _whole_journeys(rest, journey, order, delay, sentinel_as_null)
    if hot is not None:
        split = _split_journeys(hot, journey, order, delay, sentinel_as_null,
                                ceil(hot_rows / max_rows) + 1)
        result = result.unionByName(split)
    return result


def _place(sentinel_as_null: bool) -> list[Column]:
    def known(c: str) -> Column:
        return F.when(F.col(c) != MISSING_COORDINATE, F.col(c)) if sentinel_as_null else F.col(c)
    return [known("lat").alias("lat"), known("lon").alias("lon")]


def _distance(here: Column, following: Column) -> Column:
    return leg_distance(here["lat"], here["lon"], following["lat"], following["lon"])


def _features(delay: str) -> dict[str, Column]:
    """From ``_seq``, ``_stops``, ``_prev``, ``_leg``, ``_run`` and ``_total`` of a stop."""
    return {
        "station_sequence": F.col("_seq").cast("int"),
        "remaining_stops": (F.col("_stops") - 1 - F.col("_seq")).cast("int"),
        "prev_station_delay": F.coalesce("_prev", F.lit(0.0)),
        "delay_trend": F.coalesce(F.col(delay) - F.col("_prev"), F.lit(0.0)),
        "route_distance": F.col("_leg"),
        "cumulative_distance": F.col("_run"),
        "journey_progress": F.coalesce(F.try_divide("_run", "_total"), F.lit(0.0)),
    }


def _whole_journeys(df: DataFrame, journey: str, order: list[str], delay: str,
                    sentinel_as_null: bool) -> DataFrame:
    group = Window.partitionBy(journey)
    ordered = group.orderBy(*order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.struct(*_place(sentinel_as_null))
    return (
        df.withColumns({
            "_seq": F.row_number().over(ordered) - 1,
            "_stops": F.count(F.lit(1)).over(group),
            "_prev": F.lag(delay).over(ordered),
            "_leg": _distance(here, F.lead(here).over(ordered)),
        })
        .withColumns({"_run": F.sum("_leg").over(so_far), "_total": F.sum("_leg").over(group)})
        .withColumns(_features(delay))
        .drop("_seq", "_stops", "_prev", "_leg", "_run", "_total")
    )


def _split_journeys(df: DataFrame, journey: str, order: list[str], delay: str,
                    sentinel_as_null: bool, chunks: int) -> DataFrame:
    here = F.struct(*_place(sentinel_as_null))
    chunked = range_chunks(df.withColumn("_here", here), [journey, *order], chunks, "_chunk")
    part = [journey, "_chunk"]
    position = F.struct(*order)

    # One row per journey and chunk: at most the chunks plus the long journeys.
    borders = chunked.groupBy(*part).agg(
        F.count(F.lit(1)).alias("_size"),
        F.min_by("_here", position).alias("_first_here"),
        F.max_by("_here", position).alias("_last_here"),
        F.max_by(F.struct(F.col(delay).alias("d")), position).alias("_last_delay"))
    group = Window.partitionBy(journey)
    by_chunk = group.orderBy("_chunk")
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    borders = borders.select(
        *part,
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_seq_start"),
        F.sum("_size").over(group).alias("_stops"),
        F.lag("_last_delay").over(by_chunk)["d"].alias("_prev_chunk_delay"),
        F.lead("_first_here").over(by_chunk).alias("_next_chunk_here"))

    inside = Window.partitionBy(*part).orderBy(*order)
    row = F.row_number().over(inside)
    stops = chunked.join(F.broadcast(borders), part).withColumns({
        "_row": row,
        "_prev": F.when(row == 1, F.col("_prev_chunk_delay")).otherwise(F.lag(delay).over(inside)),
        "_next": F.coalesce(F.lead("_here").over(inside), F.col("_next_chunk_here")),
    }).withColumns({
        "_seq": F.col("_seq_start") + F.col("_row") - 1,
        "_leg": _distance(F.col("_here"), F.col("_next")),
    })

    lengths = stops.groupBy(*part).agg(F.sum("_leg").alias("_length")).select(
        *part,
        F.coalesce(F.sum("_length").over(earlier), F.lit(0.0)).alias("_run_start"),
        F.sum("_length").over(group).alias("_total"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        stops.join(F.broadcast(lengths), part)
        .withColumn("_run", F.col("_run_start") + F.sum("_leg").over(so_far))
        .withColumns(_features(delay))
        .select(*df.columns, *FEATURES)
    )


def historical_pattern(df: DataFrame, line: str = "line_id", station: str = "station_id",
                       at: str = "datetime", delay: str = "dep_delay_s",
                       max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Mean delay of the row's line and station in its three-hour slot; the row itself counts too."""
    keyed = df.withColumn("_slot", floor_hours(F.col(at), 3))
    mean = {"historical_delay_pattern": F.avg(delay)}
    return (
        attach_group_aggregates(keyed, [line, station, "_slot"], mean, max_rows)
        .drop("_slot").fillna(0.0, ["historical_delay_pattern"])
    )


def weather_interactions(df: DataFrame) -> DataFrame:
    """Severe weather (wind or rain over its overall 75 % quantile) and distance to the dew point."""
    lookup = as_lookup(exact_quantiles(df, ["wind_speed", "total_precipitation"], [0.75]))
    severe = [above(F.col(c), F.col("_q")[c]["q75"]) for c in ("wind_speed", "total_precipitation")]
    return df.withColumn("_q", lookup).withColumns({
        "severe_weather": (severe[0] | severe[1]).cast("int"),
        "temp_dewpoint_diff": F.col("temperature_2m") - F.col("dewpoint_2m"),
    }).drop("_q")
