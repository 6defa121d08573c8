"""Nearest-in-time weather for every stop event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtide.constants import MAX_GROUP_ROWS, WEATHER_MEASURES
from railtide.functions.times import micros_between
from railtide.operators.skew import frequent_hashes, is_small, join_spread, key_hash
from railtide.session import store

# A series may have up to so many slots per observation; wider slots are taken where days would be more.
SLOTS_PER_OBSERVATION = 4


def slot_of(at: Column, days: int) -> Column:
    """Number of the span of ``days`` days that a time lies in."""
    return F.floor(F.unix_date(at.cast("date")) / days).cast("int")


def time_index(series: DataFrame, key: str, time: str, values: list[str], days: int) -> DataFrame:
    """``(key, _slot, _observed)``: for every slot of a key, from its first to its last, the observations of
    the slot in order of time, after the last one before the slot and before the first one after it."""
    found = series.groupBy(key, slot_of(F.col(time), days).alias("_slot")).agg(
        F.sort_array(F.collect_list(F.struct(time, *values))).alias("own"))
    # One row per key and slot with observations.
    order = Window.partitionBy(key).orderBy("_slot")
    around = found.select(
        "*", F.lag(F.element_at("own", -1)).over(order).alias("before"),
        F.lead(F.element_at("own", 1)).over(order).alias("after"), F.lead("_slot").over(order).alias("next"))
    last = F.coalesce(F.col("next") - 1, F.col("_slot"))
    slots = around.select("*", F.explode(F.sequence("_slot", last)).alias("at"))
    bridge = F.array(F.element_at("own", -1), F.col("after"))
    whole = F.concat(F.array_compact(F.array("before")), "own", F.array_compact(F.array("after")))
    return slots.select(key, F.col("at").alias("_slot"), F.when(F.col("at") == F.col("_slot"), whole).otherwise(bridge).alias("_observed"))


def nearest_of(observed: Column, time: str, at: Column) -> Column:
    """The element of an ordered array whose time is nearest; of two equally near ones the earlier.

    Binary search for the number of elements up to ``at``, a halved step at a time.
    """
    size = F.size(observed)
    halvings = F.sequence(F.length(F.bin(size)) - 1, F.lit(0), F.lit(-1))

    def advance(found: Column, k: Column) -> Column:
        following = found + F.call_function("shiftleft", F.lit(1), k)
        return F.when((following <= size) & (F.get(observed, following - 1)[time] <= at), following).otherwise(found)

    found = F.aggregate(halvings, F.lit(0), advance)
    earlier, later = F.get(observed, found - 1), F.get(observed, found)
    gap = lambda x: F.abs(micros_between(x[time], at))
    return F.when(earlier.isNull() | (gap(later) < gap(earlier)), later).otherwise(earlier)


def add_weather(events: DataFrame, weather: DataFrame, station: str = "station_id",
                at: str = "datetime", measures: list[str] = WEATHER_MEASURES,
                max_rows: int | None = None) -> DataFrame:
    """Every event with a datetime, the nearest weather of its station, its distance in minutes and
    whether there was any.

    The weather becomes an index with one row per station and day, which holds the day's observations in
    order and those next to the day. An event before the first or after the last day of its station goes to that
    day. So events are shuffled once, for the join with the index, and read once. A hot
    station and day is left to adaptive execution, which splits skewed partitions; with ``max_rows`` a sketch
    over the events finds the keys with more rows first and deals them out. Of several weather rows
    at one time the one with the smallest ``line_no`` is taken, as in the order of a file; without
    that column the smallest row of measures.
    """
    events = events.where(F.col(at).isNotNull())
    row = F.struct(*measures)
    first = F.min_by(row, "line_no") if "line_no" in weather.columns else F.min(row)
    observed = store(
        weather.withColumnRenamed("station_id", station).where(F.col("valid_time").isNotNull() & F.col(station).isNotNull())
        .groupBy(station, "valid_time").agg(first.alias("_m")).select(station, "valid_time", "_m.*"), "observed")
    reach = store(observed.groupBy(station).agg(
        F.min("valid_time").alias("_from"), F.max("valid_time").alias("_to"), F.count(F.lit(1)).alias("n")), "reach")
    spans = reach.agg(F.sum(F.datediff("_to", "_from") + 1).alias("days"), F.sum("n").alias("n")).first()
    days = max(1, -(-(spans["days"] or 0) // (SLOTS_PER_OBSERVATION * (spans["n"] or 1))))
    index = time_index(observed, station, "valid_time", measures, days)
    ends = reach.select(station, slot_of(F.col("_from"), days).alias("_from"), slot_of(F.col("_to"), days).alias("_to"))
    # One row per station with weather.
    ends = F.broadcast(ends) if is_small(ends) else ends
    placed = events.join(ends, station, "left").withColumn(
        "_slot", F.greatest("_from", F.least("_to", slot_of(F.col(at), days)))).drop("_from", "_to")
    keys = [station, "_slot"]
    hot = frequent_hashes(placed, key_hash(keys, placed.schema), max_rows) if max_rows else {}
    found = join_spread(placed, index, keys, hot, max_rows or MAX_GROUP_ROWS).withColumn(
        "_near", nearest_of(F.col("_observed"), "valid_time", F.col(at))).drop("_observed", "_slot")
    gap = F.abs(micros_between(F.col("_near")["valid_time"], F.col(at))) / F.lit(60e6)
    return found.withColumns({
        **{m: F.col("_near")[m] for m in measures}, "time_diff_minutes": gap.cast("float"),
        "weather_station_found": F.col("_near").isNotNull(),
    }).drop("_near")
