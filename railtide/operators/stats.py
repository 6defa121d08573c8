"""Delay statistics."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railtide.constants import IMPACT_WEATHER
from railtide.functions.times import hour_of_minutes
from railtide.functions.values import day_period, delay_class, is_on_time, to_minutes
from railtide.operators.quantiles import (
    approximate_quantiles, exact_quantiles, moments_of_counts, quantile_name, quantiles_of_counts, value_counts,
)
from railtide.session import store

DELAYS = ["arr_delay_s", "dep_delay_s"]
KINDS = {"Arrival": ("arr_minutes", "arr_delay_s"), "Departure": ("dep_minutes", "dep_delay_s")}
GRID_POINTS = 200


def tall_delays(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """``(keep..., kind, minutes, delay_s)``: arrival and departure as rows of their own."""
    sides = [
        F.struct(F.lit(kind).alias("kind"), F.col(m).cast("int").alias("minutes"),
                 F.col(d).cast("double").alias("delay_s"))
        for kind, (m, d) in KINDS.items() if m in df.columns and d in df.columns]
    return df.select(*keep, F.inline(F.array(*sides)))


def station_stats(df: DataFrame, station: str = "station_id") -> DataFrame:
    """Count, mean and deviation of both delays per station, and the weight of its plot bubble."""
    stats = df.groupBy(station).agg(*[
        f(d).alias(f"{d}_{name}") for d in DELAYS
        for name, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp))])
    # One row per station, stored so that the largest count takes no second look at the events.
    stats = store(stats, "stations")
    largest = stats.agg(F.max("arr_delay_s_count")).scalar()
    return stats.withColumn("bubble_size", F.col("arr_delay_s_count") / largest * 300)


def top_stations(stats: DataFrame, k: int = 15, station: str = "station_id") -> DataFrame:
    """The ``k`` stations with the highest mean arrival delay."""
    return stats.orderBy(F.desc_nulls_last("arr_delay_s_mean"), station).limit(k)


def station_mean_summary(stats: DataFrame) -> DataFrame:
    """Mean, median and deviation of the station means, in minutes."""
    means = [f"{d}_mean" for d in DELAYS]
    return describe_values(stats, means, {0.5: "median"}, 60).select("measure", "mean", "std", "median")


def outlier_stations(stats: DataFrame) -> DataFrame:
    """Stations where either mean is above the 95 % quantile of the *arrival* means."""
    limit = exact_quantiles(stats, ["arr_delay_s_mean"], [0.95]).select("q95").scalar()
    above = (F.col("arr_delay_s_mean") > F.col("_limit")) | (F.col("dep_delay_s_mean") > F.col("_limit"))
    return stats.withColumn("_limit", limit).where(above).drop("_limit")


def known_counts(df: DataFrame | None, columns: list[str], counts: DataFrame | None) -> DataFrame:
    """Value counts of the columns, from a table that counted them already if there is one."""
    if counts is None:
        return value_counts(df, columns)
    return counts.where(F.col("measure").isin(list(columns)) & F.col("value").isNotNull())


def describe_values(df: DataFrame | None, columns: list[str], quantiles: dict[float, str], unit: float = 1,
                    counts: DataFrame | None = None, accuracy: int | None = None) -> DataFrame:
    """Moments, range and named quantiles of each column divided by ``unit``, one row per column.

    ``counts`` are value counts made before. With ``accuracy`` quantiles come from sketches with a
    relative rank error of its reciprocal, which needs ``df``, instead of exactly.
    """
    counts = known_counts(df, columns, counts)
    if accuracy is None:
        exact = quantiles_of_counts(counts, list(quantiles)).drop("n")
    else:
        exact = approximate_quantiles(df, columns, list(quantiles), accuracy=accuracy).drop("n")
    # Both sides have one row per column.
    return moments_of_counts(counts).join(F.broadcast(exact), "measure").select(
        "measure", "n", *[(F.col(c) / unit).alias(c) for c in ("mean", "std", "min", "max")],
        "skew", "kurtosis",
        *[(F.col(quantile_name(p)) / unit).alias(name) for p, name in quantiles.items()])


def delay_counts(df: DataFrame) -> DataFrame:
    """How often each value of both delays occurs, missing ones included: enough for most statistics."""
    return value_counts(df, DELAYS, keep_null=True)


def delay_stats(df: DataFrame | None, unit_seconds: float = 1, counts: DataFrame | None = None,
                accuracy: int | None = None) -> DataFrame:
    """Mean, median, deviation, skew, excess kurtosis, 90 % and 95 % quantile of both delays."""
    found = describe_values(df, DELAYS, {0.5: "median", 0.9: "q90", 0.95: "q95"}, unit_seconds, counts, accuracy)
    return found.select("measure", "mean", "std", "skew", "kurtosis", "median", "q90", "q95")


def delay_by_minute(df: DataFrame) -> DataFrame:
    """Mean delay for each minute of the day."""
    return tall_delays(df).where("minutes is not null").groupBy("kind", "minutes").agg(
        F.avg("delay_s").alias("mean_delay_s"))


def delay_by_hour(df: DataFrame | None, by_minute: DataFrame | None = None) -> DataFrame:
    """Hourly profile in minutes: every minute of the hour weighs the same."""
    return (
        (delay_by_minute(df) if by_minute is None else by_minute).groupBy("kind", hour_of_minutes(F.col("minutes")).alias("hour"))
        .agg(F.avg(to_minutes(F.col("mean_delay_s"))).alias("delay_min"))
    )


def hourly_trend(df: DataFrame | None, by_minute: DataFrame | None = None) -> DataFrame:
    """Centred three-hour mean of the hourly profile, null where an hour of the three is missing."""
    # At most 24 rows per kind.
    three = Window.partitionBy("kind").orderBy("hour").rowsBetween(-1, 1)
    full = F.count("delay_min").over(three) == 3
    return delay_by_hour(df, by_minute).withColumn("trend_min", F.when(full, F.avg("delay_min").over(three)))


def delay_by_period(df: DataFrame | None, by_minute: DataFrame | None = None) -> DataFrame:
    """Day-period profile in minutes: every hour of the period weighs the same."""
    return (
        delay_by_hour(df, by_minute).groupBy("kind", day_period(F.col("hour")).alias("period"))
        .agg(F.avg("delay_min").alias("delay_min"))
    )


def extreme_periods(df: DataFrame | None, by_minute: DataFrame | None = None) -> DataFrame:
    """The day period and kind with the highest and the one with the lowest delay."""
    at = F.struct("period", "kind", "delay_min")
    found = delay_by_period(df, by_minute).agg(
        F.max_by(at, "delay_min").alias("highest"), F.min_by(at, "delay_min").alias("lowest"))
    sides = [F.struct(F.lit(n).alias("extreme"), F.col(f"{n}.period").alias("period"),
                      F.col(f"{n}.kind").alias("kind"), F.col(f"{n}.delay_min").alias("delay_min"))
             for n in ("highest", "lowest")]
    return found.select(F.inline(F.array(*sides)))


def delay_classes(df: DataFrame | None, delay: str = "dep_delay_s", counts: DataFrame | None = None) -> DataFrame:
    """Rows per delay class."""
    if counts is not None:
        own = counts.where(F.col("measure") == delay)
        return own.groupBy(delay_class(F.col("value")).alias("delay_class")).agg(F.sum("n").alias("n"))
    return df.groupBy(delay_class(F.col(delay)).alias("delay_class")).agg(F.count(F.lit(1)).alias("n"))


def delay_histogram(df: DataFrame | None, bins: int = 49, counts: DataFrame | None = None) -> DataFrame:
    """Counts over equal bins between plus and minus the largest delay, empty bins with 0."""
    counts = known_counts(df, DELAYS, counts)
    # The total keeps this the same aggregation as the counts, whose shuffle then serves both.
    shape = counts.agg(F.struct(F.max(F.abs("value")).alias("reach"), F.sum("n").alias("total")).alias("s"))
    width = F.col("_m") * 2 / bins
    bin_no = F.coalesce(F.floor(F.try_divide(F.col("value") + F.col("_m"), width)), F.lit(0))
    # One row of zero per measure and bin joins the counts.
    every = F.explode(F.array(*[F.lit(d) for d in DELAYS])).alias("measure")
    empty = counts.sparkSession.range(1).select(every).select(
        "measure", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), F.lit(0).cast("long").alias("n"))
    filled = counts.withColumn("_m", shape.scalar()["reach"]).select(
        "measure", F.least(bin_no, F.lit(bins - 1)).cast("int").alias("bin"), "n")
    return (
        filled.unionByName(empty).groupBy("measure", "bin").agg(F.sum("n").alias("n"))
        .withColumn("_m", shape.scalar()["reach"])
        .select("measure", "bin", (F.col("bin") * width - F.col("_m")).alias("left_edge"), "n")
    )


# Bandwidths from which a kernel is less than 2 ** -53 of its height, so that it adds nothing to a double.
KERNEL_REACH = math.sqrt(2 * 53 * math.log(2))


def visited_points(counts: DataFrame, shape: DataFrame, points: int) -> DataFrame:
    """Every distinct value with the grid points in reach of its kernel, and ``_x``, the place of the point."""
    step = (F.col("_hi") - F.col("_lo") + 6 * F.col("_h")) / (points - 1)
    start, reach = F.col("_lo") - 3 * F.col("_h"), KERNEL_REACH * F.col("_h")
    first = F.greatest(F.ceil((F.col("value") - reach - start) / step), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("value") + reach - start) / step), F.lit(points - 1)).cast("int")
    # One row of bandwidth and range per column.
    return counts.join(F.broadcast(shape), "measure").withColumn("point", F.explode(F.sequence(first, last))).withColumn(
        "_x", start + F.col("point") * step)


def density(df: DataFrame | None, columns: list[str], points: int = GRID_POINTS, unit: float = 60,
            counts: DataFrame | None = None) -> DataFrame:
    """Gaussian kernel density over an even grid reaching three bandwidths past the data.

    Bandwidth is the deviation times ``n ** -0.2``. Each distinct value enters once, weighted by
    how often it occurs, and visits only the grid points where its kernel is not nothing.
    """
    counts = known_counts(df, columns, counts).withColumn("value", F.col("value") / unit)
    shape = moments_of_counts(counts).select(
        "measure", F.col("n").alias("_total"), (F.col("std") * F.pow("n", F.lit(-0.2))).alias("_h"),
        F.col("min").alias("_lo"), F.col("max").alias("_hi"))
    z = (F.col("_x") - F.col("value")) / F.col("_h")
    sums = visited_points(counts, shape, points).groupBy("measure", "point").agg(F.sum(F.col("n") * F.exp(-0.5 * z * z)).alias("_s"))
    # A row per measure and grid point, also where no value reaches.
    grid = shape.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    step = (F.col("_hi") - F.col("_lo") + 6 * F.col("_h")) / (points - 1)
    return grid.join(sums, ["measure", "point"], "left").select(
        "measure", "point", (F.col("_lo") - 3 * F.col("_h") + F.col("point") * step).alias("x"),
        (F.coalesce("_s", F.lit(0.0)) / (F.col("_total") * F.col("_h") * F.sqrt(F.lit(2) * F.pi()))).alias("density"))


def on_time_rate(df: DataFrame | None, tolerance: int = 60, counts: DataFrame | None = None) -> DataFrame:
    """Percent of arrivals and departures within the tolerance."""
    if counts is not None:
        good = F.when(is_on_time(F.col("value"), tolerance), F.col("n")).otherwise(0)
        return counts.agg(*[
            (100 * F.sum(F.when(F.col("measure") == d, good)) / F.sum(F.when(F.col("measure") == d, F.col("n")))).alias(name)
            for name, d in (("arrival_pct", "arr_delay_s"), ("departure_pct", "dep_delay_s"))])
    rates = [(100 * F.avg(is_on_time(F.col(d), tolerance).cast("double"))).alias(name)
             for name, d in (("arrival_pct", "arr_delay_s"), ("departure_pct", "dep_delay_s"))]
    return df.agg(*rates)


def box_numbers(df: DataFrame, by: str, delay: str = "dep_delay_s", whis: float = 1.5) -> DataFrame:
    """Quartiles, and the outermost values within ``whis`` interquartile ranges, per group."""
    counts = value_counts(df, [delay], [by])
    box = quantiles_of_counts(counts, [0.25, 0.5, 0.75], [by]).drop("measure")
    reach = whis * (F.col("q75") - F.col("q25"))
    inside = F.col("value").between(F.col("q25") - reach, F.col("q75") + reach)
    value = F.when(inside, F.col("value"))
    return (
        counts.drop("n").join(box, by)
        .groupBy(by, "n", "q25", "q50", "q75")
        .agg(F.min(value).alias("whisker_low"), F.max(value).alias("whisker_high"))
    )


def weather_impact(df: DataFrame, measures: list[str] = IMPACT_WEATHER,
                   delay: str = "dep_delay_s") -> DataFrame:
    """Line through delay in minutes against each measure, and their correlation."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("x")) for m in measures])
    minutes = to_minutes(F.col(delay))
    return (
        df.select(minutes.alias("y"), F.inline(pairs)).where("x is not null and y is not null")
        .groupBy("measure").agg(
            F.count(F.lit(1)).alias("n"), F.regr_slope("y", "x").alias("slope"),
            F.regr_intercept("y", "x").alias("intercept"), F.corr("x", "y").alias("correlation"))
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: list[str] = ()) -> DataFrame:
    """R² and root mean squared error in minutes."""
    y, p = F.col(actual), F.col(predicted)
    squared = F.pow(y - p, 2)
    total = F.var_pop(actual) * F.count(actual)
    return df.where(y.isNotNull() & p.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        (1 - F.try_divide(F.sum(squared), total)).alias("r2"),
        (F.sqrt(F.avg(squared)) / 60).alias("rmse_min"))
