"""Exact quantiles by counting, for any number of distinct values.

Equal values are counted together before any shuffle. Approximate cut points then divide the
distinct values of a measure into buckets; only the buckets that hold a wanted rank are kept, cut again
as often as asked for, and at last ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 64
SKETCH_ACCURACY = 1000
# How often the values are cut into buckets. One task orders about a ``BUCKETS ** LEVELS``-th of the distinct
# values of a group: 64 million are a million in a task, and two levels take four billion.
LEVELS = 1


def _joined(rows: DataFrame, facts: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Equi-join with facts about keys: a row per measure is broadcast; of groups there can be many, so how they meet is left to
    adaptive execution, by their real size."""
    return rows.join(facts if by else F.broadcast(facts), keys)


def value_counts(df: DataFrame, measures: list[str], by: list[str] = (), keep_null: bool = False) -> DataFrame:
    """``(by..., measure, value, n)``: how often each non-null value of each measure occurs.

    ``keep_null`` adds a row with a null value for the rows without one.
    """
    pairs = F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])
    if len(measures) == 1:
        tall = df.select(*by, F.lit(measures[0]).alias("measure"),
                         F.col(measures[0]).cast("double").alias("value"))
    else:
        tall = df.select(*by, F.inline(pairs))
    return (
        (tall if keep_null else tall.where(F.col("value").isNotNull()))
        .groupBy(*by, "measure", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def moments_of_counts(counts: DataFrame, by: list[str] = ()) -> DataFrame:
    """Rows, mean, deviation, skew, excess kurtosis and range of each measure.

    Skew and kurtosis are those of the whole population, the deviation that of a sample.
    """
    group = list(by) + ["measure"]
    centre = counts.groupBy(*group).agg((F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("_mean"))
    off = F.col("value") - F.col("_mean")
    powers = {f"_m{k}": F.sum(F.col("n") * F.pow(off, k)) for k in (2, 3, 4)}
    sums = _joined(counts, centre, group, by).groupBy(*group, "_mean").agg(
        F.sum("n").alias("n"), F.min("value").alias("min"), F.max("value").alias("max"),
        *[c.alias(name) for name, c in powers.items()])
    n, m2 = F.col("n"), F.col("_m2")
    return sums.select(
        *group, "n", F.col("_mean").alias("mean"),
        F.sqrt(F.try_divide(m2, n - 1)).alias("std"),
        F.try_divide(F.col("_m3") / n, F.pow(m2 / n, 1.5)).alias("skew"),
        (F.try_divide(F.col("_m4") / n, F.pow(m2 / n, 2)) - 3).alias("kurtosis"),
        "min", "max")


def quantile_name(p: float) -> str:
    return f"q{p * 100:g}".replace(".", "_")


def narrowed(rows: DataFrame, group: list[str], wanted: Column, by: list[str], first: bool) -> DataFrame:
    """``rows`` (group, _bucket, value, n, _start, _total) of the parts of their buckets that hold a wanted rank.

    ``_start`` counts the rows of the group before the bucket; the first time it and ``_total`` are not known yet.
    """
    keys = [*group, "_bucket"]
    grid = [i / BUCKETS for i in range(1, BUCKETS)]
    total = F.sum("n") if first else F.first("_total")
    shape = rows.groupBy(*keys).agg(F.percentile_approx("value", grid, SKETCH_ACCURACY).alias("_cuts"), total.alias("_total"))
    cut = _joined(rows.drop("_total"), shape, keys, by).withColumn(
        "_part", F.size(F.filter("_cuts", lambda c: c < F.col("value")))).drop("_cuts")
    sizes = cut.groupBy(*keys, "_part").agg(
        F.sum("n").alias("_size"), F.first("_total").alias("_total"), F.first("_start").alias("_start"))
    # At most BUCKETS rows per bucket.
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    holding = (
        sizes.withColumn("_from", F.col("_start") + F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .where(F.exists(wanted, lambda r: (r >= F.col("_from")) & (r < F.col("_from") + F.col("_size"))))
        .select(*keys, "_part", "_from")
    )
    return _joined(cut.drop("_start"), holding, [*keys, "_part"], by).select(
        *group, (F.col("_bucket") * BUCKETS + F.col("_part")).alias("_bucket"), "value", "n", F.col("_from").alias("_start"), "_total")


def quantiles_of_counts(counts: DataFrame, probabilities: list[float], by: list[str] = (), levels: int = LEVELS) -> DataFrame:
    """One row per group and measure: row count ``n`` and linearly interpolated ``q<percent>``.

    ``by`` may have any number of groups. With more ``levels`` the wanted rank intervals are narrowed
    again before they are ordered, for measures of many distinct values.
    """
    group = list(by) + ["measure"]
    ranks = [F.lit(p) * (F.col("_total") - 1) for p in probabilities]
    wanted = F.array(*[f(r) for r in ranks for f in (F.floor, F.ceil)])
    rows = counts.select(*group, F.lit(0).cast("long").alias("_bucket"), "value", "n", F.lit(0).cast("long").alias("_start"))
    for level in range(levels):
        rows = narrowed(rows, group, wanted, by, level == 0)
    inside = Window.partitionBy(*group, "_bucket").orderBy("value")
    ranked = rows.withColumn("_end", F.col("_start") + F.sum("n").over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_end") - F.col("n")) & (rank < F.col("_end")), F.col("value")))

    picked = ranked.groupBy(*group).agg(
        F.first("_total").alias("n"),
        *[f(at(g(r))).alias(f"_{edge}{i}") for i, r in enumerate(ranks)
          for edge, f, g in (("lo", lambda c: c, F.floor), ("hi", lambda c: c, F.ceil))])
    out = []
    for i, p in enumerate(probabilities):
        rank = F.lit(p) * (F.col("n") - 1)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append((lo + (hi - lo) * (rank - F.floor(rank))).alias(quantile_name(p)))
    return picked.select(*group, "n", *out)


def exact_quantiles(df: DataFrame, measures: list[str], probabilities: list[float],
                    by: list[str] = (), levels: int = LEVELS) -> DataFrame:
    return quantiles_of_counts(value_counts(df, measures, by), probabilities, by, levels)


def approximate_quantiles(df: DataFrame, measures: list[str], probabilities: list[float],
                          by: list[str] = (), accuracy: int = 10_000) -> DataFrame:
    """Same columns from one mergeable sketch per measure, in a single aggregation."""
    pairs = F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])
    group = list(by) + ["measure"]
    sketch = (
        df.select(*by, F.inline(pairs)).where(F.col("value").isNotNull()).groupBy(*group)
        .agg(F.count(F.lit(1)).alias("n"),
             F.percentile_approx("value", list(probabilities), accuracy).alias("_q"))
    )
    return sketch.select(
        *group, "n", *[F.col("_q")[i].alias(quantile_name(p)) for i, p in enumerate(probabilities)])


def as_lookup(quantiles: DataFrame) -> Column:
    """A scalar map ``measure -> struct of its quantiles``, to be used as a column of another table."""
    names = [c for c in quantiles.columns if c != "measure"]
    entry = F.struct("measure", F.struct(*names).alias("q"))
    return quantiles.agg(F.map_from_entries(F.collect_list(entry)).alias("m")).scalar()
