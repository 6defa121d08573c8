"""Joins and group splits that hold when one key has a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from railtide.constants import MAX_BROADCAST_ROWS, MAX_GROUP_ROWS
from railtide.session import store

# Keys that a frequent-items sketch follows, and the most that it reports.
TRACKED_KEYS, MOST_HOT_KEYS = 100_000, 10_000


def key_hash(keys: list[str], schema: StructType, named: str | None = None) -> Column:
    """Hash of a key, the same for equal keys of tables whose types differ from ``schema``."""
    def plain(k: str) -> Column:
        kind = schema[k].dataType
        value = F.col(k).cast(kind)
        # Zero and minus zero are equal.
        return (value + F.lit(0.0)).cast(kind) if isinstance(kind, (FloatType, DoubleType)) else value
    return F.xxhash64(*([F.lit(named)] if named else []), *[plain(k) for k in keys])


def frequent_hashes(df: DataFrame, hashed: Column, max_rows: int = MAX_GROUP_ROWS) -> dict[int, int]:
    """Hashes of the keys with more than ``max_rows`` rows, and about how many they have.

    One pass with a mergeable frequent-items sketch, whose size does not depend on how many keys there
    are. Its counts are at most 4 / ``TRACKED_KEYS`` of all rows off; no key above both this and
    ``max_rows`` is missed, and a key that is taken for frequent only gets more copies than it needs.
    """
    found = df.agg(F.call_function("approx_top_k", hashed, F.lit(MOST_HOT_KEYS), F.lit(TRACKED_KEYS)).alias("top")).first()
    return {r["item"]: r["count"] for r in found["top"] or [] if r["count"] > max_rows}


def split_hot_groups(df: DataFrame, keys: list[str], max_rows: int = MAX_GROUP_ROWS,
                     counted_on: DataFrame | None = None):
    """``(rest, hot, hot_rows)``: rows of the groups that fit one task, and those that do not.

    ``hot`` is None when every group fits. ``counted_on`` is a table with the same groups that is
    cheaper to count.
    """
    hashed = key_hash(keys, df.schema)
    found = frequent_hashes(df if counted_on is None else counted_on, hashed, max_rows)
    if not found:
        return df, None, 0
    listed = F.broadcast(_listed(df, found, max_rows).select("_hash"))
    keyed = df.withColumn("_hash", hashed)
    return (keyed.join(listed, "_hash", "left_anti").drop("_hash"), keyed.join(listed, "_hash", "left_semi").drop("_hash"),
            sum(found.values()))


def _listed(df: DataFrame, hot: dict[int, int], max_rows: int) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(h, -(-n // max_rows)) for h, n in sorted(hot.items())], "_hash long, _copies int")


def join_spread(df: DataFrame, values: DataFrame, keys: list[str], hot: dict[int, int],
                max_rows: int = MAX_GROUP_ROWS, named: str | None = None) -> DataFrame:
    """Left join to ``values`` (one row per key) with the ``hot`` keys of ``df`` dealt out.

    ``hot`` has hashes of keys (after ``named``, if given) and their rows. A hot key gets a copy of its
    ``values`` row per ``max_rows`` rows, and the rows of ``df`` are dealt out over the copies by a hash
    of their other columns, wherever they lie; rows of other keys are hashed by their key only. Rows with
    a null key match nothing, and are dealt out if they are many. Without hot keys it is a plain join.
    """
    if not hot:
        return df.join(values, keys, "left")
    listed = F.broadcast(_listed(df, hot, max_rows))
    others = [f.name for f in df.schema if f.name not in keys and f.dataType.typeName() not in ("map", "variant")]
    row = F.xxhash64(*others) if others else F.lit(0).cast("long")
    hashed = key_hash(keys, df.schema, named)
    dealt = df.withColumn("_hash", hashed).join(listed, "_hash", "left").withColumn(
        "_salt", F.when(F.col("_copies") > 1, F.pmod(row, F.col("_copies")).cast("int")).otherwise(0))
    copied = values.withColumn("_hash", hashed).join(listed, "_hash", "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)))
    return dealt.drop("_copies", "_hash").join(copied.drop("_copies", "_hash"), keys + ["_salt"], "left").drop("_salt")


def attach_group_aggregates(df: DataFrame, keys: list[str], aggregates: dict,
                            max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Give every row the aggregates of its group; partial sums meet before the shuffle.

    Rows with a null key belong to no group and get null aggregates. The aggregates are stored, so
    that ``df`` is read once for them and their real size decides how they are joined.
    """
    values = store(df.groupBy(*keys).agg(
        *[c.alias(name) for name, c in aggregates.items()], F.count(F.lit(1)).alias("n")), "groups")
    # At most rows / max_rows groups.
    hot = values.where(F.col("n") > max_rows).select(key_hash(keys, df.schema).alias("h"), "n").collect()
    return join_spread(df, values.drop("n"), keys, {r["h"]: r["n"] for r in hot}, max_rows)


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def join_lookup(df: DataFrame, lookup: DataFrame, keys: list[str],
                max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                max_rows: int = MAX_GROUP_ROWS, small: bool | None = None) -> DataFrame:
    """Left join to a lookup table with one row per key.

    A lookup counted to be small is broadcast and ``df`` is not shuffled. A larger one is joined by
    shuffle, with the frequent keys of ``df`` spread out. ``small`` tells what an earlier count said.
    """
    if small is None:
        small = is_small(lookup, max_broadcast_rows)
    if small:
        return df.join(F.broadcast(lookup), keys, "left")
    return join_spread(df, lookup, keys, frequent_hashes(df, key_hash(keys, df.schema), max_rows), max_rows)
