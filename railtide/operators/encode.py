"""Category codes: rank of the text in code-point order over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtide.constants import (
    CATEGORY_COLUMNS, FLAG_CODES, FLAG_COLUMNS, MAX_BROADCAST_ROWS, MAX_GROUP_ROWS, NULL_CATEGORY,
)
from railtide.functions.values import category_text, encode_flag
from railtide.operators.ordering import ordered_index
from railtide.operators.skew import frequent_hashes, join_lookup, join_spread
from railtide.session import forget, store


def category_codes(df: DataFrame, columns: list[str] = CATEGORY_COLUMNS,
                   null_token: str = NULL_CATEGORY) -> DataFrame:
    """``(column, value, code)`` with codes from 0 for each column that exists."""
    columns = [c for c in columns if c in df.columns]
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), category_text(F.col(c), null_token).alias("value"))
        for c in columns])
    # Stored, so that cutting the ranges does not look for the values again.
    values = store(df.select(F.inline(pairs)).distinct(), "values")
    ranked = ordered_index(values, ["column", "value"])
    # One row per encoded column.
    first = ranked.groupBy("column").agg(F.min("pos").alias("_first"))
    codes = store(ranked.join(F.broadcast(first), "column").select(
        "column", "value", (F.col("pos") - F.col("_first")).cast("int").alias("code")), "codes")
    forget(values, ranked)
    return codes


def encode_categories(df: DataFrame, codes: DataFrame, columns: list[str] = CATEGORY_COLUMNS,
                      null_token: str = NULL_CATEGORY, max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                      max_rows: int = MAX_GROUP_ROWS, replace: bool = False) -> DataFrame:
    """Add ``<column>_encoded`` from a code table; with ``replace`` in place of the text.

    The smallest lookups are broadcast as long as all of them together stay within the limit. For
    the others frequent values are found in one pass, over all columns and on the table as it came in,
    so that each further lookup adds one join and no further look at the table. With ``replace`` texts go
    before rows are shuffled for the next lookup, the broadcast ones first, and rows are stored between two such
    lookups, so that only one of them has its shuffle files at a time.
    """
    columns = [c for c in columns if c in df.columns]
    # One row per encoded column.
    sizes = {r["column"]: r["count"] for r in codes.groupBy("column").count().collect()}
    budget = max_broadcast_rows
    small = set()
    for c in sorted(columns, key=lambda c: sizes.get(c, 0)):
        budget -= sizes.get(c, 0)
        if budget >= 0:
            small.add(c)
    large = [c for c in columns if c not in small]
    if large:
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), category_text(F.col(c), null_token).alias("_value"))
                          for c in large])
        hot = frequent_hashes(df.select(F.inline(pairs)), F.xxhash64("column", "_value"), max_rows)
    names = df.columns
    order = sorted(columns, key=lambda c: c not in small) if replace else columns
    between = None
    for c in order:
        own = codes.where(F.col("column") == c).select(
            F.col("value").alias("_value"), F.col("code").alias(f"{c}_encoded"))
        keyed = df.withColumn("_value", category_text(F.col(c), null_token))
        if c in small:
            df = keyed.join(F.broadcast(own), ["_value"], "left").drop("_value")
        else:
            df = join_spread(keyed, own, ["_value"], hot, max_rows, named=c).drop("_value")
        if replace:
            df = df.drop(c)
            if c in large and c != order[-1]:
                before, between = between, store(df, "encoded")
                df = between
                forget(*([before] if before is not None else []))
    if replace:
        df = df.select(*[n for n in names if n not in columns], *[f"{c}_encoded" for c in columns])
    return df


def decode_category(df: DataFrame, codes: DataFrame, column: str, code: str, name: str) -> DataFrame:
    """Add the text of a code as ``name``."""
    own = codes.where(F.col("column") == column).select(
        F.col("code").alias(code), F.col("value").alias(name))
    return join_lookup(df, own, [code])


def encode_flags(df: DataFrame, columns: list[str] = FLAG_COLUMNS) -> DataFrame:
    return df.withColumns({
        f"{c}_encoded": encode_flag(F.col(c)) for c in columns if c in df.columns})


def encoding_table(codes: DataFrame, flags: list[str] = FLAG_COLUMNS) -> DataFrame:
    """The code table with the fixed flag codes added."""
    spark = codes.sparkSession
    rows = [(f, text, code) for f in flags for text, code in FLAG_CODES.items()]
    if not rows:
        return codes
    return codes.unionByName(spark.createDataFrame(rows, "column string, value string, code int"))
