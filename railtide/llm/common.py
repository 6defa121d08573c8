"""What several operators of this package share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one key that one task may meet; a hotter key is dealt out over several copies.
ROWS_PER_COPY = 100_000
# Most keys that can be called hot, which bounds what is broadcast about them.
MOST_HOT_KEYS = 10_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text"):
    """UTF-8 bytes of a text; a null text counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def id_remainder(divisor: int, column: str = "doc_id"):
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left",
                rows_per_copy: int = ROWS_PER_COPY) -> DataFrame:
    """Equi-join in which a frequent key of ``left`` is dealt out over several tasks.

    Keys with more rows than ``rows_per_copy``, or than a ten-thousandth of all rows if that is
    more, are counted first: at most ten thousand keys, which are broadcast. Such a key's rows of
    ``right`` are copied, and its rows of ``left`` go to the copies by a hash of all their columns.
    Null keys match nothing.
    """
    limit = max(rows_per_copy, left.count() // MOST_HOT_KEYS)
    hot = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    hot = F.broadcast(hot.select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("_copies")))
    copies = F.coalesce("_copies", F.lit(1))
    dealt = left.join(hot, keys, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*left.columns), copies).cast("int"))
    copied = right.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    return dealt.drop("_copies").join(copied.drop("_copies"), [*keys, "_salt"], how).drop("_salt")
