"""Global positions and per-group order without pulling an ordered table into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railtide.session import store


def range_chunks(df: DataFrame, order: list, chunks: int, name: str = "chunk") -> DataFrame:
    """Cut the table into ``chunks`` consecutive ranges of ``order`` and number them.

    The number is the range partition, which a second evaluation could draw differently, so the
    result is stored.
    """
    ranged = df.repartitionByRange(chunks, *order)
    return store(ranged.withColumn(name, F.spark_partition_id()), "ranges")


# monotonically_increasing_id holds the partition above these bits and the row below.
_ROW_BITS = 33


def ordered_index(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """Add the 0-based position of every row in the order of ``order``, which should be unique.

    Rows are ordered and numbered inside range chunks, which takes one shuffle, and stored, since a
    second evaluation could cut the ranges differently. Each chunk starts where the one before ends.
    """
    chunks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = store(df.repartitionByRange(chunks, *order).sortWithinPartitions(*order).withColumn(
        "_id", F.monotonically_increasing_id()), "ranges")
    chunk = F.shiftright("_id", _ROW_BITS).alias("_chunk")
    starts = _starts(placed.groupBy(chunk).agg(F.count(F.lit(1)).alias("_size")))
    return (
        placed.withColumn("_chunk", chunk).join(F.broadcast(starts), "_chunk")
        .withColumn(name, F.col("_start") + F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1))
        .drop("_chunk", "_start", "_size", "_id")
    )


def _starts(sizes: DataFrame) -> DataFrame:
    """Rows before each chunk. There are as many chunks as shuffle partitions."""
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))


def rows_at(df: DataFrame, order: list[str], positions: list[int], name: str = "pos") -> DataFrame:
    """The rows at some few positions of the order. Only the chunks that hold one are ordered."""
    chunks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunked = range_chunks(df, order, chunks, "_chunk")
    starts = _starts(chunked.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_size")))
    wanted = F.exists(F.array(*[F.lit(p) for p in positions]),
                      lambda p: (p >= F.col("_start")) & (p < F.col("_start") + F.col("_size")))
    inside = Window.partitionBy("_chunk").orderBy(*order)
    # At most one chunk per position.
    return (
        chunked.join(F.broadcast(starts.where(wanted)), "_chunk")
        .withColumn(name, F.col("_start") + F.row_number().over(inside) - 1)
        .where(F.col(name).isin(positions)).drop("_chunk", "_start", "_size")
    )
