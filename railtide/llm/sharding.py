"""Rendezvous hashing of record keys over weighted shards, with gapless slots in each shard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtide.operators.ordering import range_chunks


def rendezvous(key: Column, shards: int, weights: list[float] | None = None) -> Column:
    """The shard that scores highest for the key.

    A shard's score is ``-weight / ln(u)`` with ``u`` in (0, 1) drawn by a hash of key and shard, so
    shards get shares in proportion to their weights, and a further shard only takes keys, never
    moves one between the others. A null key is a key of its own.
    """
    weights = weights or [1.0] * shards
    if len(weights) != shards or min(weights) <= 0:
        raise ValueError("one positive weight per shard is needed")
    base = F.xxhash64(key)
    scores = []
    for shard in range(shards):
        bits = F.shiftrightunsigned(F.xxhash64(base, F.lit(shard).cast("long")), 11)
        u = (bits.cast("double") + 0.5) / float(1 << 53)
        scores.append(F.struct((-F.lit(float(weights[shard])) / F.log(u)).alias("score"), F.lit(shard).alias("shard")))
    best = F.greatest(*scores) if shards > 1 else scores[0]
    return best["shard"]


def shard_rows(docs: DataFrame, shards: int = 16, weights: list[float] | None = None,
               grown_weight: float = 1.0) -> DataFrame:
    """Shard and slot of every row, and its shard if there were one more.

    Returns doc_id, size, text_crc32, law, shard, slot, grown_shard. Size is the UTF-8 length of the
    text plus one, a null text counts as empty. Slots count from 0 in each shard in the order of
    doc_id (nulls first), then crc32 and size; rows equal in all three are interchangeable. All rows
    with a null doc_id share a shard. Other columns are not read; an empty table gives no rows.

    Only ids, sizes and checksums are shuffled: rows are cut into ranges of doc_id, a row's slot is
    its rank within range and shard after the counts of the ranges before.
    """
    weights = weights or [1.0] * shards
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", (F.octet_length(data).cast("long") + 1).alias("size"), F.crc32(data).alias("text_crc32"),
        rendezvous(F.col("doc_id"), shards, weights).alias("shard"),
        rendezvous(F.col("doc_id"), shards + 1, [*weights, grown_weight]).alias("grown_shard"))
    order = ["doc_id", "text_crc32", "size"]
    chunks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunked = range_chunks(rows, order, chunks)
    counts = chunked.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    # One row per shard and range: as many as shards times shuffle partitions.
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "chunk").orderBy(*order)
    return (
        chunked.withColumn("rank", F.row_number().over(inside) - 1).join(starts, ["shard", "chunk"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                (F.col("start") + F.col("rank")).alias("slot"), "grown_shard")
    )
