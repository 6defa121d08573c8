"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Rows are cut into blocks. A block sends every owner of a hash range the sorted distinct hashes of
its texts in that range, as Golomb-Rice coded gaps, and gets back one bit per hash: does another
block hold it too? Only texts with that bit, or repeated inside their block, are suspects; they
are shuffled whole and compared byte by byte.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtide.llm.common import spread_join, text_bytes
from railtide.session import store

# Hashes that one owner decodes at once, which bounds its memory.
HASHES_PER_OWNER = 4_000_000


def golomb_encode(values: np.ndarray, span: int) -> bytes:
    """Sorted distinct unsigned values below ``span`` as Rice-coded gaps: unary parts, then low bits."""
    n = len(values)
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    k = min(62, max(0, int(math.log2(max(1.0, span / max(n, 1) * math.log(2))))))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if n else 0, np.uint8)
    unary[ends] = 1
    shifts = np.arange(k, dtype=np.uint64)
    low = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    packed = np.packbits(unary)
    head = np.array([n, k, len(packed)], "<u4").tobytes()
    return head + packed.tobytes() + np.packbits(low.ravel()).tobytes()


def golomb_decode(data: bytes) -> np.ndarray:
    n, k, size = (int(x) for x in np.frombuffer(data, "<u4", 3))
    if not n:
        return np.zeros(0, np.uint64)
    unary = np.unpackbits(np.frombuffer(data, np.uint8, size, 12))
    quotients = np.diff(np.flatnonzero(unary)[:n], prepend=-1).astype(np.uint64) - np.uint64(1)
    low = np.zeros(n, np.uint64)
    if k:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=12 + size), count=n * k).reshape(n, k)
        low = (bits.astype(np.uint64) << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum((quotients << np.uint64(k)) | low, dtype=np.uint64)


BLOCK_ROWS = pa.schema([
    ("block", pa.int64()), ("owner", pa.int32()), ("pos", pa.int32()), ("doc_id", pa.int64()), ("data", pa.binary()),
    ("sha", pa.binary()), ("slot", pa.int32()), ("repeated", pa.bool_()), ("message", pa.binary())])


def _hash_blocks(owner_bits: int):
    """Each Arrow batch becomes a block: its rows, then its message to every owner."""
    span = 1 << (64 - owner_bits)

    def run(batches):
        partition = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            texts = batch.column("data").to_pylist()
            hashes = np.fromiter((xxhash.xxh64_intdigest(t) for t in texts), np.uint64, len(texts))
            distinct, place, counts = np.unique(hashes, return_inverse=True, return_counts=True)
            owners = (distinct >> np.uint64(64 - owner_bits)).astype(np.int32)
            slots = (np.arange(len(distinct)) - np.searchsorted(owners, owners)).astype(np.int32)
            block = (partition << 32) + number
            rows = {
                "block": np.full(len(texts), block), "owner": owners[place],
                "pos": np.arange(len(texts), dtype=np.int32), "doc_id": batch.column("doc_id"),
                "data": batch.column("data"), "sha": [hashlib.sha256(t).digest() for t in texts],
                "slot": slots[place], "repeated": counts[place] > 1, "message": [None] * len(texts)}
            yield _batch(rows)
            listed = np.unique(owners)
            yield _batch({"block": np.full(len(listed), block), "owner": listed, "message": [
                golomb_encode(distinct[owners == o] & np.uint64(span - 1), span) for o in listed]})
    return run


def _batch(columns: dict) -> pa.RecordBatch:
    n = len(columns["block"])
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns and not isinstance(columns[f.name], pa.Array)
         else columns.get(f.name, pa.nulls(n, f.type)) for f in BLOCK_ROWS], schema=BLOCK_ROWS)


def _answer(table: pa.Table) -> pa.Table:
    """For every message to one owner, a bit per hash: held by more than one message."""
    lists = [golomb_decode(p) for p in table.column("message").to_pylist()]
    distinct, place, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared = np.split(counts[place] > 1, np.cumsum([len(x) for x in lists])[:-1])
    words = []
    for bits in shared:
        padded = np.zeros(-(-len(bits) // 64) * 64, bool)
        padded[:len(bits)] = bits
        words.append(np.packbits(padded, bitorder="little").view("<i8").tolist())
    return pa.table({"block": table.column("block"), "owner": table.column("owner"),
                     "words": pa.array(words, pa.list_(pa.int64()))})


def exact_dedup(docs: DataFrame, hashes_per_owner: int = HASHES_PER_OWNER) -> DataFrame:
    """One row per row of ``docs``: which copy of its text stays.

    Returns doc_id, keep_id, group_size, kept, text_sha256. A null text counts as empty and nothing
    else is normalised. The row with the largest doc_id stays; a null doc_id is smaller than any
    other; of rows repeated with the same doc_id one stays. Other columns of ``docs`` are not read.
    An empty table gives an empty result. Memory: one Arrow batch of texts, one owner's hashes.
    """
    rows = docs.select("doc_id", text_bytes().alias("data"))
    owner_bits = max(4, math.ceil(math.log2(max(1, docs.count() / hashes_per_owner))))
    stored = store(rows.mapInArrow(_hash_blocks(owner_bits), (
        "block long, owner int, pos int, doc_id long, data binary, sha binary, slot int, repeated boolean, "
        "message binary")), "blocks")
    blocks = stored.where(F.col("message").isNull()).drop("message")
    messages = stored.where(F.col("message").isNotNull()).select("block", "owner", "message")
    answers = messages.groupBy("owner").applyInArrow(_answer, "block long, owner int, words array<long>")
    answers = store(answers, "bitmaps")

    bit = F.expr("getbit(words[slot div 64], slot % 64) = 1")
    told = blocks.join(answers, ["block", "owner"]).withColumn("suspect", F.col("repeated") | bit)
    row = F.struct("doc_id", "block", "pos")
    groups = told.where("suspect").groupBy("data").agg(
        F.max(row).alias("keep"), F.count(F.lit(1)).alias("group_size"), F.first("sha").alias("sha"))
    groups = store(groups.drop("data"), "groups")
    lights = store(told.select("doc_id", "block", "pos", "sha", "suspect"), "rows")
    same = spread_join(lights.where("suspect"), groups, ["sha"], "inner")
    alone = lights.where(~F.col("suspect")).withColumns(
        {"keep": F.struct("doc_id", "block", "pos"), "group_size": F.lit(1).cast("long")})
    return same.unionByName(alone).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        F.struct("doc_id", "block", "pos").eqNullSafe(F.col("keep")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
