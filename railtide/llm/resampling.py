"""Importance resampling towards a target: documents whose words are those of the target come first.

Features are runs of one and two words, hashed into buckets. A bucket's gain is the log ratio of its
smoothed shares in the target and in the documents, a document's weight the mean gain of its features,
and a draw without replacement takes the largest weights after adding Gumbel noise.

Both passes over the texts go through a batch at a time: its texts are joined with a sentinel, one
pass of a regular expression finds all words, and the sentinels' places, looked up by binary search,
tell which document a word belongs to and mask the runs that would cross from one into the next.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtide.llm.common import text_bytes
from railtide.operators.ordering import ordered_index
from railtide.session import store

BUCKETS = 10_000
FEWEST_WORDS = 20
DRAWN_PERCENT = 25
SEED = 7
# Bytes of text that are joined at once, and words that a task remembers.
JOINED_BYTES = 2_000_000
REMEMBERED = 300_000

_SENTINEL = b"\x00"
# A-Z to a-z; a zero byte of a text is white space, so that the sentinel stands for itself alone.
_LOWER = bytes(32 if b == 0 else b + 32 if 65 <= b <= 90 else b for b in range(256))
# Bytes above 127 are those of signs outside ASCII, all of which belong to words.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+|\x00")

# What a byte alone makes of a checksum of zeros.
_BYTE = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
# Longest second word, with the space before it, of a run whose checksum is put together from tables.
_LONGEST = 64


def _shifts() -> np.ndarray:
    """[n, k, b]: what byte ``k`` of a checksum, being ``b``, becomes when ``n`` more bytes follow."""
    tables = np.empty((_LONGEST + 1, 4, 256), np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(_LONGEST):
        tables[n + 1] = _BYTE[tables[n] & 255] ^ (tables[n] >> np.uint32(8))
    return tables


_SHIFTS = _shifts().reshape(-1, 256)


class Words(dict):
    """Numbers words as they are met and keeps the checksums of a word and of a space and the word."""

    def __init__(self):
        super().__init__()
        self.names: list[bytes] = []
        self.alone, self.after, self.sizes = (np.zeros(0, t) for t in (np.uint32, np.uint32, np.int64))

    def __missing__(self, word):
        self[word] = place = len(self.names)
        self.names.append(word)
        return place

    def places(self, words: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        new = self.names[len(self.alone):]
        self.alone = np.append(self.alone, np.fromiter((zlib.crc32(w) for w in new), np.uint32, len(new)))
        self.after = np.append(self.after, np.fromiter((zlib.crc32(b" " + w) for w in new), np.uint32, len(new)))
        self.sizes = np.append(self.sizes, np.fromiter((len(w) + 1 for w in new), np.int64, len(new)))
        return found


def _pair_checksums(words: Words, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """crc32 of ``first``, a space and ``second``: that of the first moved on, with that of the rest."""
    before, size = words.alone[first], words.sizes[second]
    long = size > _LONGEST
    row = np.where(long, 0, size) * 4
    moved = words.after[second]
    for k in range(4):
        moved = moved ^ _SHIFTS[row + k, before >> np.uint32(8 * k) & np.uint32(255)]
    for i in np.flatnonzero(long):
        moved[i] = zlib.crc32(b" " + words.names[second[i]], int(before[i]))
    return moved


def feature_buckets(texts: list[bytes], words: Words):
    """(buckets, document of each, number of words per document) of the features of some texts."""
    joined = _SENTINEL.join(t.translate(_LOWER) for t in texts)
    found = words.places([_SENTINEL, *_WORD.findall(joined)])
    # The first one found is a sentinel, put before the first text.
    edges = np.flatnonzero(found == found[0])
    document = np.searchsorted(edges, np.arange(len(found)), side="right") - 1
    is_word = found != found[0]
    pair = is_word[1:] & is_word[:-1] & (document[1:] == document[:-1])
    single = words.alone[found[is_word]]
    double = _pair_checksums(words, found[:-1][pair], found[1:][pair])
    buckets = np.concatenate([single, double]) % np.uint32(BUCKETS)
    owner = np.concatenate([document[is_word], document[1:][pair]])
    return buckets.astype(np.int64), owner, np.bincount(document[is_word], minlength=len(texts))


def _parts(batches):
    """Every batch in parts of bounded size: (batch, first row, row after the last, features)."""
    words = Words()
    for batch in batches:
        column = batch.column("data")
        sizes = pc.binary_length(column).to_numpy().astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < len(sizes):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + JOINED_BYTES, side="right")))
            if len(words) > REMEMBERED:
                words = Words()
            yield batch, at, to, feature_buckets(column.slice(at, to - at).to_pylist(), words)
            at = to


def _count(batches):
    total = np.zeros(BUCKETS, np.int64)
    for _, _, _, (buckets, _, _) in _parts(batches):
        total += np.bincount(buckets, minlength=BUCKETS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])


def _rows(texts: DataFrame) -> DataFrame:
    return texts.select(text_bytes().alias("data"))


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features per bucket over all texts. Every task sends one row per bucket, which Spark sums."""
    counted = _rows(texts).mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(BUCKETS, np.int64)
    total[counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    return total


def bucket_gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares in the target and in the documents, rounded down."""
    ratio = (target + 1) * (documents.sum() + BUCKETS) / ((documents + 1) * float(target.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weigh(gains: np.ndarray):
    def run(batches):
        for batch, at, to, (buckets, owner, n_words) in _parts(batches):
            # Gains are whole numbers, which doubles sum without error.
            sums = np.bincount(owner, gains[buckets], minlength=to - at).astype(np.int64)
            features = np.maximum(0, 2 * n_words - 1)
            weights = np.where(features > 0, sums // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(at, to - at), pa.array(n_words), pa.array(features), pa.array(weights)],
                names=["doc_id", "n_words", "n_features", "weight"])
    return run


def gumbel(seed: int):
    """Thousandths of standard Gumbel noise, drawn by a hash of the id; rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    head = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((head + 0.5) / 4294967296))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, fewest_words: int = FEWEST_WORDS,
             seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``.

    ``docs`` has doc_id and text, ``target`` has text; other columns are not read. Words are runs of
    ASCII letters and digits, lower-cased in A-Z, and of all signs outside ASCII. Of the rows with at
    least ``fewest_words`` words, ``percent`` of a hundred (rounded down) are drawn: the highest scores, ties to the
    smaller doc_id, a null doc_id last. They have their place as rank, all others null. Rows that repeat are rows of
    their own; equal in everything, they may be drawn in any order. A null or empty text has no
    features, weight 0 and is never drawn; an empty table gives no rows. An empty target leaves the
    smoothing to weigh by.
    """
    gains = bucket_gains(bucket_counts(docs), bucket_counts(target))
    weighed = docs.select("doc_id", text_bytes().alias("data")).mapInArrow(
        _weigh(gains), "doc_id long, n_words long, n_features long, weight long")
    scored = store(weighed.withColumn("score", F.col("weight") + gumbel(seed)), "scored")
    eligible = scored.where(F.col("n_words") >= fewest_words)
    drawn = eligible.count() * percent // 100
    last = F.lit(-(1 << 63)).cast("long")
    # Highest scores first; positions come from range chunks, not from one ordered partition.
    placed = ordered_index(eligible.select(
        "doc_id", "n_features", "weight", "score", (-F.col("score")).alias("down"),
        F.col("doc_id").isNull().alias("nameless"), F.coalesce("doc_id", last).alias("name")), ["down", "nameless", "name"])
    columns = ["doc_id", "n_features", "weight", "score"]
    rank = F.col("pos") + 1
    return placed.select(*columns, F.when(rank <= drawn, rank).alias("rank")).unionByName(
        scored.where(F.col("n_words") < fewest_words).select(*columns, F.lit(None).cast("long").alias("rank")))
