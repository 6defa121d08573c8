"""Near duplicates by 64-bit SimHash: exact comparison of fingerprints in tiles.

Distinct fingerprints are compared tile by tile with exclusive-or and bit counts. Tiles hold
fingerprints of like population count, and tile pairs whose counts differ by more than the radius
are skipped, since the counts of two fingerprints differ by at most as much as their bits. Comparing
all tiles of a corpus would grow with its square, so tiles are laid out inside buckets of equal bit
blocks: cut into ``blocks`` blocks, two fingerprints within the radius agree in at least
``blocks - radius`` of them, so each pair meets in some bucket and none is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtide.llm.common import spread_join, text_bytes
from railtide.llm.components import components
from railtide.session import store

RADIUS = 4
SHINGLE_WORDS = 4
SEED = 42
# Fingerprints of one bucket that are compared in one task; larger buckets are cut into tiles.
TILE = 4096
# Side of the squares compared at once inside a tile pair.
SQUARE = 512
# Most buckets that are cut, which bounds what is broadcast about them.
MOST_CUT = 100_000

# For every byte its bits in eight lanes of a byte each.
_LANES = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
          .view(np.uint64).ravel())


def shingle_hashes(data: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``words`` words, or of all words if there are fewer."""
    line = b" ".join(data.lower().split())
    if not line:
        return np.zeros(0, np.uint64)
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    if len(spaces) + 1 <= words:
        return np.array([xxhash.xxh64_intdigest(line, seed)], np.uint64)
    starts = [0, *(spaces[:len(spaces) + 1 - words] + 1).tolist()]
    ends = [*spaces[words - 1:].tolist(), len(line)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(starts, ends)), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if more than half of the hashes have it; zero without hashes."""
    if not len(hashes):
        return 0
    lanes = _LANES[hashes.view(np.uint8).reshape(-1, 8)]
    # A lane of a byte holds up to 255 ones.
    sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
    ones = np.ascontiguousarray(sums).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def _fingerprints(batches):
    for batch in batches:
        texts = batch.column("data")
        values = (fingerprint(shingle_hashes(t.as_py())) for t in texts)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(np.fromiter(values, np.int64, len(texts)))],
            names=["doc_id", "text_hash", "fp"])


def text_hash():
    """Tells rows of the same doc_id apart; a null text counts as empty."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint's 64 bits as a long) of every row."""
    return docs.select("doc_id", text_hash().alias("text_hash"), text_bytes().alias("data")).mapInArrow(
        _fingerprints, "doc_id long, text_hash long, fp long")


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect all fingerprints within the radius, as a forest of each square.

    ``right`` None compares ``left`` with itself. Both are taken in the order of their population
    counts; squares whose counts differ by more than the radius are skipped.
    """
    squares = []
    for values in (left, right):
        if values is not None:
            counts = np.bitwise_count(values.view(np.uint64)).astype(np.int64)
            order = np.argsort(counts, kind="stable")
            squares.append([(values[o], counts[o[0]], counts[o[-1]])
                            for o in np.split(order, range(SQUARE, len(order), SQUARE))])
    links = []
    for i, (a, a_low, a_high) in enumerate(squares[0]):
        for b, b_low, b_high in squares[0][i:] if right is None else squares[1]:
            if b_low - a_high > radius or a_low - b_high > radius:
                continue
            near = np.bitwise_count((a[:, None] ^ b[None, :]).view(np.uint64)) <= radius
            if a is b:
                np.fill_diagonal(near, False)
            rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
            if len(rows):
                links.append(_forest(a[rows], b[columns], near[np.ix_(rows, columns)]))
    return links


def _forest(a: np.ndarray, b: np.ndarray, near: np.ndarray):
    """Every node joined to the smallest node that it reaches inside the square."""
    top = np.iinfo(np.int64).max
    of_a, of_b = a.copy(), b.copy()
    while True:
        new_b = np.minimum(of_b, np.where(near, of_a[:, None], top).min(axis=0))
        new_a = np.minimum(of_a, np.where(near, new_b[None, :], top).min(axis=1))
        if np.array_equal(new_a, of_a) and np.array_equal(new_b, of_b):
            break
        of_a, of_b = new_a, new_b
    nodes, roots = np.concatenate([a, b]), np.concatenate([of_a, of_b])
    moved = nodes != roots
    return nodes[moved], roots[moved]


def _compare(radius: int):
    def run(batches):
        for batch in batches:
            lefts, rights = batch.column("lefts"), batch.column("rights")
            found = []
            for i in range(batch.num_rows):
                right = rights[i].values
                found += tile_links(lefts[i].values.to_numpy(), None if right is None else right.to_numpy(), radius)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([f[side] for f in found])) for side in (0, 1)], names=["a", "b"])
    return run


def block_keys(blocks: int, radius: int) -> list[int]:
    """Bit masks of every choice of ``blocks - radius`` of the blocks."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    masks = [sum(1 << bit for bit in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(masks, blocks - radius)]


def fingerprint_links(unique: DataFrame, radius: int = RADIUS, tile: int = TILE, blocks: int | None = None) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` within the radius.

    ``blocks`` changes the work, not the result: with more blocks buckets are smaller and there are
    more of them. By default it follows the number of fingerprints.
    """
    total = unique.count()
    if blocks is None:
        blocks = radius + (1 if total < 5_000_000 else 2 if total < 1_000_000_000 else 3)
    signed = [m - (1 << 64) if m >> 63 else m for m in block_keys(blocks, radius)]
    keys = F.array(*[F.struct(F.lit(i).alias("way"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for i, m in enumerate(signed)])
    keyed = unique.select("fp", F.bit_count("fp").alias("ones"), F.explode(keys).alias("k")).select(
        "k.way", "k.key", "fp", "ones")
    limit = max(tile, total * len(signed) // MOST_CUT)
    large = keyed.groupBy("way", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).drop("n")
    large = store(large, "large")
    empty = F.lit(None).cast("array<long>")
    small = keyed.join(F.broadcast(large), ["way", "key"], "left_anti").groupBy("way", "key").agg(
        F.collect_list("fp").alias("lefts")).where(F.size("lefts") > 1).select("lefts", empty.alias("rights"))

    # A large bucket's tiles: population count, and a part if one count has more than a tile.
    cut = keyed.join(F.broadcast(large), ["way", "key"])
    sizes = cut.groupBy("way", "key", "ones").agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias("parts"))
    cut = cut.join(sizes, ["way", "key", "ones"]).withColumn(
        "tile", F.col("ones") * 1_000_000 + F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    tiles = store(cut.groupBy("way", "key", "tile", "ones").agg(F.collect_list("fp").alias("fps")), "tiles")
    # Which tiles meet is decided by their names; both joins with their contents are on a bucket and
    # tile, so the pairs of a bucket are dealt over as many keys as it has tiles.
    names = tiles.select("way", "key", "tile", "ones")
    met = names.join(names.select("way", "key", F.col("tile").alias("_tile"), F.col("ones").alias("_ones")), ["way", "key"]).where(
        (F.col("tile") <= F.col("_tile")) & (F.col("_ones") - F.col("ones") <= radius)).select("way", "key", "tile", "_tile")
    contents = tiles.select("way", "key", "tile", F.col("fps").alias("lefts"))
    others = tiles.select("way", "key", F.col("tile").alias("_tile"), F.col("fps").alias("rights"))
    pairs = met.join(contents, ["way", "key", "tile"]).join(others, ["way", "key", "_tile"]).select(
        "lefts", F.when(F.col("tile") != F.col("_tile"), F.col("rights")).alias("rights"))
    return small.unionByName(pairs).mapInArrow(_compare(radius), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, component_id, component, text_hash.

    Words are lower-cased in A-Z only and split at ASCII white space; a null or empty text has the
    fingerprint zero and is linked like any other. component_id is the smallest doc_id reachable
    over links of at most ``radius`` bits, null if all of them are null; component numbers the groups
    of the latter too. Rows may repeat; other columns are not read; an empty table gives no rows.
    Equal fingerprints are compared once.
    """
    rows = store(fingerprints(docs), "fingerprints")
    unique = store(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "unique")
    links = store(fingerprint_links(unique.select("fp"), radius), "links")
    labels = components(links)
    known = unique.join(labels, unique.fp == labels.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = store(known.join(smallest, "component").select("fp", "component_id", "component"), "components")
    return spread_join(rows, known, ["fp"], "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component", "text_hash")


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Of every group of near copies the row with the smallest doc_id; all columns of ``docs``.

    A null doc_id comes after all others. Of rows with the same doc_id the one with the smallest
    hash of its text stays, of rows equal in both any one.
    """
    key = lambda i, h: F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("")), h.cast("string"))
    first = near_duplicates(docs, radius).groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")).alias("first"))
    first = first.select(key(F.col("first.doc_id"), F.col("first.text_hash")).alias("key"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), key(F.col("doc_id"), text_hash()).alias("key"))
    return rows.join(first, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
