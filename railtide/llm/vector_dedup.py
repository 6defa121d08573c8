"""Near-duplicate vectors: random-hyperplane sign hashing, exact cosines, connected components.

Equal vectors of a label are one class and compared once. Every class is hashed into several tables:
a table's key is the side of each of its hyperplanes that the vector lies on. Classes of one bucket
(label, dimension, table, key) are compared by their exact cosines, a block of a matrix product at a
time. A pair counts in the first table in which both keys agree, so links need no second shuffle to
be told apart, and a comparison returns sums per class and a forest of its links, never all pairs. Buckets
above a tile's size are cut into tiles, and their pairs of tiles are dealt out over all tasks.

The number of hyperplanes follows the number of classes, and the number of tables is the smallest with
which a pair at the limit is missed with a chance of at most ``MISSED``. Pairs above the limit are missed less often.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from railtide.llm.common import spread_join
from railtide.llm.components import components
from railtide.session import store

LIMIT = 0.98
MISSED = 0.002
# Classes that share a bucket on average, and the most and fewest hyperplanes of a table.
PER_BUCKET, FEWEST_PLANES, MOST_PLANES = 256, 4, 24
# Classes that are compared with each other at once.
TILE = 1024
# Most buckets that are cut, which bounds what is known of each task's tiles.
MOST_CUT = 100_000
SEED = 23


def plan_tables(classes: int, limit: float = LIMIT, missed: float = MISSED) -> tuple[int, int]:
    """(hyperplanes of a table, tables) for so many classes of the largest label."""
    planes = min(MOST_PLANES, max(FEWEST_PLANES, math.ceil(math.log2(max(1, classes) / PER_BUCKET))))
    same = (1 - math.acos(limit) / math.pi) ** planes
    return planes, math.ceil(math.log(missed) / math.log1p(-same))


def _hyperplanes(dimension: int, planes: int, tables: int) -> np.ndarray:
    rng = np.random.default_rng([SEED, dimension])
    return rng.standard_normal((dimension, tables * planes))


def _pack(width: str):
    """Vectors as bytes with a digest; null where a vector cannot be compared."""
    def run(batches):
        for batch in batches:
            data, digests = [], []
            for vector in batch.column("embedding"):
                # Adding zero turns minus zero into zero.
                values = (np.asarray(vector.values.to_numpy(zero_copy_only=False), "<f8") + 0.0
                          if vector.is_valid else np.zeros(0))
                usable = len(values) and np.isfinite(values).all() and values.any()
                data.append(values.astype(width).tobytes() if usable else None)
                digests.append(hashlib.blake2b(data[-1], digest_size=24).digest() if usable else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(data, pa.binary()), pa.array(digests, pa.binary())],
                names=["vec_id", "label", "data", "digest"])
    return run


def _unit(data: list[bytes], width: str) -> np.ndarray:
    """Unit vectors in double precision. The largest component is brought to one first, so that no square overflows."""
    values = np.frombuffer(b"".join(data), width).reshape(len(data), -1).astype(float)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def _keys(width: str, planes: int, tables: int):
    weights = 1 << np.arange(planes, dtype=np.int64)

    def run(batches):
        for batch in batches:
            sizes = np.array([len(d) for d in batch.column("data").to_pylist()], np.int64)
            keys = np.zeros((batch.num_rows, tables), np.int32)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                unit = _unit(batch.column("data").take(pa.array(rows)).to_pylist(), width)
                sides = unit @ _hyperplanes(unit.shape[1], planes, tables) > 0
                keys[rows] = sides.reshape(len(rows), tables, planes) @ weights
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * tables), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "keys"])
    return run


class _Side:
    """One tile: its classes, their sizes, unit vectors and keys."""

    def __init__(self, members: pa.StructArray, width: str):
        self.ids = members.field("class").to_numpy()
        self.sizes = members.field("n").to_numpy()
        self.unit = _unit(members.field("data").to_pylist(), width)
        keys = members.field("keys")
        self.keys = keys.flatten().to_numpy().reshape(len(self.ids), -1)


def _links(left: _Side, right: _Side, table: int, limit: float):
    """Rows and columns of the pairs within the limit whose keys agree in no earlier table."""
    near = left.unit @ right.unit.T >= limit
    if left is right:
        near = np.triu(near, 1)
    rows, columns = np.nonzero(near)
    earlier = np.zeros(len(rows), bool)
    for t in range(table):
        earlier |= left.keys[rows, t] == right.keys[columns, t]
    return rows[~earlier], columns[~earlier]


def _forest(a: np.ndarray, b: np.ndarray):
    """Links (node, root) that join every node to the smallest one it reaches over the pairs."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    at, to = places[:len(a)], places[len(a):]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        np.minimum.at(root, at, root[to])
        np.minimum.at(root, to, root[at])
        root = root[root]
        if np.array_equal(before, root):
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _compare(width: str, limit: float):
    """Rows (a, b, null) of linked classes and (class, null, vectors linked to it)."""
    def run(batches):
        for batch in batches:
            lefts, rights, tables = batch.column("lefts"), batch.column("rights"), batch.column("table").to_pylist()
            for i, table in enumerate(tables):
                left = _Side(lefts[i].values, width)
                right = _Side(rights[i].values, width) if rights[i].is_valid else left
                rows, columns = _links(left, right, table, limit)
                if not len(rows):
                    continue
                a, b = _forest(left.ids[rows], right.ids[columns])
                met = np.bincount(rows, right.sizes[columns], len(left.ids)), np.bincount(columns, left.sizes[rows], len(right.ids))
                classes, counts = np.concatenate([left.ids, right.ids]), np.concatenate(met).astype(np.int64)
                some = counts > 0
                none = pa.nulls(some.sum(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([a, classes[some]])), pa.concat_arrays([pa.array(b), none]),
                     pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(counts[some])])], names=["a", "b", "n"])
    return run


def _comparisons(classes: DataFrame, tile: int) -> DataFrame:
    """table, lefts, rights: what is compared at once; ``rights`` is null where a tile meets itself."""
    bucket = ["label", "dimension", "table", "key"]
    members = F.struct("class", "n", "data", "keys").alias("member")
    keyed = classes.select(
        "label", F.length("data").alias("dimension"), members, F.posexplode("keys").alias("table", "key"))
    total = keyed.count()
    limit = max(tile, total // MOST_CUT)
    sizes = keyed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = store(sizes, "buckets")
    # At most as many cut buckets as the limit fits into all rows.
    large = F.broadcast(sizes.where(F.col("size") > limit).select(
        *bucket, F.ceil(F.col("size") / limit).cast("int").alias("parts")))
    alone = F.lit(None).cast(ArrayType(keyed.schema["member"].dataType))
    small = keyed.join(large, bucket, "left_anti").groupBy(*bucket).agg(F.collect_list("member").alias("lefts")).where(
        F.size("lefts") > 1).select("table", "lefts", alone.alias("rights"))
    part = F.pmod(F.xxhash64(F.col("member.class"), "table"), F.col("parts")).cast("int")
    tiles = store(keyed.join(large, bucket).withColumn("part", part).groupBy(*bucket, "parts", "part").agg(
        F.collect_list("member").alias("members")), "tiles")
    # Both joins meet on a bucket and tile, so a bucket's pairs are dealt over as many keys as it has tiles.
    pairs = tiles.select(*bucket, "part", F.col("members").alias("lefts"),
                         F.explode(F.sequence("part", F.col("parts") - 1)).alias("other"))
    others = tiles.select(*bucket, F.col("part").alias("other"), F.col("members").alias("rights"))
    pairs = pairs.join(others, [*bucket, "other"]).select(
        "table", "lefts", F.when(F.col("part") != F.col("other"), F.col("rights")).alias("rights"))
    return small.unionByName(pairs)


def near_vectors(vectors: DataFrame, limit: float = LIMIT, missed: float = MISSED, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding, label).

    Two rows are linked if their labels are equal and not null, their vectors have the same number of
    components and the cosine, in double precision, is at least ``limit``. A null, empty or zero
    vector, or one with a null or non-finite component, links with nothing. n_links counts other rows, component_id
    is the smallest vec_id reachable, null if all are null; a row without links is its own component. ``kept``
    is false for a null vec_id. Rows that repeat are rows of their own. Other columns are not read.
    """
    embedding = vectors.schema["embedding"].dataType
    width = "<f8" if isinstance(embedding.elementType, DoubleType) else "<f4"
    label = vectors.schema["label"].dataType.simpleString()
    rows = store(vectors.select("vec_id", "label", "embedding").mapInArrow(
        _pack(width), f"vec_id long, label {label}, data binary, digest binary"), "vectors")
    usable = rows.where("label is not null and data is not null")
    # The number of a class is part of what is written, so a second evaluation cannot change it.
    classes = store(usable.groupBy("label", "digest", "data").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n")).withColumn("class", F.monotonically_increasing_id()), "classes")
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    planes, tables = plan_tables(most, limit, missed)
    hashed = store(classes.select("class", "n", "label", "data").mapInArrow(_keys(width, planes, tables), (
        f"class long, n long, label {label}, data binary, keys array<int>")), "keys")
    met = store(_comparisons(hashed, tile).mapInArrow(_compare(width, limit), "a long, b long, n long"), "met")
    labels = components(met.where("b is not null").select("a", "b"))
    counts = met.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("met"))
    known = classes.select("label", "digest", "least", "n", "class").join(counts, "class", "left").join(
        labels.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = store(known.join(smallest, "component").select(
        "label", "digest", "component_id", (F.coalesce("met", F.lit(0)) + F.col("n") - 1).alias("n_links")), "known")
    linked = spread_join(rows.select("vec_id", "label", "digest"), known, ["label", "digest"])
    alone = F.col("n_links").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return linked.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
