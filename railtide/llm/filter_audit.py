"""Audit of filters that work together: what each removes in every order, and its Shapley value.

The filters are the players of a game whose value is the number of documents that a coalition
removes. Its Hart-Mas-Colell potential follows by recursion over the coalitions,
``P(S) = (v(S) + sum of P(S without i)) / |S|``, and a filter's Shapley value is the potential of all
filters minus that of all but it. What a filter removes as a step of an order is the difference of
two coalitions. So documents are only counted once, by the set of filters that they fail.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide.llm.common import spread_join
from railtide.session import store

FEWEST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 3
SIGNS = "[#$%&*|]"
FILTERS = "ABCDE"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MEASURES = ("n", "good", "toxic")


def text_failures() -> dict[str, Column]:
    """Failure conditions that a text alone decides, over columns ``text`` and ``words``."""
    words = F.size("words")
    capitals = F.length("text") - F.length(F.translate("text", _CAPITALS, ""))
    return {
        "A": words < FEWEST_WORDS,
        "B": 100 * F.size(F.array_distinct("words")) < LEAST_DISTINCT_PERCENT * words,
        "C": 100 * capitals.cast("long") > MOST_CAPITALS_PERCENT * F.length("text").cast("long"),
        "D": F.col("text").rlike(SIGNS),
    }


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails (bit i: filter i), n, good, toxic: documents by the filters they fail.

    A null text is empty, a null lang the part of the empty string. A row fails the last filter if a
    row of smaller doc_id has the same text; a null doc_id neither fails it nor makes others fail. Rows that repeat count
    as often as they are there. A document is good (toxic) if any row of ``labels`` with its id has quality (toxic) 1.
    """
    text = F.coalesce("text", F.lit(""))
    cut = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text")).withColumn(
        "words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    bits = sum((F.when(failed, 1 << FILTERS.index(name)).otherwise(0) for name, failed in text_failures().items()), F.lit(0))
    # Equal digests of 256 bits stand for equal texts. Rows that repeat become one with a count.
    facts = store(cut.select("doc_id", "part", bits.alias("fails"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
                  .groupBy("digest", "doc_id", "part", "fails").agg(F.count(F.lit(1)).alias("n")), "facts")
    first = facts.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    marked = labels.where("quality = 1 or toxic = 1").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    known = spread_join(spread_join(facts, marked, ["doc_id"]), first, ["digest"])
    repeated = F.when(F.col("doc_id") > F.col("least"), 1 << FILTERS.index("E")).otherwise(0)
    if_true = lambda name: F.sum(F.when(F.col(name), F.col("n")).otherwise(0)).alias(name)
    return known.withColumn("fails", F.col("fails") + repeated).groupBy("part", "fails").agg(
        F.sum("n").alias("n"), if_true("good"), if_true("toxic"))


def removed_by_coalition(counts: np.ndarray, filters: int) -> np.ndarray:
    """Documents that each coalition removes, of counts by failed filters (last axis)."""
    sets = np.arange(1 << filters)
    return counts @ ((sets[:, None] & sets[None, :]) != 0)


def potentials(values: np.ndarray, filters: int) -> np.ndarray:
    """``filters``! times the Hart-Mas-Colell potential of every coalition, in whole numbers."""
    scale, found = factorial(filters), np.zeros_like(values)
    for members in range(1, 1 << filters):
        smaller = [members & ~(1 << i) for i in range(filters) if members >> i & 1]
        found[..., members] = (scale * values[..., members] + found[..., smaller].sum(axis=-1)) // len(smaller)
    return found


def _orders(names: str):
    """Every order and step: (order, step, filter, coalition before it)."""
    for order in permutations(range(len(names))):
        before = 0
        for step, i in enumerate(order):
            yield "".join(names[j] for j in order), step + 1, i, before
            before |= 1 << i


AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def _audit(names: str):
    orders, steps, players, before = (np.array(x) for x in zip(*_orders(names)))
    count, everyone = len(names), (1 << len(names)) - 1

    def run(batches):
        for batch in batches:
            for at, part in enumerate(batch.column("part").to_pylist()):
                cells = np.zeros((len(MEASURES), 1 << count), np.int64)
                for cell in batch.column("cells")[at].as_py():
                    cells[:, cell["fails"]] = [cell[m] for m in MEASURES]
                values = removed_by_coalition(cells, count)
                after = before | 1 << players
                removed, good, toxic = values[:, after] - values[:, before]
                potential = potentials(values[0], count)
                shapley = potential[everyone] - potential[everyone & ~(1 << np.arange(count))]
                failing = values[0, 1 << np.arange(count)]
                found = {"kept": cells[0].sum() - values[0, after], "removed": removed,
                         "redundant": failing[players] - removed, "unique_fails": cells[0, 1 << players],
                         "good_lost": good, "toxic_lost": toxic, "shapley": shapley[players]}
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([part] * len(steps), pa.string()), "filter_order": pa.array(orders.tolist()),
                     "step": pa.array(steps.astype(np.int32))} | {k: pa.array(v) for k, v in found.items()})
    return run


def audit(failed: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from a table of ``failures``.

    ``kept`` and ``removed`` are documents of the part after and in this step, ``redundant`` those
    that fail its filter but were gone, ``unique_fails`` those that fail no other, ``good_lost`` and
    ``toxic_lost`` the removed ones with these labels. ``shapley`` is the filter's Shapley value times
    the number of orders, which is what it removes in all of them. A part has at most ``2 ** len(names)`` rows, so one row
    of cells. No documents, no rows.
    """
    cells = failed.groupBy("part").agg(F.collect_list(F.struct("fails", *MEASURES)).alias("cells"))
    return cells.mapInArrow(_audit(names), AUDIT)
