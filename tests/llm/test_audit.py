"""Filter audit against a plain walk through every order."""

import itertools
import re
from collections import Counter

import numpy as np
import pytest

from railtide.llm import filter_audit as fa
from railtide.llm.common import read_table

SMALL = "/root/testdata/sf0.001"


def plain_audit(docs, labels):
    texts = [(r.doc_id, r.text or "", r.lang or "") for r in docs.collect()]
    marks = {"good": set(), "toxic": set()}
    for r in labels.collect():
        if r.quality == 1:
            marks["good"].add(r.doc_id)
        if r.toxic == 1:
            marks["toxic"].add(r.doc_id)
    least = {}
    for i, t, _ in texts:
        if i is not None:
            least[t] = min(i, least.get(t, i))
    rows = []
    for i, t, part in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": i is not None and i > least[t]}
        rows.append((part, {k for k, v in fails.items() if v}, i is not None and i in marks["good"],
                     i is not None and i in marks["toxic"]))
    found, shapley = [], Counter()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[1]]
                failing = [r for r in own if name in r[1]]
                left = [r for r in left if name not in r[1]]
                shapley[part, name] += len(gone)
                found.append([part, "".join(order), step, len(left), len(gone), len(failing) - len(gone),
                              sum(r[1] == {name} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)])
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in found)


def with_clashes(docs, spark):
    from pyspark.sql import functions as F
    return docs.withColumns({c: F.lit("x") for c in ("part", "words", "fails", "digest", "n", "least", "good", "toxic", "rows")})


@pytest.mark.parametrize("name", ["small", "edge", "named", "none"])
def test_audit(spark, name, request):
    if name == "small":
        docs, labels = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "labels")
    else:
        docs = request.getfixturevalue({"named": "edge"}.get(name, name))
        docs = with_clashes(docs, spark) if name == "named" else docs
        labels = spark.createDataFrame(
            [(1, 1, 0), (2, 0, 1), (2, 1, None), (7, None, 1), (8, 1, 1), (None, 1, 1), (99, 1, 1), (8, 1, 0)],
            "doc_id long, quality int, toxic int")
    got = fa.audit(fa.failures(docs, labels))
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(docs, labels)


def test_edges_of_the_conditions(spark):
    texts = ["w " * 199, " ".join(f"w{i}" for i in range(200)), "a a b b", "a a a b b", "A" + "b" * 32, "A" + "b" * 33, "x | y", "É" * 5 + "A" * 1,
             "%", "%", "same", "same", None, ""]
    docs = spark.createDataFrame([(i, t, None if i % 3 else "de") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted(tuple(r) for r in fa.audit(fa.failures(docs, labels)).collect()) == plain_audit(docs, labels)


def test_potential_gives_the_mean_over_orders():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 1000, 32)
    values = fa.removed_by_coalition(counts, 5)
    potential = fa.potentials(values, 5)
    for i in range(5):
        total = 0
        for order in itertools.permutations(range(5)):
            before = sum(1 << j for j in order[:order.index(i)])
            total += values[before | 1 << i] - values[before]
        assert potential[31] - potential[31 & ~(1 << i)] == total
    # Shapley values share out what all filters remove.
    assert sum(potential[31] - potential[31 & ~(1 << i)] for i in range(5)) == 120 * values[31]


def test_a_text_in_a_third_of_all_rows(spark):
    docs = spark.createDataFrame([(i, "common text" if i % 3 == 0 else f"text {i}", "en") for i in range(3000)],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(0, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    cells = fa.failures(docs, labels).where("fails >= 16").collect()
    assert sum(r.n for r in cells) == 999 and sum(r.good for r in cells) == 1
