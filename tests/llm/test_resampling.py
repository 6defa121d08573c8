"""Importance resampling against plain counts."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from railtide.llm import resampling as rs
from railtide.llm.common import read_table

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_buckets(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return [zlib.crc32(r.encode()) % 10_000 for r in runs], len(words)


def plain_resample(docs, target, percent=25):
    rows = [(r.doc_id, *plain_buckets(r.text)) for r in docs]
    s, t = Counter(), Counter()
    for _, buckets, _ in rows:
        s.update(buckets)
    for r in target:
        t.update(plain_buckets(r.text)[0])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in s}
    found = []
    for doc_id, buckets, words in rows:
        weight = sum(gain[b] for b in buckets) // len(buckets) if buckets else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([doc_id, len(buckets), weight, score, None, words])
    able = sorted((r for r in found if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in found), key=str)


@pytest.mark.parametrize("name", ["small", "edge", "clashing", "none"])
def test_resample(spark, name, request):
    docs = read_table(spark, SMALL, "documents") if name == "small" else request.getfixturevalue(name)
    target = read_table(spark, SMALL, "benchmark")
    got = [tuple(r) for r in rs.resample(docs, target).collect()]
    assert sorted(got, key=str) == plain_resample(docs.collect(), target.collect())


def test_ties_repeats_and_an_empty_target(spark):
    long = " ".join(f"word{i}" for i in range(30))
    rows = [(i, long) for i in (5, 3, 9, 9, 1)] + [(None, long), (7, "too short"), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    empty = spark.createDataFrame([(None,), ("",)], "text string")
    got = [tuple(r) for r in rs.resample(docs, empty, percent=70).collect()]
    assert sorted(got, key=str) == plain_resample(docs.collect(), empty.collect(), percent=70)


@given(st.lists(st.text(alphabet=st.sampled_from("abZ09 \x00\n.-Éé漢\x7f~"), max_size=40), max_size=12))
@settings(max_examples=200, deadline=None)
def test_features_of_a_batch(texts):
    buckets, owner, n_words = rs.feature_buckets([t.encode() for t in texts], rs.Words()) if texts else ([], [], [])
    for i, text in enumerate(texts):
        want, words = plain_buckets(text)
        assert sorted(buckets[owner == i].tolist()) == sorted(want) and n_words[i] == words


def test_checksums_of_very_long_words():
    texts = [b"a" * 62 + b" " + b"b" * 63 + b" " + b"c" * 64 + b" " + b"d" * 5000 + b" e", b"e " + b"f" * 70]
    buckets, owner, _ = rs.feature_buckets(texts, rs.Words())
    for i, text in enumerate(texts):
        assert sorted(buckets[owner == i].tolist()) == sorted(plain_buckets(text.decode())[0])


def test_small_parts_change_nothing(spark, monkeypatch):
    docs = read_table(spark, SMALL, "documents").limit(50)
    data = [(r.text or "").encode() for r in docs.collect()]
    whole = np.bincount(rs.feature_buckets(data, rs.Words())[0], minlength=rs.BUCKETS)
    monkeypatch.setattr(rs, "JOINED_BYTES", 1000)
    monkeypatch.setattr(rs, "REMEMBERED", 50)
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"data": pa.array(data, pa.binary())})
    (counted,) = rs._count([batch])
    assert dict(zip(counted["bucket"].to_pylist(), counted["n"].to_pylist())) == {int(b): int(whole[b]) for b in np.flatnonzero(whole)}
