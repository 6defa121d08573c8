"""Exact and near duplicates, sharding and token files against brute force."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from railtide.llm import exact_dedup as ed
from railtide.llm import sharding, simhash, token_files
from railtide.llm.common import read_table, spread_join
from railtide.llm.components import components

SMALL = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return read_table(spark, SMALL, "documents")


def pairs(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


# ---------------------------------------------------------------- exact dedup

@given(st.sets(st.integers(0, 2**60 - 1), max_size=200))
@settings(max_examples=50, deadline=None)
def test_golomb_round_trip(values):
    given_values = np.array(sorted(values), np.uint64)
    assert np.array_equal(ed.golomb_decode(ed.golomb_encode(given_values, 2**60)), given_values)


@pytest.mark.parametrize("name", ["docs", "edge", "clashing", "none"])
def test_exact_dedup(name, request):
    table = request.getfixturevalue(name)
    groups = defaultdict(list)
    for doc_id, text in pairs(table):
        groups[text].append(doc_id)
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        for n, i in enumerate(sorted(ids, key=lambda x: (x is not None, x))):
            want.append((i, keep, len(ids), i == keep and n == len(ids) - 1, sha))
    got = [tuple(r) for r in ed.exact_dedup(table).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_exact_dedup_many_blocks_and_owners(spark, docs):
    many = docs.repartition(7, "doc_id")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(ed.exact_dedup(many, hashes_per_owner=1)) == rows(ed.exact_dedup(docs))


def test_spread_join_hot_key(spark):
    left = spark.createDataFrame([(i % 10 // 9, i) for i in range(500)] + [(None, 1)], "k long, i long")
    right = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c")], "k long, v string")
    for how in ("left", "inner"):
        want = sorted(map(str, left.join(right, "k", how).collect()))
        assert sorted(map(str, spread_join(left, right, ["k"], how, rows_per_copy=20).collect())) == want


# ---------------------------------------------------------------- near duplicates

def plain_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=4):
    ids = list(prints)
    parent = {i: i for i in range(len(ids))}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if (ids[i][1] ^ ids[j][1]).bit_count() <= radius:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    members = defaultdict(list)
    for i, (doc_id, _) in enumerate(ids):
        members[find(i)].append(doc_id)
    least = {r: min((m for m in ms if m is not None), default=None) for r, ms in members.items()}
    return [(ids[i][0], f"{ids[i][1]:016x}", least[find(i)]) for i in range(len(ids))]


@pytest.mark.parametrize("name", ["docs", "edge", "clashing", "none"])
def test_near_duplicates(name, request):
    table = request.getfixturevalue(name)
    cache = {}
    prints = [(i, cache.setdefault(t, plain_fingerprint(t) if t not in cache else None) or cache[t]) for i, t in pairs(table)]
    got = [tuple(r) for r in simhash.near_duplicates(table).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain_components(prints)))


@pytest.mark.parametrize("tile,blocks", [(4096, 5), (4096, 6), (8, 5), (8, 7)])
def test_links_lose_no_pair(spark, tile, blocks):
    """Chains and dense groups of close fingerprints, small and cut buckets, every block count."""
    rng = np.random.default_rng(3)
    values = set()
    for _ in range(6):
        value = int(rng.integers(0, 2**64, dtype=np.uint64))
        for _ in range(60):
            values.add(value)
            for bit in rng.integers(0, 64, rng.integers(1, 4)):
                value ^= 1 << int(bit)
    signed = sorted(v - 2**64 if v >> 63 else v for v in values)
    unique = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = simhash.fingerprint_links(unique, tile=tile, blocks=blocks)
    labels = dict(components(links).collect())
    got = defaultdict(set)
    for v in signed:
        got[labels.get(v, v)].add(v)
    want = defaultdict(set)
    for v, _, root in plain_components([(s, s & (2**64 - 1)) for s in signed]):
        want[root].add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5), (1001, 1000)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {i: 0 for i in range(101)} | {i: 1000 for i in range(1000, 1200)}


# ---------------------------------------------------------------- sharding

@pytest.mark.parametrize("name", ["docs", "edge", "clashing", "none"])
def test_sharding(name, request):
    table = request.getfixturevalue(name)
    rows = sharding.shard_rows(table, 16).collect()
    facts = sorted(((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in pairs(table)), key=str)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in rows), key=str) == facts
    assert all(r.grown_shard in (r.shard, 16) and r.law == "key" for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append((r.slot, r.doc_id is not None, r.doc_id or 0))
    for slots in by.values():
        assert [s[0] for s in sorted(slots)] == list(range(len(slots)))
        assert [s[1:] for s in sorted(slots)] == sorted(s[1:] for s in slots)


def test_rendezvous_follows_weights_and_moves_little(spark):
    keys = spark.range(40_000)
    weights = [1.0, 2.0, 5.0]
    found = keys.select(sharding.rendezvous(keys.id, 3, weights).alias("a"),
                        sharding.rendezvous(keys.id, 4, [*weights, 2.0]).alias("b"))
    counts = {r.a: r["count"] for r in found.groupBy("a").count().collect()}
    for shard, weight in enumerate(weights):
        assert abs(counts[shard] / 40_000 - weight / 8) < 0.01
    assert found.where("a <> b and b <> 3").count() == 0
    assert abs(found.where("b = 3").count() / 40_000 - 0.2) < 0.01


# ---------------------------------------------------------------- token files

@given(st.lists(st.one_of(st.integers(0, 60_000), st.integers(0, 2**32 - 1)), min_size=128, max_size=600))
@settings(max_examples=50, deadline=None)
def test_packed_blocks_round_trip(values):
    ids = np.array(values[:len(values) // 128 * 128], np.uint32)
    data, sizes = token_files.pack_blocks(ids)
    starts = np.cumsum(sizes) - sizes
    assert np.array_equal(token_files.unpack_blocks(np.frombuffer(data, np.uint8), starts), ids)


def test_outliers_do_not_widen_a_block():
    ids = np.arange(128, dtype=np.uint32) % 8
    ids[[3, 70]] = 4_000_000_000
    data, _ = token_files.pack_blocks(ids)
    assert len(data) == 6 + 3 * 16 + 2 * 5


@pytest.mark.parametrize("name", ["docs", "edge", "clashing", "none"])
def test_token_files(name, request):
    table = request.getfixturevalue(name)
    plain = Tokenizer.from_file(TOKENIZER)
    want, start = [], 0
    for doc_id, text in sorted(pairs(table), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = plain.encode(text, add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in token_files.token_table(table, TOKENIZER).collect()]
    assert sorted(got, key=lambda r: r[1]) == want


@given(st.text(alphabet=st.sampled_from("ab1'éÉñ漢.,!? \n\t.,s<|endoftext|>  "), max_size=60))
@settings(max_examples=300, deadline=None)
def test_words_encode_like_whole_texts(text):
    global _encoder
    encoder = globals().setdefault("_encoder", token_files.WordEncoder(TOKENIZER))
    assert encoder.encode(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@given(st.lists(st.sampled_from([*"ab1'éñ漢#$(|<>_- \n\t\r\x85\xa0", "word", "<|endoftext|>", "'s", "$$$", "***,"]), max_size=14))
@settings(max_examples=300, deadline=None)
def test_signs_after_words_encode_like_whole_texts(parts):
    global _encoder
    text, encoder = "".join(parts), globals().setdefault("_encoder", token_files.WordEncoder(TOKENIZER))
    assert encoder.encode(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_are_worked_out_once(monkeypatch):
    encoder = token_files.WordEncoder(TOKENIZER)
    asked, worked_out, plain = [], [], encoder.plain
    monkeypatch.setattr(encoder, "plain", lambda texts: asked.extend(texts) or plain(texts))
    for pieces in (encoder.spaced, encoder.bare):
        tokenize = pieces.tokenize
        monkeypatch.setattr(pieces, "tokenize", lambda word, tokenize=tokenize: worked_out.append(word) or tokenize(word))
    for sign in "#$%&*|":
        for end in ("", sign, sign * 3, "," + sign):
            assert encoder.encode(f"one longer{end}\nword{end} more").tolist() == encoder.tokenizer.encode(
                f"one longer{end}\nword{end} more", add_special_tokens=False).ids
    # Signs by themselves, never with the word before them, and a line is no piece of its own.
    assert sorted(asked) == sorted(x for s in "#$%&*|" for x in (s, s * 3, "," + s))
    assert len(worked_out) == 4 and not any("\n" in x for x in encoder.spaced)


def test_bits_are_packed_as_their_places_say():
    rng = np.random.default_rng(3)
    for width in range(1, 33):
        values = rng.integers(0, 2**32, (3, 128), dtype=np.uint64).astype(np.uint32)
        bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
        want = np.packbits(bits.reshape(3, -1), axis=1, bitorder="little")
        assert np.array_equal(token_files._pack_bits(values, width), want)
        assert np.array_equal(token_files._unpack_bits(want, width), values & np.uint32((1 << width) - 1))


def test_file_of_many_documents(tmp_path):
    rng = np.random.default_rng(1)
    docs = [(i if i % 5 else None, rng.integers(0, 50_000, int(n)).astype(np.uint32))
            for i, n in enumerate([0, 1, 127, 128, 129, 400_000, 3, 0, 262_144])]
    file = token_files.TokenFile(f"{tmp_path}/x.rtk")
    for doc_id, ids in docs:
        file.add(doc_id, ids)
    assert file.close() == sum(len(d[1]) for d in docs)
    back = list(token_files.read_token_file(f"{tmp_path}/x.rtk"))
    assert [b[0] for b in back] == [d[0] for d in docs]
    assert all(np.array_equal(b[1], d[1]) for b, d in zip(back, docs))


def test_texts_of_one_id_are_dealt_to_several_files(spark):
    texts = [f"text number {i} " + "word " * 20 for i in range(300)]
    docs = spark.createDataFrame([(None if i % 2 else 7, t) for i, t in enumerate(texts)] + [(3, "x")], "doc_id long, text string").repartition(4)
    files = token_files.write_token_files(docs, token_files.scratch_path(spark, "tokens"), TOKENIZER, bytes_per_file=4000)
    sizes = [r.docs for r in files.collect()]
    assert len(sizes) >= 5 and max(sizes) <= 301 / 3
    got = [tuple(r) for r in token_files.read_token_files(files).collect()]
    plain, want, start = Tokenizer.from_file(TOKENIZER), [], 0
    for doc_id, text in sorted([(r.doc_id, r.text) for r in docs.collect()], key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = plain.encode(text, add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def test_pairs_of_tiles_of_one_bucket_are_dealt_out(spark):
    """A bucket of many tiles: its pairs meet on as many join keys as it has tiles."""
    rng = np.random.default_rng(9)
    low = rng.choice(2**13, 3000, replace=False)
    unique = spark.createDataFrame([(int(v) << 50 >> 0,) for v in low], "fp long")
    links = simhash.fingerprint_links(unique, radius=1, tile=16, blocks=2)
    joins = re.findall(r"Join Inner, (.*)", links._jdf.queryExecution().optimizedPlan().toString())
    assert sum("tile" in j for j in joins) >= 2
    labels = dict(components(links).collect())
    want = {i: r for i, _, r in plain_components([(int(v) << 50, (int(v) << 50) & (2**64 - 1)) for v in low], radius=1)}
    assert all(labels.get(v, v) == want[v] for v in want)
