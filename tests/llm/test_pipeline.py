"""The pipeline stage by stage, each against a plain version over its own input."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from railtide.llm import simhash, toxicity
from railtide.llm.common import read_table
from railtide.llm.decontaminate import words_of

SMALL = "/root/testdata/sf0.001"


def key(r):
    return tuple(str(x) for x in r)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def test_stages_over_documents(spark, tmp_path):
    docs = read_table(spark, SMALL, "documents")
    columns, seen = docs.columns, {}
    for name, stage in cp.STAGES:
        path = f"{tmp_path}/{name.replace(' ', '_')}"
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs
    names = [n for n, _ in cp.STAGES]
    assert all(seen[n].columns == columns for n in names[:-1])

    before = rows(read_table(spark, SMALL, "documents"))
    clean = rows(seen[names[0]])
    toxic = {r.doc_id for r in read_table(spark, SMALL, "labels").where("toxic = 1").collect()}
    dropped = {r[0] for r in before} - {r[0] for r in clean}
    assert set(clean) <= set(before) and len(dropped & toxic) >= 0.8 * len(toxic)

    prints = {r[0]: int(simhash.fingerprint(simhash.shingle_hashes(r[1].encode()))) for r in clean}
    group = {i: i for i in prints}
    for a in sorted(prints):
        for b in sorted(prints):
            if a < b and ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count() <= 4:
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    assert {r[0] for r in rows(seen[names[1]])} == {i for i in group if group[i] == i}

    items = [" " + " ".join(words_of(r.text)) + " " for r in read_table(spark, SMALL, "benchmark").collect()]
    left = {r[0] for r in rows(seen[names[1]]) if not any(i in " " + " ".join(words_of(r[1])) + " " for i in items)}
    assert {r[0] for r in rows(seen[names[2]])} == left

    mixed = Counter(r[0] for r in rows(seen[names[3]]))
    assert set(mixed) == left and max(mixed.values()) <= 2

    plain, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for r in sorted(rows(seen[names[3]]), key=lambda r: (r[0], r[1])):
        ids = plain.encode(r[1], add_special_tokens=False).ids + [2]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in seen[names[4]].collect()), key=lambda r: r[1]) == want


@pytest.mark.parametrize("name", ["edge", "clashing", "none"])
def test_stages_take_odd_rows(name, spark, request):
    docs = request.getfixturevalue(name)
    texts = Counter((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    for stage_name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        got = Counter((r.doc_id, r.text or "") for r in out.collect())
        assert set(got) <= set(texts)
        if stage is cp.remove_near_copies:
            assert all(n == 1 for n in got.values())
        elif stage is cp.mix_sources:
            assert set(got) == set(texts)
        else:
            assert got == texts
    assert cp.write_tokens(spark, docs, SMALL).count() == sum(texts.values())


def test_run_registered_and_sensible(spark):
    from __spark_entry__ import oracle_sql, queries
    assert queries()["pipeline"] is cp.run and "pipeline" not in oracle_sql()
    assert [n for n in queries() if n.startswith("op")] == sorted(
        (n for n in queries() if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert toxicity.THRESHOLD == 0.5
