"""Queries with SQL, mixing, URL lists and decontamination."""

import math
from collections import Counter, defaultdict
from datetime import date

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks.compare import connect, differences
from railtide.llm import decontaminate as dc
from railtide.llm import mixing, url_lists
from railtide.llm.common import read_table
from railtide.llm.queries import QUERIES
from railtide.llm.sql import ORACLE

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name]) is None


# ---------------------------------------------------------------- mixing

def shares_of(spark, counts):
    total = sum(counts.values())
    return spark.createDataFrame([(s, n, n / total) for s, n in counts.items()], "mix_source string, tokens long, share double")


def test_exponent_meets_entropy_and_repeats(spark):
    counts = {"a": 9000, "b": 900, "c": 90, "d": 10}
    p = np.array(list(counts.values())) / 10_000
    weights = lambda x: p ** x / (p ** x).sum()
    shares = shares_of(spark, counts)
    x = mixing.find_exponent(shares, entropy=1.0)
    assert abs(-(weights(x) * np.log(weights(x))).sum() - 1.0) < 1e-4
    x = mixing.find_exponent(shares, repeats=5.0)
    assert abs((weights(x) / p).max() - 5.0) < 1e-3
    x = mixing.find_exponent(shares, repeats=3.0, budget_share=None)
    passes = weights(x) / p
    assert abs(passes.max() / passes[0] - 3.0) < 1e-3


@pytest.mark.parametrize("name", ["edge", "clashing", "none"])
def test_cover_reads_every_row(name, request):
    docs = request.getfixturevalue(name)
    weights = mixing.source_weights(docs, repeats=2.0, cover=True)
    for block in (1, 4096):
        out = mixing.readings(docs, weights, rows_per_block=block).select("row.*")
        assert out.columns == docs.columns
        got, want = Counter(map(str, out.collect())), Counter(map(str, docs.collect()))
        assert all(want[r] <= n <= 2 * want[r] for r, n in got.items()) and set(got) == set(want)


def test_schedule_realises_the_budget(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    weights = mixing.source_weights(docs, entropy_part=0.9, repeats=3.0, budget=200_000)
    rows = mixing.schedule(docs.drop("n_chars"), weights, rows_per_block=8).collect()
    longest = docs.agg(F.max(mixing.token_count(F.col("text")))).first()[0]
    sums, seen = defaultdict(int), defaultdict(list)
    for r in rows:
        sums[r.mix_source] += r.n_tokens
        seen[r.mix_source, r["pass"]].append((r.start, r.n_tokens, r.doc_id))
    for w in weights.collect():
        assert w.budget <= sums[w.mix_source] < w.budget + longest or w.budget == sums[w.mix_source] == 0
    for reads in seen.values():
        reads.sort()
        assert reads[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(reads, reads[1:]))
        assert len({r[2] for r in reads}) == len(reads)


# ---------------------------------------------------------------- URL lists

def test_intervals_and_as_of(spark):
    d = lambda m: date(2024, m, 1)
    entries = spark.createDataFrame([
        ("block", "bad.example", d(2), "add"), ("block", "bad.example", d(5), "remove"), ("block", "bad.example", d(8), "add"),
        ("allow", "good.bad.example", d(3), "add"), ("block", "good.bad.example/x", d(4), "add"),
        ("block", "tie.example", d(6), "add"), ("block", "tie.example", d(6), "remove"),
        ("block", None, d(1), "add"), ("block", "never.example", None, "add"), ("block", "odd.example", d(1), "note"),
    ], "list string, key string, dated date, action string")
    found = url_lists.intervals(entries)
    assert sorted(map(tuple, found.where("key = 'bad.example'").collect()), key=str) == sorted([
        ("block", "bad.example", d(2), d(5)), ("block", "bad.example", d(8), None)], key=str)
    assert found.where("key in ('tie.example', 'never.example', 'odd.example')").count() == 0
    asks = [
        ("http://bad.example/", d(1), False), ("http://bad.example/", d(2), True), ("http://bad.example/", d(5), False),
        ("https://user@WWW.Bad.Example:80/a?b#c", d(9), True), ("http://a.bad.example", d(3), True),
        ("http://good.bad.example/y", d(4), False), ("http://good.bad.example/x/z", d(4), True),
        ("http://good.bad.example/x/z", d(3), False), ("http://notbad.example/", d(9), False),
        (None, d(3), False), ("http://bad.example/", None, False), ("no url", d(3), False), ("", d(3), False),
        ("http://" + "a." * 500 + "bad.example/" + "p/" * 500, d(3), True),
    ]
    captures = spark.createDataFrame([(u, t, w, "x", "y") for u, t, w in asks * 2],
                                     "url string, fetched date, want boolean, key string, active string")
    got = url_lists.evaluate(captures, entries)
    assert got.columns.count("active") == 1
    rows = got.collect()
    assert len(rows) == 2 * len(asks) and all(r.blocked == r.want and r.key == "x" for r in rows)
    assert url_lists.evaluate(captures.limit(0), entries).count() == 0
    assert not any(r.blocked for r in url_lists.evaluate(captures, entries.limit(0)).collect())


def test_rows_without_or_of_one_id_are_spread_over_blocks(spark):
    docs = spark.createDataFrame([(None if i % 3 else 5, f"text number {i}", "a") for i in range(3000)], "doc_id long, text string, source string")
    weights = mixing.source_weights(docs, repeats=2.0, cover=True)
    read = mixing.schedule(docs, weights, rows_per_block=100)
    sizes = [r["count"] for r in read.groupBy("pass", "block").count().collect()]
    assert len(sizes) >= 25 and max(sizes) <= 200
    assert read.select("text").distinct().count() == 3000
    odd = spark.createDataFrame([(1, None, None), (1, None, None), (None, "", "a"), (None, "x y", "a")], "doc_id long, text string, source string")
    clash = odd.withColumns({c: F.lit("x") for c in ("block", "pass", "start", "_text", "row")})
    for table in (odd, clash):
        read = mixing.schedule(table, mixing.source_weights(table, repeats=1.0, cover=True))
        assert read.count() >= 4 and read.where("pass = 0").count() == 4
    none = odd.limit(0)
    assert mixing.schedule(none, mixing.source_weights(none, repeats=1.0)).count() == 0


# ---------------------------------------------------------------- decontamination

def plain_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_subsequence():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b = (rng.integers(0, 6, rng.integers(0, 90)).tolist() for _ in range(2))
        assert dc.common_subsequence(a, b) == plain_lcs(a, b)


def test_exact_passages_are_found_and_nothing_else(spark):
    sf = "/root/testdata/sf0.01"
    items = {r.item_id: " " + " ".join(dc.words_of(r.text)) + " " for r in read_table(spark, sf, "benchmark").collect()}
    want = {}
    for r in read_table(spark, sf, "documents").collect():
        text = " " + " ".join(dc.words_of(r.text)) + " "
        want[r.doc_id] = sorted(i for i, item in items.items() if item in text)
    got = {r.doc_id: sorted(r.item_ids) for r in QUERIES["op10_decontamination"](spark, sf).collect()}
    assert got == want


def test_paraphrases_need_their_answer(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"w{n}" for n in range(4000)]
    draw = lambda n: [vocabulary[i] for i in rng.integers(0, 4000, n)]
    items = [draw(int(n)) for n in rng.integers(15, 60, 30)]
    changed = lambda words, at: [w if i not in at else "other" for i, w in enumerate(words)]
    docs, want = [(0, " ".join(draw(3000)))], {0: []}
    for n, words in enumerate(items):
        size = len(words)
        kept_answer = changed(words, set(range(0, size * 3 // 4, 3)))  # a quarter changed, the end is there
        no_answer = changed(words, set(range(size - size // 3 - 1, size)))  # the last third changed
        for kind, body in enumerate((words, kept_answer, no_answer)):
            i = 1 + n * 3 + kind
            docs.append((i, " ".join(draw(100) + body + draw(77))))
            want[i] = [n] if kind < 2 else []
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in enumerate(items)] + [(99, None), (98, "two words")],
                                      "item_id long, text string")
    got = {r.doc_id: [x.item_id for x in r.leaks] for r in dc.find_leaks(documents, benchmark).collect()}
    assert got == want
    many = {r.doc_id: [x.item_id for x in r.leaks] for r in _in_turns(documents, benchmark)}
    assert many == want


def test_items_of_common_words_only_are_found(spark):
    item = "then they came to see".split()
    rare = lambda n, size: [f"r{n}x{i}" for i in range(size)]
    docs = [(n, " ".join(rare(n, 18) + item[::-1] + rare(-n, 18))) for n in range(1, 301)]
    docs.append((0, " ".join(rare(0, 90) + item + rare(500, 90))))
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: [x.item_id for x in r.leaks] for r in dc.find_leaks(documents, benchmark).collect()}
    assert got == {0: [7]} | {n: [] for n in range(1, 301)}


def _convicted(item, text):
    """By hand: whether any passage's region convicts the item."""
    margin = len(item) // 2 + dc.STRIDE
    answer = dc.answer_words(item)
    for at in range(0, max(1, len(text) - (dc.PASSAGE - dc.STRIDE)), dc.STRIDE):
        region = text[max(0, at - margin):at + dc.PASSAGE + margin]
        share = dc.common_subsequence(item, region) / len(item)
        if share >= 0.8 or share >= 0.6 and dc.common_subsequence(answer, region) >= 0.6 * len(answer):
            return True
    return False


def test_no_convictable_edit_is_lost(spark):
    """Edits of the rarest words, in documents with common words and a hot group of copies."""
    rng = np.random.default_rng(9)
    common = [f"c{n}" for n in range(60)]
    word = lambda: str(rng.choice(common)) if rng.random() < 0.7 else f"r{rng.integers(0, 3000)}"
    draw = lambda n: [word() for _ in range(n)]
    items = [draw(int(n)) for n in rng.integers(16, 60, 25)]
    texts = [draw(int(n)) for n in rng.integers(30, 300, 400)]
    texts += [draw(40) + items[0] + draw(40)] * 60
    for words in items:
        rarest = sorted(range(len(words)), key=lambda i: words[i][0] == "c")
        for part in (0.2, 0.35, 0.4):
            gone = set(rarest[:int(part * len(words))])
            body = [f"x{rng.integers(0, 10**6)}" if i in gone else w for i, w in enumerate(words)]
            texts += [draw(70) + body + draw(55), [f"x{rng.integers(0, 10**6)}" for _ in range(45)] + body]
    documents = spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate(texts)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in enumerate(items)], "item_id long, text string")
    got = {r.doc_id: {x.item_id for x in r.leaks} for r in dc.find_leaks(documents, benchmark).collect()}
    held = [set(t) for t in texts]
    want = {n: {i for i, item in enumerate(items)
                if sum(w in held[n] for w in item) >= 0.6 * len(item) and _convicted(item, t)} for n, t in enumerate(texts)}
    assert got == want and sum(map(len, want.values())) > 100


def test_latent_space_is_smaller_than_the_items(spark):
    docs = read_table(spark, SMALL, "documents")
    items = [(r.item_id, r.text) for r in read_table(spark, SMALL, "benchmark").collect()]
    model = dc.fit(docs, items)
    assert 0 < model.latent.shape[1] == model.placed.shape[1] <= len(model.items) / 2
    # The rule by hand is met although the space is truncated.
    gone = lambda words: ["gone" if i % 4 == 1 else w for i, w in enumerate(words)]
    texts = [["before"] * 60 + gone(words) + ["after"] * 60 for words in model.items]
    found = [{x[0] for x in row} for row in dc.leaks(model, texts)]
    want = [{i for i, item in zip(model.item_ids, model.items) if _convicted(item, t)} for t in texts]
    assert found == want and sum(map(len, want)) >= len(texts) / 2


def plain_leaks(model, text):
    """By hand, with the model's space: (item, share, answered) of every item that some passage convicts."""
    known = [w for w in text]
    best = {}
    for at in range(0, max(1, len(text) - (dc.PASSAGE - dc.STRIDE)), dc.STRIDE):
        passage = known[at:at + dc.PASSAGE]
        counts = Counter(model.vocabulary[w] for w in passage if w in model.vocabulary)
        values = {t: (1 + math.log(n)) * model.idf[t] for t, n in counts.items()}
        outside = sum(w not in model.vocabulary for w in passage) * model.outside
        norm = math.sqrt(sum(x * x for x in values.values()) + outside)
        turned = sum((x / norm * model.latent[t].astype(float) for t, x in values.items()), np.zeros(model.latent.shape[1]))
        for n, item in enumerate(model.items):
            margin = len(item) // 2 + dc.STRIDE
            region = text[max(0, at - margin):at + dc.PASSAGE + margin]
            share = dc.common_subsequence(item, region) / len(item)
            answer = dc.answer_words(item)
            answered = dc.common_subsequence(answer, region) >= 0.6 * len(answer)
            cosine = float(turned @ model.placed[n])
            close = cosine >= model.limits[n] and cosine / np.linalg.norm(turned) >= 0.8
            if share >= 0.8 or answered and (share >= 0.6 or close and share >= 0.4):
                best[n] = max(best.get(n, (0, False)), (share, answered))
    return {(model.item_ids[n], *found) for n, found in best.items()}


def moved_about(rng, item):
    """A paraphrase: all words but the answer in another order."""
    answer = dc.answer_words(item)
    head = item[:len(item) - len(answer)]
    return [head[i] for i in rng.permutation(len(head))] + answer


def test_paraphrases_that_move_words_need_the_latent_space(spark):
    rng = np.random.default_rng(12)
    word = lambda: f"w{rng.integers(0, 3000)}"
    items = [[word() for _ in range(n)] for n in rng.integers(24, 50, 30)]
    texts = [[word() for _ in range(n)] for n in rng.integers(20, 400, 60)]
    texts += [[word() for _ in range(4)] + moved_about(rng, item) + [word() for _ in range(3)] for item in items]
    docs = spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate(texts)], "doc_id long, text string")
    model = dc.fit(docs, [(n, " ".join(i)) for n, i in enumerate(items)])
    with_space = dc.leaks(model, texts)
    assert [{x[:3] for x in row} for row in with_space] == [plain_leaks(model, t) for t in texts]
    model.placed = np.zeros_like(model.placed)
    without = dc.leaks(model, texts)
    moved = range(60, len(texts))
    assert sum(bool(with_space[n]) for n in moved) >= 20 > 5 >= sum(bool(without[n]) for n in moved)
    assert not any(with_space[n] for n in range(60))


def test_thousands_of_items_take_one_pass(spark, monkeypatch):
    rng = np.random.default_rng(13)
    items = [[f"w{x}" for x in rng.integers(0, 20_000, 20)] for _ in range(5000)]
    texts = [[f"w{x}" for x in rng.integers(0, 20_000, 60)] + (items[n * 50] if n % 2 else []) + ["end"] * 40 for n in range(100)]
    sizes, fit = [], dc.fit
    monkeypatch.setattr(dc, "fit", lambda docs, items, **x: sizes.append(len(items)) or fit(docs, items, **x))
    docs = spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate(texts)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(n, " ".join(i)) for n, i in enumerate(items)], "item_id long, text string")
    got = {r.doc_id: [x.item_id for x in r.leaks] for r in dc.find_leaks(docs, benchmark).collect()}
    assert sizes == [5000] and got == {n: [n * 50] if n % 2 else [] for n in range(100)}


def test_texts_are_cut_by_words(spark, monkeypatch):
    docs = [r.text for r in read_table(spark, SMALL, "documents").collect()] + [None, "", "word " * 500]
    items = [(r.item_id, r.text) for r in read_table(spark, SMALL, "benchmark").collect()]
    model = dc.fit(spark.createDataFrame([(t,) for t in docs], "text string"), items)
    texts = [dc.words_of(t) for t in docs]
    whole = dc.leaks(model, texts)
    monkeypatch.setattr(dc, "WORDS_AT_ONCE", 120)
    parts = list(dc._cut_texts(pa.array(docs)))
    assert sum(parts, []) == texts and all(len(p) == 1 or sum(map(len, p)) <= 120 for p in parts)
    assert sum((dc.leaks(model, p) for p in parts), []) == whole


def test_passages_by_plain_loops():
    rng = np.random.default_rng(14)
    vocabulary = {f"w{n}": n for n in range(9)}
    texts = [[f"w{x}" for x in rng.integers(0, 14, n)] for n in (0, 1, 24, 25, 48, 49, 72, 73, 300, 0)]
    wanted = np.arange(9) % 2 == 1
    for only in (None, wanted):
        numbers, terms, counts, passage, outside = dc.code_passages(*dc.code_texts(texts, vocabulary), 9, only)
        want, lacking = [], []
        for text in texts:
            for at in range(0, max(1, len(text) - (dc.PASSAGE - dc.STRIDE)), dc.STRIDE):
                found = Counter(vocabulary.get(w, -1) for w in text[at:at + dc.PASSAGE])
                lacking.append(found.pop(-1, 0))
                want += [(len(lacking) - 1, t, n) for t, n in sorted(found.items()) if only is None or only[t]]
        assert list(zip(passage.tolist(), terms.tolist(), counts.tolist())) == want
        assert outside.tolist() == lacking and numbers.sum() == len(lacking)


def test_latin_texts_are_split_without_a_pattern(monkeypatch):
    odd = ["".join(map(chr, range(256))), " ".join(map(chr, range(256))), "a".join(map(chr, range(256))), None, "", "ÀÉ_1ß²µ\x85x\xa0y-Z"]
    want = [dc._WORD.findall((t or "").lower()) for t in odd]
    monkeypatch.setattr(dc, "_WORD", None)
    assert [dc.words_of(t) for t in odd] == want


def test_regions_without_the_words_cost_no_subsequence(spark, monkeypatch):
    items = [[f"a{n}x{i}" for i in range(20)] for n in range(3)]
    near = [f"a0x{i}" for i in range(11)] + ["else"] * 30
    model = dc.fit(spark.createDataFrame([(" ".join(near),), (" ".join(items[1]),)], "text string"), [(n, " ".join(i)) for n, i in enumerate(items)])
    model.placed = np.zeros_like(model.placed)
    asked, plain = [], dc.common_subsequence
    # All passages of every text are looked at for every item.
    monkeypatch.setattr(dc, "_by_words", lambda model, numbers, *x: (
        (text, range(n), item) for text, n in enumerate(numbers.tolist()) for item in range(3)))
    monkeypatch.setattr(dc, "common_subsequence", lambda *x: asked.append(x) or plain(*x))
    assert dc.leaks(model, [near] * 20) == [[]] * 20 and not asked
    assert [x[:3] for x in dc.leaks(model, [near, items[1]])[1]] == [(1, 1.0, True)] and asked


def test_repeated_rows_are_searched_once(spark, monkeypatch):
    texts = [" ".join(f"w{n}x{i}" for i in range(12)) for n in range(8)]
    rows = [(0, texts[0])] * 50 + [(n, t) for n, t in enumerate(texts)] + [(n, t) for n, t in enumerate(texts[:2])]
    sizes, fit = [], dc.fit
    monkeypatch.setattr(dc, "fit", lambda docs, items, **x: sizes.append(len(items)) or fit(docs, items, **x))
    monkeypatch.setattr(dc, "ITEMS_AT_ONCE", 3)
    short = " ".join(texts[1].split()[:10])
    docs = spark.createDataFrame([(0, texts[0]), (1, short + " and " + texts[5] + " and " + texts[0]), (2, "none")], "doc_id long, text string")
    got = dc.find_leaks(docs, spark.createDataFrame(rows, "item_id long, text string")).collect()
    assert sizes == [3, 3, 2]
    assert {r.doc_id: [x.item_id for x in r.leaks] for r in got} == {0: [0] * 52, 1: [0] * 52 + [5] + [1] * 2, 2: []}


def test_short_items_and_scripts_without_spaces(spark):
    han = "床前明月光疑是地上霜举头望明月低头思故乡"
    changed = han.replace("疑", "似").replace("举", "抬")
    other = "白日依山尽黄河入海流欲穷千里目更上一层楼"
    thai = "กขคงจฉชซญดตถทธนบปผฝพ"
    items = [(1, "Open sesame, now"), (2, han), (3, thai), (4, "..."), (5, "一二")]
    docs = [(1, "He said open sesame now and went", {1}), (2, "open the sesame now", set()), (3, other + changed + other, {2}),
            (4, other * 3, set()), (5, "x " * 70 + thai + " y", {3}), (6, "a... b", set()), (7, other + "一二" + other, {5}),
            (8, "二一", set()), (9, "now open sesame", set())]
    got = dc.find_leaks(spark.createDataFrame([x[:2] for x in docs], "doc_id long, text string"),
                        spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: {x.item_id for x in r.leaks} for r in got} == {i: want for i, _, want in docs}
    assert dc.words_of("Ab月 c_1ñ。光") == ["ab", "月", "c_1ñ", "光"]


def _in_turns(documents, benchmark):
    before, dc.ITEMS_AT_ONCE = dc.ITEMS_AT_ONCE, 10
    try:
        return dc.find_leaks(documents, benchmark).collect()
    finally:
        dc.ITEMS_AT_ONCE = before


@pytest.mark.parametrize("name", ["edge", "clashing", "none"])
def test_decontamination_of_odd_rows(spark, name, request):
    docs = request.getfixturevalue(name).withColumn("leaks", F.lit("x"))
    benchmark = spark.createDataFrame([(1, "one two three four five six seven"), (2, None)], "item_id long, text string")
    found = Counter((r.doc_id, len(r.leaks)) for r in dc.find_leaks(docs, benchmark).collect())
    assert all((n > 0) == (i in (1, 2, 12)) for i, n in found) and sum(found.values()) == docs.count()
    kept = dc.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns and not {r.doc_id for r in kept.collect()} & {1, 2, 12}
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.keep_clean(docs, none).count() == docs.count()


