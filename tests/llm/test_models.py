"""Language model, toxicity and language identification."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from railtide.llm import hidden_markov as hm
from railtide.llm import language_id as li
from railtide.llm import queries, toxicity as tox
from railtide.llm.common import id_remainder, read_table

SMALL = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- hidden Markov model

def tiny_model():
    rng = np.random.default_rng(2)
    emit = rng.random((5, 3))
    move = rng.random((3, 3))
    start = rng.random(3)
    return hm.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def paths(model, text):
    """Probability of every state path together with the text."""
    for path in itertools.product(range(3), repeat=len(text)):
        p = model.start[path[0]]
        for a, b in zip(path, path[1:]):
            p *= model.move[a, b]
        for s, w in zip(path, text):
            p *= model.emit[w, s]
        yield path, p


TEXTS = [[0], [1, 4, 2], [3, 3, 0, 1, 2], [2, 2]]


def test_forward_sums_all_paths():
    model = tiny_model()
    sizes = np.array([len(t) for t in TEXTS])
    got = hm.forward_scores(model, np.array(sum(TEXTS, [])), sizes)
    want = [math.log10(sum(p for _, p in paths(model, t))) for t in TEXTS]
    assert np.allclose(got, want, atol=1e-12)


def test_expected_counts_sum_all_paths():
    model = tiny_model()
    sizes = np.array([len(t) for t in TEXTS])
    got = hm.expected_counts(model, np.array(sum(TEXTS, [])), sizes, np.array([True, True, False, True]))
    starts, moves, emits = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for t, first in zip(TEXTS, (True, True, False, True)):
        total = sum(p for _, p in paths(model, t))
        for path, p in paths(model, t):
            if first:
                starts[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / total
            for s, w in zip(path, t):
                emits[w, s] += p / total
    for a, b in zip(got, (starts, moves, emits)):
        assert np.allclose(a, b)


def test_long_texts_do_not_underflow():
    got = hm.forward_scores(tiny_model(), np.tile([0, 1, 2, 3, 4], 10_000), np.array([50_000]))
    assert np.isfinite(got).all() and got[0] < -10_000


def plain_base(docs):
    cut = {k: ((t or "").encode().lower().split() + [b"\n"], h) for k, (t, h) in docs.items()}
    counts = Counter(w for words, held in cut.values() if not held for w in words)
    n, v = sum(counts.values()), len(counts)
    return {k: (len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
            for k, (w, _) in cut.items()}


@pytest.mark.parametrize("name", ["small", "edge", "clashing", "none"])
def test_scores_against_plain_counts(spark, name, request):
    docs = read_table(spark, SMALL, "documents") if name == "small" else request.getfixturevalue(name)
    held = docs.withColumn("held_out", id_remainder(10) == 0)
    texts = held.select("doc_id", "text", "held_out").collect()
    want = plain_base({n: (r.text, r.held_out) for n, r in enumerate(texts)})
    got = hm.score_texts(held, iterations=2).collect()
    facts = lambda i, h, a, b, c, s: (str(i), h, a, b, c, round(s, 6))
    assert sorted(facts(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got) == sorted(
        facts(r.doc_id, r.held_out, *want[n]) for n, r in enumerate(texts))
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in got)


def test_model_is_a_distribution_and_beats_word_shares(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents").withColumn("held_out", id_remainder(10) == 0)
    got = hm.score_texts(docs).where("held_out").collect()
    assert all(r.score > r.base_score for r in got)
    classes = hm.Classes({b"a": 0, b"b": 1}, np.array([0.5, 0.3] + [0.199 / (2 * hm.SUFFIX_CLASSES)] * 2 * hm.SUFFIX_CLASSES + [0.001]), 10, 3)
    first = hm.first_model(classes)
    assert np.allclose(first.emit.sum(axis=0), 1) and np.allclose(first.move.sum(axis=1), 1)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b", True)], "doc_id long, text string, held_out boolean")
    r = hm.score_texts(docs).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, round(r.score, 9)) == (3, 0, 0, 0.0, 0.0)


# ---------------------------------------------------------------- toxicity

def test_noisy_or_gradient():
    rng = np.random.default_rng(1)
    model = tox.Model(rng.normal(size=20) * 0.3, -1.0)
    toxic, per_doc, sizes = np.array([1, 0, 1, 0]), np.array([2, 3, 1, 0]), np.array([3, 1, 2, 2, 4, 2])
    features = rng.integers(0, 20, sizes.sum())
    slope, _ = tox.gradient(model, toxic, features, sizes, per_doc)
    full, step = np.append(model.weights, model.bias), 1e-5
    for i in range(21):
        losses = []
        for sign in (1, -1):
            moved = full.copy()
            moved[i] += sign * step
            losses.append(tox.gradient(tox.Model(moved[:-1], moved[-1]), toxic, features, sizes, per_doc)[1])
        assert abs((losses[0] - losses[1]) / (2 * step) - slope[i]) < 1e-4


def test_document_score_is_noisy_or_of_sentences():
    model = tox.Model(np.zeros(1 << tox.FEATURE_BITS), -3.0)
    model.weights[tox.word_features("rotten")[0]] = 6.0
    text = "All is well. You rotten thing!\nMore text"
    found = tox.sentence_scores(model, text, {})
    assert [text[a:b].strip() for a, b, _ in found] == ["All is well", "You rotten thing", "More text"]
    assert max(found, key=lambda f: f[2])[0] == text.index(" You")


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op2_toxicity"](spark, sf)
    labelled = got.join(read_table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    clean = [r for r in labelled if r.toxic == 0]
    toxic = [r for r in labelled if r.toxic == 1]
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.75 * len(toxic)


@pytest.mark.parametrize("name", ["edge", "clashing", "none"])
def test_toxicity_of_odd_rows(spark, name, request):
    docs = request.getfixturevalue(name)
    labels = docs.select("doc_id", "text", F.lit(0).alias("toxic"))
    model = tox.train(labels, iterations=2)
    got = tox.score_texts(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 and r.offending == [] and r.worst_start is None for r in got if r.doc_id in (3, 4, 5))
    assert tox.keep_clean(docs, model).columns == docs.columns


INSULTS = ["wretch", "buffoon", "dolt", "knave"]


def insulting(rng, n, per_doc, signs=False):
    """(doc_id, text, toxic): every second document has insults, in any form, among invented words."""
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 7))) for _ in range(rng.integers(30, 200))]
        if i % 2:
            for _ in range(per_doc):
                words.insert(int(rng.integers(0, len(words))), str(rng.choice(INSULTS)) + str(rng.choice(["", "s", "ish", "ly"])))
        text = " ".join(w + ("!!" if signs else "." if rng.random() < 0.1 else "") for w in words)
        rows.append((i, text.upper() if signs else text, i % 2))
    return rows


def test_one_insult_is_enough(spark):
    rng = np.random.default_rng(14)
    schema = "doc_id long, text string, toxic int"
    model = tox.train(spark.createDataFrame(insulting(rng, 400, 3), schema))
    for signs in (False, True):
        docs = insulting(rng, 200, 1, signs)
        got = {r.doc_id: r for r in tox.score_texts(spark.createDataFrame(docs, schema), model).collect()}
        caught = [got[i].score >= 0.5 for i, _, toxic in docs if toxic]
        assert sum(caught) >= 0.9 * len(caught)
        assert sum(got[i].score >= 0.5 for i, _, toxic in docs if not toxic) == 0
        if signs:
            hits = [(got[i], text) for i, text, toxic in docs if toxic and got[i].score >= 0.5]
            assert all(any(w in text[r.worst_start:r.worst_stop].lower() for w in INSULTS) for r, text in hits)


def plain_toxicity(rows, seen):
    """Scores of the whole query by plain loops, except for the minimiser's steps."""
    def words_by_sentence(text):
        return [words for _, _, words in tox.sentences(text or "")]
    train = [(words_by_sentence(t), y) for _, t, y in seen]
    holders = {0: Counter(), 1: Counter()}
    for parts, y in train:
        holders[y].update({f for words in parts for w in words for f in tox.word_features(w)})
    n = Counter(y for _, y in train)
    trained = sorted(f for f, k in holders[1].items() if k >= 2 + n[1] // 500 and k * max(1, n[0]) >= 2.0 * (holders[0][f] + 1) * max(1, n[1]))
    place = {f: i for i, f in enumerate(trained)}
    coded = [([[place[f] for w in words for f in tox.word_features(w) if f in place] for words in parts], y) for parts, y in train]

    def evaluate(at):
        loss, slope = 0.05 / 2 * float(at[:-1] @ at[:-1]), np.append(0.05 * at[:-1], 0.0)
        for parts, y in coded:
            if not parts:
                continue
            zs = [at[-1] + sum(at[f] for f in part) for part in parts]
            against = max(sum(np.logaddexp(0, z) for z in zs), 1e-9)
            loss += against if not y else -4.0 * math.log(-math.expm1(-against))
            pull = 1.0 if not y else -4.0 / math.expm1(min(against, 500))
            for z, part in zip(zs, parts):
                p = 1 / (1 + math.exp(-z))
                slope[-1] += pull * p
                for f in part:
                    slope[f] += pull * p
        return loss, slope

    at = tox.minimise(evaluate, np.append(np.zeros(len(trained)), -4.0), tox.ITERATIONS)
    found = {}
    for doc_id, text, _ in rows:
        zs = [at[-1] + sum(at[place[f]] for w in words for f in tox.word_features(w) if f in place) for words in words_by_sentence(text)]
        found[doc_id] = 1 - math.exp(-sum(np.logaddexp(0, z) for z in zs)) if zs else 0.0
    return found


def test_whole_query_against_plain_loops(spark, tmp_path):
    rng = np.random.default_rng(15)
    rows = insulting(rng, 160, 2) + [(1000, None, 0), (1001, "", 1), (1002, "...", 0)]
    spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, y) for i, _, y in rows if i % 3] + [(5000, 1), (7, None)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    known = {i: y for i, y in labels if y is not None}
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    want = plain_toxicity(rows, [(i, t, known[i]) for i, t, _ in rows if i in known and not held(i)])
    got = queries.QUERIES["op2_toxicity"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert abs(r.score - want[r.doc_id]) < 1e-3 and r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.5)


def test_short_sentences_are_joined():
    found = list(tox.sentences("YOU!! ARE!! A!! FOOL!! indeed. A sentence of its own. End."))
    assert [w for _, _, w in found] == [{"you", "are", "a"}, {"fool", "indeed", "a", "sentence", "of", "its", "own"}, {"end"}]
    assert list(tox.sentences("?! .")) == [] and [f[2] for f in tox.sentences("one. . two")] == [{"one", "two"}]


# ---------------------------------------------------------------- language identification

def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op3_language_id"](spark, sf).join(read_table(spark, sf, "documents"), "doc_id").where("held_out")
    right = got.where("lang = lang_pred").count() / got.count()
    assert right >= 0.98
    assert 0.9 <= got.agg(F.avg("score")).first()[0] <= 1


def test_grams_ignore_case_and_signs():
    a, b = li.gram_counts("Straße, 12 ÉTÉ!"), li.gram_counts("straße  été")
    assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])
    assert len(li.gram_counts("12 ,.!")[0]) == 0


def test_rare_grams_get_no_weight(spark):
    docs = [(i, "das ist ein haus" if i % 2 else "this is a house" + (" qqq" if i == 0 else ""), "de" if i % 2 else "en") for i in range(60)]
    model = li.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert model.labels == ["de", "en"]
    assert (model.weights[li.gram_counts("qqq")[0][:1]] == 0).all() or (model.weights == 0).mean() > 0.9
    found = li.predict(spark.createDataFrame([(1, "ein haus", None), (2, "a house", None)], "doc_id long, text string, lang string"), model)
    assert {r.doc_id: r.lang_pred for r in found.collect()} == {1: "de", 2: "en"}


def test_signs_beyond_the_first_plane_are_no_letters(spark):
    docs = [(i, "das ist ein haus" if i % 2 else "this is a house", "de" if i % 2 else "en") for i in range(40)]
    model = li.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    asked = [(1, "\U0001F600\U0001F680", None), (2, "\U0001F600 ein haus", None), (3, "\U00020000\U00020001", None)]
    found = {r.doc_id: r for r in li.predict(spark.createDataFrame(asked, "doc_id long, text string, lang string"), model).collect()}
    assert (found[1].lang_pred, found[1].score) == ("und", 0.0) and found[2].lang_pred == "de" and found[3].lang_pred != "und"


def plain_languages(rows, kept_back, rounds):
    """Weights and temperature by plain loops; ``kept_back`` are the ids that only the temperature sees."""
    idf = np.log((1 + len(rows)) / (1 + sum((np.bincount(li.gram_counts(t)[0], minlength=li._SIZE) > 0).astype(float) for _, t, _ in rows))) + 1
    labels = sorted({lang for *_, lang in rows})
    z, n, w = (np.zeros((li._SIZE + 1, len(labels))) for _ in range(3))
    vectors = {i: li.weighted(t, idf) for i, t, _ in rows}

    def logits(i):
        grams, values = vectors[i]
        return w[-1] + sum((v * w[g] for g, v in zip(grams, values)), np.zeros(len(labels)))

    for _ in range(rounds):
        slope = np.zeros_like(w)
        for i, _, lang in rows:
            if i in kept_back:
                continue
            p = np.exp(logits(i) - logits(i).max())
            p /= p.sum()
            p[labels.index(lang)] -= 1
            for g, v in zip(*vectors[i]):
                slope[g] += v * p
            slope[-1] += p
        for cell in zip(*np.nonzero(slope)):
            sigma = (math.sqrt(n[cell] + slope[cell] ** 2) - math.sqrt(n[cell])) / li.LEARNING_RATE
            z[cell] += slope[cell] - sigma * w[cell]
            n[cell] += slope[cell] ** 2
            l1 = 0.0 if cell[0] == li._SIZE else li.L1
            w[cell] = 0.0 if abs(z[cell]) <= l1 else -(z[cell] - math.copysign(l1, z[cell])) / (
                (li.BETA + math.sqrt(n[cell])) / li.LEARNING_RATE + li.L2)

    def loss(t):
        total = 0.0
        for i, _, lang in rows:
            if i in kept_back:
                x = logits(i) / t
                total -= x[labels.index(lang)] - x.max() - math.log(np.exp(x - x.max()).sum())
        return round(total, 6)
    return labels, w, float(min(li.TEMPERATURES, key=lambda t: (loss(t), abs(math.log(t)))))


def test_training_against_plain_loops(spark):
    rng = np.random.default_rng(16)
    rows = [(i, " ".join("".join(rng.choice(list("abcd" if i % 2 else "cdef"), 4)) for _ in range(6)), "x" if i % 2 else "y") for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept_back = {r.doc_id for r in table.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(li.CALIBRATION)) == 0).collect()}
    labels, weights, temperature = plain_languages(rows, kept_back, 3)
    model = li.train(table, rounds=3)
    assert model.labels == labels and np.allclose(model.weights, weights, atol=1e-4) and np.isclose(model.temperature, temperature)


def test_two_hundred_labels(spark):
    signs = [chr(0x4E00 + n) for n in range(200)]
    docs = [(i, signs[i % 200] * 3 + " " + signs[i % 200], f"l{i % 200:03d}") for i in range(1000)]
    model = li.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"), rounds=4)
    asked = spark.createDataFrame([(i, t, None) for i, t, _ in docs[:200]], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in li.predict(asked, model).collect()}
    assert len(model.labels) == 200 and sum(got[i] == f"l{i:03d}" for i in range(200)) >= 190


@pytest.mark.parametrize("name", ["edge", "clashing", "none"])
def test_languages_of_odd_rows(spark, name, request):
    docs = request.getfixturevalue(name)
    got = li.predict(docs, li.train(docs, rounds=2)).collect()
    assert len(got) == docs.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (3, 4, 5, 11))


def test_remainder_is_that_of_zlib(spark):
    got = spark.createDataFrame([(i,) for i in [0, 7, -5, 10**15]], "doc_id long").select("doc_id", id_remainder(10).alias("r"))
    assert all(r.r == zlib.crc32(str(r.doc_id).encode()) % 10 for r in got.collect())
