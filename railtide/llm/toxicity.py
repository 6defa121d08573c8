"""Toxicity by multiple-instance learning: labels of documents train scores of sentences.

A sentence's score is logistic in the features of its distinct words; a document is toxic if any of
its sentences is, so ``1 - P(document) = product of 1 - p(sentence)`` (noisy-or). Training needs
document labels only and afterwards the sentence scores tell which sentences offend.

A word's features are itself, its beginnings and its parts, so that the forms of a word share what is
known of it. Only features are trained that clearly more toxic than clean documents have: without the
others no document can be explained by its rare words, and a single offending word is enough.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtide.session import store

FEATURE_BITS = 20
PREFIXES, PARTS = (4, 5), (4, 5)
# A sentence of fewer words is joined with the next one, one of more is cut.
FEWEST_WORDS, SENTENCE_WORDS = 3, 40
# Expected number of labelled rows that are trained on, and the files they are kept in.
TRAINING_ROWS = 20_000
TRAINING_FILES = 8
# A feature is trained that so many toxic documents have, one more of every so many, and whose share of
# the toxic documents is so many times that of the clean ones.
FEWEST_TOXIC, ONE_MORE_PER, LIFT = 2, 500, 2.0
# Quasi-Newton steps, the steps remembered for their curvature, and the pull of weights to zero.
ITERATIONS, MEMORY, RIDGE = 30, 8, 0.05
# Toxic documents are the fewer; one counts as so many clean ones.
TOXIC_WEIGHT = 4.0
FIRST_BIAS = -4.0
REMEMBERED = 300_000
THRESHOLD = 0.5

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


def word_features(word: str) -> list[int]:
    """Hashed features of a lower-case word: itself, its beginnings and its parts."""
    names = [word, *[f"^{word[:n]}" for n in PREFIXES if len(word) >= n],
             *[f"#{word[at:at + n]}" for n in PARTS for at in range(len(word) - n + 1)]]
    return [zlib.crc32(n.encode()) & ((1 << FEATURE_BITS) - 1) for n in names]


def sentences(text: str):
    """(start, end, distinct words) of every sentence that has words; very short ones are joined, long ones are cut."""
    lower = text.lower()
    # Lower-casing can lengthen a text in rare scripts; places then refer to the lower-cased text.
    begin, before = 0, []
    for found in _SENTENCE.finditer(lower):
        start, end = found.span()
        words = _WORD.findall(lower, start, end)
        if not before:
            begin = start
        if len(before) + len(words) < FEWEST_WORDS:
            before += words
            last = end
            continue
        if len(before) + len(words) <= SENTENCE_WORDS:
            yield begin, end, {*before, *words}
        else:
            places = list(_WORD.finditer(lower, begin, end))
            for at in range(0, len(places), SENTENCE_WORDS):
                part = places[at:at + SENTENCE_WORDS]
                yield part[0].start(), part[-1].end(), {w.group() for w in part}
        before = []
    if before:
        yield begin, last, set(before)


class _Features(dict):
    """Features of the words met so far."""

    def __missing__(self, word):
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = found = np.array(word_features(word), np.int32)
        return found


def _document_counts(batches):
    """Clean and toxic documents that have each feature, and how many there are of both."""
    known, counts, rows = _Features(), np.zeros((2, 1 << FEATURE_BITS), np.int32), [0, 0]
    for batch in batches:
        for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
            words = {w for _, _, own in sentences(text or "") for w in own}
            if words:
                counts[int(toxic > 0), np.unique(np.concatenate([known[w] for w in words]))] += 1
            rows[int(toxic > 0)] += 1
    # Nearly all counts are zero or small.
    yield pa.RecordBatch.from_pydict({"clean": [zlib.compress(counts[0].tobytes(), 1)], "toxic": [zlib.compress(counts[1].tobytes(), 1)],
                                      "n_clean": [rows[0]], "n_toxic": [rows[1]]})


def telling_features(chosen: DataFrame) -> np.ndarray:
    """The features to train, in ascending order. Every training file sends its counts, packed vectors of the model's size."""
    clean, toxic = np.zeros(1 << FEATURE_BITS, np.int64), np.zeros(1 << FEATURE_BITS, np.int64)
    n_clean = n_toxic = 0
    for r in chosen.mapInArrow(_document_counts, "clean binary, toxic binary, n_clean long, n_toxic long").collect():
        clean += np.frombuffer(zlib.decompress(r.clean), np.int32)
        toxic += np.frombuffer(zlib.decompress(r.toxic), np.int32)
        n_clean, n_toxic = n_clean + r.n_clean, n_toxic + r.n_toxic
    often = toxic >= FEWEST_TOXIC + n_toxic // ONE_MORE_PER
    return np.flatnonzero(often & (toxic * max(1, n_clean) >= LIFT * (clean + 1) * max(1, n_toxic)))


def _featured(trained: np.ndarray):
    """Of every labelled text its label, and its sentences' trained features, as places among them, one after the other."""
    def run(batches):
        place = np.full(1 << FEATURE_BITS, -1, np.int32)
        place[trained] = np.arange(len(trained), dtype=np.int32)
        known = _Features()
        for batch in batches:
            labels, all_features, all_sizes = batch.column("toxic"), [], []
            for text in batch.column("text").to_pylist():
                features, sizes = [np.zeros(0, np.int32)], []
                for _, _, words in sentences(text or ""):
                    own = place[np.concatenate([known[w] for w in words])]
                    features.append(own[own >= 0])
                    sizes.append(len(features[-1]))
                all_features.append(np.concatenate(features))
                all_sizes.append(sizes)
            yield pa.RecordBatch.from_arrays(
                [labels, pa.array(all_features, pa.list_(pa.int32())), pa.array(all_sizes, pa.list_(pa.int32()))],
                names=["toxic", "features", "sizes"])
    return run


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def gradient(model: Model, toxic: np.ndarray, features: np.ndarray, sizes: np.ndarray, per_doc: np.ndarray):
    """Gradient of the noisy-or loss by weight, the bias last, and the loss.

    ``features`` of all sentences in a row, ``sizes`` their number per sentence, ``per_doc`` the
    number of sentences per document. A document without sentences adds nothing.
    """
    dims = len(model.weights)
    of_sentence = np.repeat(np.arange(len(sizes)), sizes)
    of_doc = np.repeat(np.arange(len(per_doc)), per_doc)
    z = model.bias + np.bincount(of_sentence, model.weights[features], minlength=len(sizes))
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    against = np.maximum(np.bincount(of_doc, np.logaddexp(0, z), minlength=len(per_doc)), 1e-9)  # -log(1 - P)
    pull = np.where(toxic > 0, -TOXIC_WEIGHT / np.expm1(np.minimum(against, 500)), 1.0)  # dloss / dagainst
    loss = np.where(toxic > 0, -TOXIC_WEIGHT * np.log(-np.expm1(-against)), against)
    by_z = pull[of_doc] * p
    slope = np.bincount(features, by_z[of_sentence], minlength=dims)
    return np.append(slope, by_z.sum()), float(loss[per_doc > 0].sum())


def _gradients(model: Model):
    def run(batches):
        total, loss, rows = np.zeros(len(model.weights) + 1), 0.0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            features, sizes = batch.column("features"), batch.column("sizes")
            part, lost = gradient(model, batch.column("toxic").to_numpy(), features.flatten().to_numpy(),
                                  sizes.flatten().to_numpy(), sizes.value_lengths().to_numpy())
            total, loss, rows = total + part, loss + lost, rows + batch.num_rows
        if rows:
            yield pa.RecordBatch.from_pydict({"sums": [total.astype("<f8").tobytes()], "loss": [loss]})
    return run


def train(labelled: DataFrame, training_rows: int = TRAINING_ROWS, iterations: int = ITERATIONS) -> Model:
    """Fit the sentence model to documents (doc_id, text, toxic 0/1).

    Of more than ``training_rows`` labelled documents about so many are taken, by a hash of their
    ids. Every evaluation sums the gradients of all partitions; the steps are limited-memory BFGS
    with backtracking. Without documents the first model stays and scores are low. A row whose label is
    null is not trained on; a null text is empty and teaches nothing; rows that repeat count as often
    as they are there; rows of a null id are taken or left together. Other columns are not read.
    """
    known = labelled.where(F.col("toxic").isNotNull())
    there = known.count()
    if there > training_rows:
        part = int(training_rows / there * (1 << 31))
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) < part)
    rows = store(known.select("toxic", "text").repartition(TRAINING_FILES), "labelled").coalesce(TRAINING_FILES)
    trained = telling_features(rows)
    chosen = store(rows.mapInArrow(
        _featured(trained), "toxic int, features array<int>, sizes array<int>"), "featured").coalesce(TRAINING_FILES)
    pull = np.append(np.full(len(trained), RIDGE), 0.0)

    def evaluate(at: np.ndarray):
        # One vector per file: a bounded number of them, each of the model's size.
        parts = chosen.mapInArrow(_gradients(Model(at[:-1], float(at[-1]))), "sums binary, loss double").collect()
        slope = sum((np.frombuffer(r.sums, "<f8") for r in parts), np.zeros(len(at)))
        return sum(r.loss for r in parts) + 0.5 * float(pull @ (at * at)), slope + pull * at

    at = minimise(evaluate, np.append(np.zeros(len(trained)), FIRST_BIAS), iterations)
    weights = np.zeros(1 << FEATURE_BITS, np.float32)
    weights[trained] = at[:-1]
    return Model(weights, float(at[-1]))


def minimise(evaluate, at: np.ndarray, iterations: int) -> np.ndarray:
    """Limited-memory BFGS; ``evaluate`` gives loss and gradient."""
    steps: list = []
    loss, slope = evaluate(at)
    for _ in range(iterations):
        if not np.abs(slope).max() > 1e-6:
            break
        way, scales = -slope, []
        for moved, turned in reversed(steps):
            scale = (moved @ way) / (moved @ turned)
            scales.append(scale)
            way = way - scale * turned
        way = way * ((steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1]) if steps else 1 / np.linalg.norm(slope))
        for (moved, turned), scale in zip(steps, reversed(scales)):
            way = way + moved * (scale - (turned @ way) / (moved @ turned))
        length = 1.0
        while True:
            following = at + length * way
            new_loss, new_slope = evaluate(following)
            if new_loss <= loss + 1e-4 * length * (slope @ way):
                break
            if length < 1e-6:
                return at
            length /= 2
        moved, turned = following - at, new_slope - slope
        if moved @ turned > 1e-10:
            steps = [*steps, (moved, turned)][-MEMORY:]
        at, loss, slope = following, new_loss, new_slope
    return at


def sentence_scores(model: Model, text: str, known: dict[str, float]) -> list[tuple[int, int, float]]:
    """(start, end, logit) of every sentence; ``known`` remembers the weights of words."""
    found = []
    for begin, end, words in sentences(text):
        z = model.bias
        for word in words:
            weight = known.get(word)
            if weight is None:
                weight = known[word] = float(model.weights[word_features(word)].sum())
            z += weight
        found.append((begin, end, z))
    return found


SCORED = ("doc_id long, score double, offending array<struct<start:int,stop:int,score:double>>, "
          "worst_start int, worst_stop int, worst_score double")


def _score(model: Model, kept: list[str] | None):
    """Scores; with ``kept`` only the rows below the threshold, with those columns."""
    def run(batches):
        known: dict[str, float] = {}
        for batch in batches:
            scores, spans, worst = [], [], []
            for text in batch.column("text").to_pylist():
                if len(known) > REMEMBERED:
                    known.clear()
                found = sentence_scores(model, text or "", known)
                z = np.array([f[2] for f in found])
                scores.append(float(-np.expm1(-np.logaddexp(0, z).sum())))
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                spans.append([{"start": found[i][0], "stop": found[i][1], "score": float(p[i])}
                              for i in np.flatnonzero(p >= THRESHOLD)])
                top = int(p.argmax()) if len(p) else None
                worst.append((None,) * 3 if top is None else (found[top][0], found[top][1], float(p[top])))
            if kept is not None:
                yield batch.filter(pa.array(np.array(scores) < THRESHOLD, pa.bool_())).select(kept)
                continue
            a, b, c = zip(*worst) if worst else ((), (), ())
            span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, span), pa.array(a, pa.int32()),
                 pa.array(b, pa.int32()), pa.array(c, pa.float64())],
                names=["doc_id", "score", "offending", "worst_start", "worst_stop", "worst_score"])
    return run


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1), offending (places in the text of sentences that are toxic on their
    own), and the sentence most likely to be. A text without words, null or empty, scores 0 and has
    no sentences. One row per row; other columns are not read."""
    return docs.select("doc_id", "text").mapInArrow(_score(model, None), SCORED)


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below the threshold.

    A null or empty text scores 0 and stays; rows that repeat stay or go together; columns may have any
    names besides ``text``. An empty table stays empty.
    """
    return docs.mapInArrow(_score(model, docs.columns), docs.schema)
