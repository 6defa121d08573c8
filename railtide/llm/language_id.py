"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained with follow-the-regularised-leader (proximal, per coordinate) under an elastic-net penalty,
then calibrated by one temperature on rows kept back from the training.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtide.session import store

FEATURE_BITS = 16
LONGEST_GRAM = 3
# Expected number of labelled rows that are trained and calibrated on, and the files they are kept in.
TRAINING_ROWS = 10_000
TRAINING_FILES = 8
ROUNDS = 25
# Every so many-th of them calibrates.
CALIBRATION = 5
LEARNING_RATE, BETA = 0.5, 1.0
L1, L2 = 0.5, 0.01
TEMPERATURES = np.exp(np.linspace(np.log(0.02), np.log(20.0), 61))
UNDETERMINED = "und"

_SIZE = 1 << FEATURE_BITS
_LETTER = np.array([chr(c).isalpha() for c in range(0x10000)])
_FACTOR = np.uint32(2654435761)
# N-grams whose gradients are summed together on the executors.
GRAMS_PER_SLICE = 1024


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the lower-cased text and their counts; anything but letters separates words."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _LETTER[np.minimum(codes, 0xFFFF)]
    beyond = np.flatnonzero(codes > 0xFFFF)
    letter[beyond] = [chr(c).isalpha() for c in codes[beyond].tolist()]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    line = np.concatenate([[32], np.where(letter, codes, 32)[keep], [32] if letter[-1] else []]).astype(np.uint32)
    counts, hashed = np.zeros(_SIZE), np.zeros(len(line), np.uint32)
    for n in range(1, LONGEST_GRAM + 1):
        hashed = (hashed[:len(line) - n + 1] * np.uint32(31) + line[n - 1:] + np.uint32(n)) * _FACTOR
        hashed ^= hashed >> np.uint32(15)
        counts += np.bincount(hashed >> np.uint32(32 - FEATURE_BITS), minlength=_SIZE)
    grams = np.flatnonzero(counts)
    return grams, counts[grams]


def _document_counts(batches):
    """How many documents hold each n-gram; the number of documents under -1."""
    found, rows = np.zeros(_SIZE, np.int64), 0
    for batch in batches:
        for text in batch.column("text"):
            grams, _ = gram_counts(text.as_py() or "")
            found[grams] += 1
        rows += batch.num_rows
    used = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1).astype(np.int32)), pa.array(np.append(found[used], rows))], names=["gram", "n"])


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """Smoothed idf of every hashed n-gram over all rows."""
    rows = texts.select("text").mapInArrow(_document_counts, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(_SIZE + 1)
    for r in rows:
        counts[r.gram] = r.n
    return np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1


def weighted(text: str, idf: np.ndarray):
    grams, counts = gram_counts(text)
    values = (1 + np.log(counts)) * idf[grams]
    return grams, values / max(1e-12, float(np.sqrt(values @ values)))


def _featured(idf: np.ndarray):
    def run(batches):
        for batch in batches:
            pairs = [weighted(t or "", idf) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("calibrate"), pa.array([g for g, _ in pairs], pa.list_(pa.int32())),
                 pa.array([v for _, v in pairs], pa.list_(pa.float32()))], names=["label", "calibrate", "grams", "values"])
    return run


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # n-grams and one for the bias, by label
    temperature: float = 1.0


def _logits(weights: np.ndarray, grams, values, sizes) -> np.ndarray:
    of_row = np.repeat(np.arange(len(sizes)), sizes)
    products = weights[grams] * values[:, None]
    return weights[-1] + np.stack(
        [np.bincount(of_row, products[:, k], minlength=len(sizes)) for k in range(weights.shape[1])], axis=1)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _unpacked(batch):
    grams, values = batch.column("grams"), batch.column("values")
    return (grams.flatten().to_numpy(), values.flatten().to_numpy().astype(float),
            grams.value_lengths().to_numpy(), batch.column("label").to_numpy())


def _sparse(weights: np.ndarray):
    """Weights by their rows that are not zero; most are."""
    used = np.flatnonzero(weights.any(axis=1))
    return weights.shape, used, weights[used]


def _dense(sparse) -> np.ndarray:
    shape, used, values = sparse
    weights = np.zeros(shape)
    weights[used] = values
    return weights


def _gradients(shared):
    """Gradient over the rows of a task, by slices of n-grams that are not all zero."""
    def run(batches):
        weights = _dense(shared.value)
        total, rows = np.zeros(weights.shape), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            grams, values, sizes, label = _unpacked(batch)
            error = _softmax(_logits(weights, grams, values, sizes))
            error[np.arange(len(label)), label] -= 1
            spread = np.repeat(error, sizes, axis=0) * values[:, None]
            for k in range(weights.shape[1]):
                total[:-1, k] += np.bincount(grams, spread[:, k], minlength=_SIZE)
            total[-1] += error.sum(axis=0)
            rows += len(label)
        for number in range(-(-len(total) // GRAMS_PER_SLICE) if rows else 0):
            part = total[number * GRAMS_PER_SLICE:(number + 1) * GRAMS_PER_SLICE]
            if part.any():
                yield pa.RecordBatch.from_pydict({"slice": pa.array([number], pa.int32()), "sums": [part.astype("<f4").tobytes()]})
    return run


def _sum_slices(batches):
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, data in zip(batch.column("slice").to_pylist(), batch.column("sums").to_pylist()):
            totals[number] = totals.get(number, 0) + np.frombuffer(data, "<f4").astype(float)
    if totals:
        yield pa.RecordBatch.from_pydict({"slice": pa.array(list(totals), pa.int32()),
                                          "sums": [t.astype("<f4").tobytes() for t in totals.values()]})


def gradient(fit: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Summed over all rows. Slices are added up on the executors, so one vector of the model's size at most reaches the driver."""
    shared = fit.sparkSession.sparkContext.broadcast(_sparse(weights))
    slices = fit.mapInArrow(_gradients(shared), "slice int, sums binary").repartition("slice").mapInArrow(
        _sum_slices, "slice int, sums binary")
    total = np.zeros(weights.shape)
    for r in slices.collect():
        part = np.frombuffer(r.sums, "<f4").reshape(-1, weights.shape[1])
        total[r.slice * GRAMS_PER_SLICE:r.slice * GRAMS_PER_SLICE + len(part)] = part
    return total


def _losses(shared, temperatures: np.ndarray):
    """Negative log likelihood at every temperature."""
    def run(batches):
        weights = _dense(shared.value)
        total = np.zeros(len(temperatures))
        for batch in batches:
            if batch.num_rows:
                grams, values, sizes, label = _unpacked(batch)
                logits = _logits(weights, grams, values, sizes)
                for i, t in enumerate(temperatures):
                    chosen = _softmax(logits / t)[np.arange(len(label)), label]
                    total[i] -= np.log(np.maximum(chosen, 1e-300)).sum()
        yield pa.RecordBatch.from_pydict({"place": pa.array(np.arange(len(total)), pa.int32()), "loss": total})
    return run


def train(labelled: DataFrame, training_rows: int = TRAINING_ROWS, rounds: int = ROUNDS) -> Model:
    """Fit to documents (doc_id, text, lang), rows without a lang left out.

    Document frequencies come from all of them. Of more than ``training_rows`` rows about so many,
    by a hash of their ids, fit the weights and the temperature. Every round sums the gradients of
    all partitions and updates each coordinate by follow-the-regularised-leader. Null and empty texts
    teach the bias alone; rows that repeat count as often as they are there; rows of a null id are
    taken or left together. Other columns are not read.
    """
    known = labelled.where(F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    counts = known.groupBy("lang").count().collect()
    labels, there = sorted(r.lang for r in counts), sum(r["count"] for r in counts)
    if not labels:
        return Model([], np.ones(_SIZE), np.zeros((_SIZE + 1, 0)))
    idf = inverse_frequencies(known)
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    if there > training_rows:
        known = known.where(drawn < int(training_rows / there * (1 << 31)))
    numbered = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("lang")).cast("int") - 1
    rows = store(known.select(numbered.alias("label"), (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(CALIBRATION)) == 0).alias("calibrate"), "text")
                 .repartition(TRAINING_FILES).mapInArrow(
                     _featured(idf), "label int, calibrate boolean, grams array<int>, values array<float>"), "labelled")
    shape = (_SIZE + 1, len(labels))
    z, n, weights = np.zeros(shape), np.zeros(shape), np.zeros(shape)
    l1 = np.append(np.full(_SIZE, L1), 0.0)[:, None]
    fit = rows.where("not calibrate").coalesce(TRAINING_FILES)
    for _ in range(rounds):
        g = gradient(fit, weights)
        if not g.any():
            break
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / LEARNING_RATE
        z += g - sigma * weights
        n += g * g
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        weights = -shrunk / ((BETA + np.sqrt(n)) / LEARNING_RATE + L2)
    held = rows.where("calibrate").coalesce(TRAINING_FILES)
    losses = held.mapInArrow(_losses(known.sparkSession.sparkContext.broadcast(_sparse(weights)), TEMPERATURES), "place int, loss double").groupBy("place").agg(
        F.sum("loss").alias("loss")).collect()
    best = min(losses, key=lambda r: (round(r.loss, 6), abs(np.log(TEMPERATURES[r.place])))) if losses else None
    return Model(labels, idf, weights.astype(np.float32), float(TEMPERATURES[best.place]) if best else 1.0)


def _predict(model: Model):
    def run(batches):
        for batch in batches:
            langs, scores = [], []
            for text in batch.column("text"):
                grams, values = weighted(text.as_py() or "", model.idf)
                if not len(grams) or not model.labels:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                logits = model.weights[-1] + values @ model.weights[grams]
                p = _softmax((logits / model.temperature)[None, :])[0]
                langs.append(model.labels[int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every row. A text that is null or has no letter is ``und`` with
    score 0, as is every text when nothing was learned. Equal probabilities go to the label that
    sorts first. Other columns are not read."""
    return docs.select("doc_id", "text").mapInArrow(_predict(model), "doc_id long, lang_pred string, score double")
