"""Hidden Markov language model: states trained by Baum-Welch, texts scored by the forward recursion.

Every word belongs to a class: a word with at least a 2**-14 share of the training tokens is a class
of its own, the others share a class with words of the same last bytes, once-seen words apart from
the rest, and all unknown words are one class. A state emits classes; inside its class a word is drawn
by its smoothed share. So the model has at most ``2**14 + 2 * SUFFIX_CLASSES + 1`` classes however
many words there are, while the words and their counts stay in a distributed table.

Texts are cut into blocks that are encoded against a dictionary of their own. A block sends each owner
its words, packed into one row, and gets their corpus counts and classes back in the same order. The
counts of an owner's words are summed in a first pass over these messages, before any is answered.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtide.llm.common import text_bytes
from railtide.session import store

STATES = 8
ITERATIONS = 6
OWN_CLASS_SHARE = 2.0 ** -14
SUFFIX_CLASSES = 4096
SUFFIX_BYTES = 3
SMOOTHING = 0.1
# White space cannot be a word.
END = b"\n"
# Pseudo tokens of the class shares that every state starts from.
PRIOR = 50.0
# For training, long texts are cut into runs so that many are advanced at once.
TRAINING_RUN = 256
# Cells (runs times longest) of the runs advanced at once; training keeps what it met in every cell.
SCORING_CELLS, TRAINING_CELLS = 500_000, 250_000
# Bytes of text that share a dictionary, and tokens of the texts that are handed on in one row.
BLOCK_BYTES, ROW_TOKENS = 16_000_000, 250_000
# Into so many parts all words are divided; an owner's part of the vocabulary is held by one task.
OWNERS = 1024

# A row is a message (owner, words, seen) or some texts (doc_ids, held, sizes, places).
CODED = ("block string, owner int, words binary, seen binary, doc_ids array<long>, held array<boolean>, "
         "sizes array<int>, places binary")
_WIDE = {"words": pa.binary(), "seen": pa.binary(), "places": pa.binary(), "owner": pa.int32(), "block": pa.string(),
         "doc_ids": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()), "sizes": pa.list_(pa.int32())}


class _Places(dict):
    """Numbers words in the order in which they are met."""

    def __missing__(self, word):
        self[word] = place = len(self)
        return place


def _coded_row(**columns):
    names = [c.split()[0] for c in CODED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([columns.get(n)], _WIDE[n]) for n in names], names=names)


def _code_block(ids: list, held: list, texts: list[bytes], owners: int):
    """The messages of a block and its texts, as places in the block's dictionary ordered by owner.

    A word's end is never a line end, so words are packed with one after each; the end of a text is
    packed as the empty word.
    """
    block, places = uuid.uuid4().hex, _Places({END: 0})
    coded = []
    for text in texts:
        words = text.lower().split()
        words.append(END)
        coded.append(np.fromiter(map(places.__getitem__, words), np.int32, len(words)))
    sizes = np.array([len(c) for c in coded])
    flat = np.concatenate(coded)
    seen = np.bincount(flat[~np.repeat(np.array(held, bool), sizes)], minlength=len(places))
    words = np.array([b"" if w == END else w for w in places], object)
    owner = np.fromiter((zlib.crc32(w) % owners for w in words), np.int64, len(words))
    order = np.argsort(owner, kind="stable")
    renumbered = np.empty(len(order), np.int32)
    renumbered[order] = np.arange(len(order), dtype=np.int32)
    edges = np.flatnonzero(np.diff(owner[order], prepend=-1, append=owners))
    for lo, hi in zip(edges, edges[1:]):
        yield _coded_row(block=block, owner=int(owner[order[lo]]), words=b"\n".join(words[order[lo:hi]]),
                         seen=seen[order[lo:hi]].astype("<i8").tobytes())
    at = 0
    for lo, hi in cut_by_size(sizes, ROW_TOKENS):
        tokens = int(sizes[lo:hi].sum())
        yield _coded_row(block=block, doc_ids=ids[lo:hi], held=held[lo:hi], sizes=sizes[lo:hi].tolist(),
                         places=renumbered[flat[at:at + tokens]].astype("<i4").tobytes())
        at += tokens


def cut_by_size(sizes: np.ndarray, most: int):
    """(first, after the last) of consecutive parts with at most ``most`` together, or one member."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + most, side="right")))
        yield at, to
        at = to


def _code_blocks(owners: int):
    def run(batches):
        ids, held, texts, size = [], [], [], 0
        for batch in batches:
            lengths = pc.binary_length(batch.column("data")).to_numpy()
            for lo, hi in cut_by_size(lengths, BLOCK_BYTES):
                ids += batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                held += batch.column("held_out").slice(lo, hi - lo).to_pylist()
                texts += batch.column("data").slice(lo, hi - lo).to_pylist()
                size += int(lengths[lo:hi].sum())
                if size >= BLOCK_BYTES / 2:
                    yield from _code_block(ids, held, texts, owners)
                    ids, held, texts, size = [], [], [], 0
        if texts:
            yield from _code_block(ids, held, texts, owners)
    return run


def _runs(values) -> list[tuple[int, int]]:
    """(first, after the last) of the runs of equal values."""
    values = np.asarray(values)
    edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return list(zip(edges, edges[1:])) if len(values) else []


def _sum_words(batches):
    """One row per owner: its words and their counts in the training texts."""
    current, places, totals = None, _Places(), np.zeros(0, np.int64)

    def done():
        return pa.RecordBatch.from_pydict({
            "owner": pa.array([current], pa.int32()), "words": [b"\n".join(places)], "counts": [totals.astype("<i8").tobytes()],
            "tokens": [int(totals.sum())], "known": [int((totals > 0).sum())]})
    for batch in batches:
        for owner, words, seen in zip(*(batch.column(c) for c in ("owner", "words", "seen"))):
            if owner.as_py() != current:
                if current is not None:
                    yield done()
                current, places, totals = owner.as_py(), _Places(), np.zeros(0, np.int64)
            words = words.as_py().split(b"\n")
            at = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
            totals = np.append(totals, np.zeros(len(places) - len(totals), np.int64))
            # A block names a word once.
            totals[at] += np.frombuffer(seen.as_py(), "<i8")
    if current is not None:
        yield done()


@dataclass
class Classes:
    """Shares of the word classes and how to find a word's class."""

    own: dict[bytes, int]
    mass: np.ndarray  # share of each class, summing to one
    tokens: int  # N
    words: int  # V

    @property
    def unknown(self) -> int:
        return len(self.mass) - 1

    @property
    def once(self) -> slice:
        """Classes of words seen once: what an unknown word was before it was seen."""
        return slice(len(self.own) + SUFFIX_CLASSES, len(self.own) + 2 * SUFFIX_CLASSES)

    @property
    def shares(self):
        """Smoothed share of a word by its count."""
        return lambda counts: (counts + SMOOTHING) / (self.tokens + SMOOTHING * (self.words + 1))

    def of(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Classes of words with their training counts; the end of a text is the empty word."""
        first = len(self.own)
        own = np.fromiter((self.own.get(w, -1) for w in words), np.int64, len(words))
        suffix = np.fromiter((zlib.crc32(w[-SUFFIX_BYTES:]) % SUFFIX_CLASSES for w in words), np.int64, len(words))
        shared = first + suffix + np.where(counts == 1, SUFFIX_CLASSES, 0)
        return np.where(counts == 0, first + 2 * SUFFIX_CLASSES, np.where(own >= 0, own, shared))


def _unpacked(batch):
    for words, counts in zip(batch.column("words"), batch.column("counts")):
        yield words.as_py().split(b"\n"), np.frombuffer(counts.as_py(), "<i8")


def _frequent(least: float):
    def run(batches):
        for batch in batches:
            for words, counts in _unpacked(batch):
                yield pa.RecordBatch.from_pydict({"word": pa.array([words[i] for i in np.flatnonzero(counts >= least)], pa.binary())})
    return run


def _masses(shared):
    def run(batches):
        classes = shared.value
        mass = np.zeros(len(classes.mass))
        for batch in batches:
            for words, counts in _unpacked(batch):
                mass += np.bincount(classes.of(words, counts), np.where(counts > 0, classes.shares(counts), 0), len(mass))
        used = np.flatnonzero(mass)
        yield pa.RecordBatch.from_pydict({"kind": pa.array(used.astype(np.int32)), "mass": pa.array(mass[used])})
    return run


def word_classes(counted: DataFrame) -> Classes:
    """Classes and their shares, from the counts of all words. Only what is bounded by the model comes to the driver."""
    tokens, words = counted.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    # At most 2**14 words have such a share.
    own = counted.select("words", "counts").mapInArrow(
        _frequent(max(2.0, tokens * OWN_CLASS_SHARE)), "word binary").collect()
    own = {w: i for i, w in enumerate(sorted(bytes(r.word) for r in own))}
    classes = Classes(own, np.zeros(len(own) + 2 * SUFFIX_CLASSES + 1), int(tokens), int(words))
    shared = counted.sparkSession.sparkContext.broadcast(classes)
    for r in counted.select("words", "counts").mapInArrow(_masses(shared), "kind int, mass double").groupBy("kind").agg(
            F.sum("mass").alias("mass")).collect():
        classes.mass[r.kind] = r.mass
    classes.mass[-1] = classes.shares(0)
    return classes


def _answer(shared):
    """Counts and classes of the words of every message; an owner's counts come before its messages."""
    def run(batches):
        classes = shared.value
        places, counts, kinds = {}, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for words, known, block, owner in zip(*(batch.column(c) for c in ("words", "counts", "block", "owner"))):
                words = words.as_py().split(b"\n")
                if known.is_valid:
                    places = {w: i for i, w in enumerate(words)}
                    counts = np.frombuffer(known.as_py(), "<i8")
                    kinds = classes.of(words, counts)
                    continue
                at = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block.as_py()]), "owner": pa.array([owner.as_py()], pa.int32()),
                    "counts": [counts[at].astype("<i8").tobytes()], "kinds": [kinds[at].astype("<i4").tobytes()]})
    return run


CLASSED = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, inside double, classes binary")


def _class_texts(shared):
    """Replace places by classes. The answers to a block come before its texts, in the order of owners."""
    def run(batches):
        classes = shared.value
        log_mass = np.log10(np.where(classes.mass > 0, classes.mass, 1))
        current, parts, tables = None, [], None
        for batch in batches:
            for block, counts, kinds, ids, held, sizes, places in zip(*(batch.column(c) for c in (
                    "block", "counts", "kinds", "doc_ids", "held", "sizes", "places"))):
                if block.as_py() != current:
                    current, parts, tables = block.as_py(), [], None
                if counts.is_valid:
                    parts.append((counts.as_py(), kinds.as_py()))
                    continue
                if tables is None:
                    counts = np.frombuffer(b"".join(c for c, _ in parts), "<i8")
                    kinds = np.frombuffer(b"".join(k for _, k in parts), "<i4")
                    logs = np.log10(classes.shares(counts))
                    parts, tables = [], (kinds.astype("<u2"), logs, logs - log_mass[kinds], counts > 0)
                yield _scored(ids.values, held.values, sizes.values.to_numpy(), np.frombuffer(places.as_py(), "<i4"), *tables)
    return run


def _scored(ids, held, sizes, flat, kinds, logs, inside, known):
    starts = np.cumsum(sizes) - sizes
    offsets = pa.py_buffer(np.concatenate([[0], np.cumsum(sizes) * 2]).astype(np.int32))
    columns = {
        "doc_id": ids, "held_out": held, "n_tokens": pa.array(sizes.astype(np.int64)),
        "n_known": pa.array(np.add.reduceat(known[flat].astype(np.int64), starts)),
        "base_score": pa.array(np.add.reduceat(logs[flat], starts)), "inside": pa.array(np.add.reduceat(inside[flat], starts)),
        "classes": pa.Array.from_buffers(pa.binary(), len(sizes), [None, offsets, pa.py_buffer(kinds[flat].tobytes())])}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def class_sequences(column: pa.Array):
    """(classes of all texts one after the other, tokens of each) of a column of packed classes, some texts at a time."""
    lengths = pc.binary_length(column).to_numpy().astype(np.int64) // 2
    for lo, hi in cut_by_size(lengths, ROW_TOKENS):
        packed = b"".join(column.slice(lo, hi - lo).to_pylist())
        yield lo, hi, np.frombuffer(packed, "<u2").astype(np.int32), lengths[lo:hi]


@dataclass
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes x states


def first_model(classes: Classes, states: int = STATES, seed: int = 5) -> Model:
    """States that stay, and emit the classes in randomly tilted shares."""
    rng = np.random.default_rng(seed)
    emit = classes.mass[:, None] * np.exp(rng.normal(0, 0.5, (len(classes.mass), states)))
    move = np.full((states, states), 0.1 / max(1, states - 1)) + np.eye(states) * (0.9 - 0.1 / max(1, states - 1))
    return Model(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def groups_of_runs(sizes: np.ndarray, cells: int):
    """Numbers of the runs that are advanced together, longest first."""
    order = np.argsort(-sizes, kind="stable")
    at = 0
    while at < len(order):
        count = max(1, cells // max(1, int(sizes[order[at]])))
        yield order[at:at + count]
        at += count


def _grid(flat, starts, sizes):
    """Classes by step and run; runs are sorted by falling length, so those still going come first."""
    longest = int(sizes[0])
    going = np.searchsorted(-sizes, -np.arange(longest), side="left")
    steps = np.arange(longest)
    cells = starts[None, :] + np.minimum(steps[:, None], sizes[None, :] - 1)
    return flat[cells], going


def forward_scores(model: Model, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 likelihood of every class sequence by the scaled forward recursion over all its tokens."""
    starts, scores = np.cumsum(sizes) - sizes, np.zeros(len(sizes))
    for group in groups_of_runs(sizes, SCORING_CELLS):
        grid, going = _grid(flat, starts[group], sizes[group])
        total = np.zeros(len(group))
        alpha = np.broadcast_to(model.start, (len(group), len(model.start)))
        ones = np.ones(len(model.start))
        for step in range(len(grid)):
            n = going[step]
            ahead = alpha[:n] if step == 0 else alpha[:n] @ model.move
            alpha = ahead * model.emit[grid[step, :n]]
            scale = alpha @ ones
            alpha = alpha / scale[:, None]
            total[:n] += np.log10(scale)
        scores[group] = total
    return scores


def expected_counts(model: Model, flat: np.ndarray, sizes: np.ndarray, firsts: np.ndarray):
    """Baum-Welch counts of starts, moves and emissions over runs.

    ``firsts`` marks the runs that begin a text; only they count as starts.
    """
    states = len(model.start)
    starts, moves = np.zeros(states), np.zeros((states, states))
    emits = np.zeros((len(model.emit), states))
    begin = np.cumsum(sizes) - sizes
    ones = np.ones(states)
    for group in groups_of_runs(sizes, TRAINING_CELLS):
        grid, going = _grid(flat, begin[group], sizes[group])
        alphas, shares, scales = [], [], []
        alpha = np.broadcast_to(model.start, (len(group), states))
        for step in range(len(grid)):
            n = going[step]
            share = model.emit[grid[step, :n]]
            alpha = (alpha[:n] if step == 0 else alpha[:n] @ model.move) * share
            scale = (alpha @ ones)[:, None]
            alpha = alpha / scale
            alphas.append(alpha)
            shares.append(share)
            scales.append(scale)
        beta = np.ones((going[-1], states))
        gammas = [None] * len(grid)
        for step in range(len(grid) - 1, -1, -1):
            n = going[step]
            if n > len(beta):
                beta = np.concatenate([beta, np.ones((n - len(beta), states))])
            gammas[step] = alphas[step] * beta
            if step:
                ahead = shares[step] * beta / scales[step]
                moves += alphas[step - 1][:n].T @ ahead
                beta = ahead @ model.move.T
        starts += gammas[0][firsts[group]].sum(axis=0)
        tokens = np.concatenate([grid[s, :going[s]] for s in range(len(grid))])
        gamma = np.concatenate(gammas)
        for state in range(states):
            emits[:, state] += np.bincount(tokens, gamma[:, state], minlength=len(emits))
    return starts, moves * model.move, emits


def _count(shared):
    """Rows (kind, k0..): counts of a class, of moves from state ``-1 - kind``, or of starts (-1 - states)."""
    def run(batches):
        model = shared.value
        states = len(model.start)
        starts, moves = np.zeros(states), np.zeros((states, states))
        emits, any_text = np.zeros(model.emit.shape), False
        for batch in batches:
            for _, _, flat, sizes in class_sequences(batch.column("classes")):
                any_text = True
                runs = -(-sizes // TRAINING_RUN)
                nth = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
                cut = np.minimum(np.repeat(sizes, runs) - nth * TRAINING_RUN, TRAINING_RUN)
                a, b, c = expected_counts(model, flat, cut, nth == 0)
                starts, moves, emits = starts + a, moves + b, emits + c
        if any_text:
            used = np.flatnonzero(emits.sum(axis=1))
            kinds = np.concatenate([used, -1 - np.arange(states), [-1 - states]])
            values = np.concatenate([emits[used], moves, starts[None, :]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds.astype(np.int32)), *[pa.array(values[:, s]) for s in range(states)]],
                names=["kind", *[f"k{s}" for s in range(states)]])
    return run


def train(texts: DataFrame, classes: Classes, states: int = STATES, iterations: int = ITERATIONS) -> Model:
    """Baum-Welch over a table with packed ``classes``; each round sums the counts of all partitions."""
    model = first_model(classes, states)
    columns = [f"k{s}" for s in range(states)]
    schema = "kind int, " + ", ".join(f"{c} double" for c in columns)
    for _ in range(iterations):
        counted = texts.select("classes").mapInArrow(_count(texts.sparkSession.sparkContext.broadcast(model)), schema)
        # One row per class and state: bounded by the model.
        rows = counted.groupBy("kind").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
        if not rows.num_rows:
            return model
        model = _maximise(rows, classes, states)
    return model


def _maximise(rows: pa.Table, classes: Classes, states: int) -> Model:
    kinds = rows.column("kind").to_numpy()
    values = np.stack([rows.column(f"k{s}").to_numpy() for s in range(states)], axis=1)
    emits = np.zeros((len(classes.mass), states))
    emits[kinds[kinds >= 0]] = values[kinds >= 0]
    moves = np.stack([values[kinds == -1 - s][0] for s in range(states)])
    starts = values[kinds == -1 - states][0] + 1
    moves = moves + 1
    # Leaving one text out, a word seen once would have been unknown.
    once = emits[classes.once].sum(axis=0)
    overall = once.sum() / max(1.0, emits.sum())
    unknown = (once + PRIOR * max(overall, classes.mass[-1])) / (emits.sum(axis=0) + PRIOR)
    emits[:-1] += PRIOR * classes.mass[:-1, None]
    emits[-1] = 0
    emit = emits / emits.sum(axis=0) * (1 - unknown)
    emit[-1] = unknown
    return Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emit)


def _score(shared, tokens: int):
    def run(batches):
        model = shared.value
        for batch in batches:
            for lo, hi, flat, sizes in class_sequences(batch.column("classes")):
                part = batch.slice(lo, hi - lo)
                found = forward_scores(model, flat, sizes) + part.column("inside").to_numpy()
                kept = ["doc_id", "held_out", "n_tokens", "n_known"]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], pa.array(np.full(len(sizes), tokens)), part.column("base_score"),
                     pa.array(found)], names=[*kept, "train_tokens", "base_score", "score"])
    return run


def classed_texts(docs: DataFrame, owners: int = OWNERS) -> tuple[DataFrame, Classes]:
    """Every row of ``docs`` (doc_id, text, held_out) as the packed classes of its tokens, with its word scores."""
    rows = docs.select("doc_id", "held_out", text_bytes().alias("data"))
    coded = store(rows.mapInArrow(_code_blocks(owners), CODED), "coded")
    messages = coded.where(F.col("owner").isNotNull())
    counted = store(messages.select("owner", "words", "seen").repartition("owner").sortWithinPartitions("owner").mapInArrow(
        _sum_words, "owner int, words binary, counts binary, tokens long, known long"), "words")
    classes = word_classes(counted)
    shared = docs.sparkSession.sparkContext.broadcast(classes)
    nothing = lambda **columns: [F.lit(None).cast(kind).alias(name) for name, kind in columns.items()]
    asked = messages.select("owner", "words", *nothing(counts="binary"), "block")
    known = counted.select("owner", "words", "counts", *nothing(block="string"))
    answers = asked.unionByName(known).repartition("owner").sortWithinPartitions("owner", F.col("counts").isNull()).mapInArrow(
        _answer(shared), "block string, owner int, counts binary, kinds binary")
    texts = coded.where(F.col("owner").isNull()).select(
        "block", *nothing(owner="int", counts="binary", kinds="binary"), "doc_ids", "held", "sizes", "places")
    answers = answers.select("*", *nothing(doc_ids="array<long>", held="array<boolean>", sizes="array<int>", places="binary"))
    # A block and its answers have a bounded size, so a task meets a few bounded blocks one after the other.
    together = answers.unionByName(texts).repartition("block").sortWithinPartitions("block", F.col("owner").isNull(), "owner")
    return store(together.mapInArrow(_class_texts(shared), CLASSED), "classed"), classes


def score_texts(docs: DataFrame, states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """Train on the rows of ``docs`` whose ``held_out`` is false and score all of them.

    ``docs`` has doc_id, text, held_out; other columns are not read. Returns doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score, one row per row. Words are runs of other than
    ASCII white space, lower-cased in A-Z, and every text ends with one end token; a null text
    counts as empty. ``base_score`` is the log10 probability under smoothed word shares, ``score``
    under the hidden Markov model, both over the training words and one unknown word. Without
    training rows every token is unknown and has probability one under both.
    """
    classed, classes = classed_texts(docs)
    model = train(classed.where(~F.col("held_out")), classes, states, iterations)
    return classed.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model), classes.tokens), (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
