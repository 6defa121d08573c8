"""Benchmark decontamination by latent semantic retrieval.

Passages of the documents become TF-IDF vectors over the benchmark's words. A randomised SVD, its
Gram products summed over all partitions, gives a latent space in which every passage is compared
by cosine with every item; only its heaviest directions are kept. Candidates are then checked word by
word: longest common subsequence with the item, and whether the end of the item, its answer, is there
as well. A passage that is close to the item by its cosine is convicted by its answer and a smaller part of the
item in order, so a paraphrase that moves words about is found. A text whose words alone could convict an
item is a candidate too, whatever its cosine, so that none of these is lost.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from railtide.session import store

# Words of a passage, and between the starts of two.
PASSAGE, STRIDE = 48, 24
# Items that are searched in one pass over the documents, which bounds vocabulary and model; more are searched in turns.
ITEMS_AT_ONCE = 50_000
# Directions of the latent space: as many, or a third of the items if that is less; and what the draw has above that.
RANK, RANK_PART = 128, 3
SPARE_RANK = 56
# A word in more than this share of all passages, and in more than so many, has no weight, but the
# rarest words of every item have some.
COMMON_SHARE, COMMON_LEAST = 0.01, 100
RAREST = 5
# Cosine that makes a candidate; less for items whose convicting share cannot reach it.
COSINE = 0.25
# Shares of an item's words in common order that convict it, alone and together with its answer.
ALIKE, ALIKE_WITH_ANSWER, ANSWER_ALIKE = 0.8, 0.6, 0.6
# Cosine, inside the latent space, of a candidate that is close to the item, and the share that convicts it with its answer then.
CLOSE, ALIKE_WHEN_CLOSE = 0.8, 0.4
# Shorter items must be there as they are, word after word.
FEWEST_WORDS = 5
# What a check of a candidate costs, in words that an item shares with a passage.
CHECK_COST = 5000
TERMS_PER_SLICE = 256
# Words of the texts, passages and items that are worked on at once, which bounds a task's memory.
WORDS_AT_ONCE, PASSAGES_AT_ONCE, ITEMS_AT_A_TIME = 100_000, 256, 256

_WORD = re.compile(r"\w+")
# Scripts without spaces between words: Thai, Lao, Burmese, Khmer, kana, Han. Each of their signs is a word.
_UNSPACED = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
             "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff")
_SIGN = re.compile(f"[{_UNSPACED}]")
_SIGN_OR_WORD = re.compile(rf"(?=\w)[{_UNSPACED}]|[^\W{_UNSPACED}]+")
# Lower case of the first 256 characters, all of which stay below 256, and a space for those that are in no word.
_LATIN = bytes(ord(c.lower()) if _WORD.match(c) else 32 for c in map(chr, range(256)))


def words_of(text: str | None) -> list[str]:
    text = text or ""
    try:
        return text.encode("latin-1").translate(_LATIN).decode("latin-1").split()
    except UnicodeEncodeError:
        text = text.lower()
    plain = text.isascii() or not _SIGN.search(text)
    return (_WORD if plain else _SIGN_OR_WORD).findall(text)


def answer_words(words: list[str]) -> list[str]:
    """The last quarter of an item, three words at least."""
    return words[-max(3, len(words) // 4):]


def common_subsequence(item: list, text: list, least: float = 0) -> int:
    """Length of the longest common subsequence, one big-integer step per word of the text that the item has.

    Zero if so few of the item's words are in the text at all that it cannot reach ``least``.
    """
    places: dict = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    full = rest = (1 << len(item)) - 1
    # Words that the item lacks change nothing.
    hits = list(filter(None, map(places.get, text)))
    if sum(set(hits)).bit_count() < least:
        return 0
    for hit in hits:
        met = rest & hit
        rest = ((rest + met) | (rest - met)) & full
    return len(item) - rest.bit_count()


def code_texts(texts: list[list[str]], vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Terms of all words of the texts, -1 outside the vocabulary; words of each text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    return np.fromiter(map(vocabulary.get, chain.from_iterable(texts), repeat(-1)), np.int64, lengths.sum()), lengths


def code_passages(codes: np.ndarray, lengths: np.ndarray, size: int, wanted: np.ndarray | None = None):
    """Passages of several texts: (number per text, terms of all passages by passage, counts,
    passage of each entry, words outside the vocabulary per passage). Only terms that are ``wanted``, if given,
    have entries; the others of the ``size`` terms are left out, but are not outside."""
    numbers = np.maximum(1, -(-(lengths - (PASSAGE - STRIDE)) // STRIDE))
    first, begins = np.cumsum(numbers) - numbers, np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(lengths)), numbers)
    starts = begins[owner] + (np.arange(len(owner)) - first[owner]) * STRIDE
    before = np.concatenate([[0], np.cumsum(codes < 0)])
    outside = before[np.minimum(starts + PASSAGE, begins[owner] + lengths[owner])] - before[starts]
    # The last answers for words outside.
    at = np.flatnonzero(codes >= 0 if wanted is None else np.append(wanted, False)[codes])
    text = np.repeat(np.arange(len(lengths)), lengths)[at]
    step, codes, entries = (at - begins[text]) // STRIDE, codes[at], []
    for back in range(PASSAGE // STRIDE):
        inside = (step >= back) & (step - back < numbers[text])
        entries.append((first[text[inside]] + step[inside] - back) * size + codes[inside])
    cells, counts = np.unique(np.concatenate(entries), return_counts=True)
    size = max(1, size)
    return numbers, cells % size, counts, cells // size, outside


def _cut_texts(column):
    """The words of the texts of a column, as many texts at a time as hold some number of words."""
    texts, held = [], 0
    for text in column:
        words = words_of(text.as_py())
        if texts and held + len(words) > WORDS_AT_ONCE:
            yield texts
            texts, held = [], 0
        texts.append(words)
        held += len(words)
    if texts:
        yield texts


# Columns of the stored passages, each a packed array. What is counted within a passage fits a byte.
PACKED = {"terms": "<i4", "counts": "u1", "sizes": "u1", "outside": "u1"}


def _unpacked(batch, names):
    """The arrays of every row of stored passages."""
    for row in zip(*(batch.column(name) for name in names)):
        yield [np.frombuffer(cell.as_buffer(), PACKED[name]) for name, cell in zip(names, row)]


def _passages(vocabulary):
    def run(batches):
        for batch in batches:
            for texts in _cut_texts(batch.column("text")):
                _, terms, counts, passage, outside = code_passages(*code_texts(texts, vocabulary.value), len(vocabulary.value))
                columns = terms, counts, np.bincount(passage, minlength=len(outside)), outside
                yield pa.RecordBatch.from_pydict({name: [x.astype(kind).tobytes()] for (name, kind), x in zip(PACKED.items(), columns)})
    return run


def _document_counts(batches):
    """Passages that hold each term; the number of passages under -1."""
    found, passages = np.zeros(0, np.int64), 0
    for batch in batches:
        for terms, sizes in _unpacked(batch, ["terms", "sizes"]):
            part = np.bincount(terms, minlength=len(found))
            part[:len(found)] += found
            found = part
            passages += len(sizes)
    used = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1).astype(np.int32)), pa.array(np.append(found[used], passages).astype(np.int64))],
        names=["term", "n"])


@dataclass
class Words:
    """Which of an item's words must be near each other wherever the item is convicted."""
    first: np.ndarray  # per term, and one more: where its items begin
    items: np.ndarray  # items of each term, as often as the item has the word
    needed: np.ndarray  # words that must be there, per item
    reach: np.ndarray  # strides between the first passage and the last that can hold them, per item


@dataclass
class Model:
    vocabulary: dict[str, int]
    idf: np.ndarray
    outside: float  # squared weight of a word outside the vocabulary
    latent: np.ndarray  # terms x directions
    placed: np.ndarray  # items x directions, of length one
    limits: np.ndarray  # cosine from which a passage is a candidate, per item
    item_ids: list
    items: list[list[str]]
    coded: list[np.ndarray]  # the items' words as terms
    repeats: list[int]  # how often the benchmark has the item
    words: Words


# Weight of a word by how often the passage has it.
_DAMPED = np.concatenate([[0], 1 + np.log(np.arange(1, PASSAGE + 1))])


def _weighted(model_idf, outside_weight, terms, counts, passage, outside):
    """Values of unit passage vectors, and the norm of their known part."""
    values = _DAMPED[counts] * model_idf[terms]
    known = np.bincount(passage, values * values, minlength=len(outside))
    norms = np.sqrt(known + outside * outside_weight)
    norms[norms == 0] = 1
    return values / norms[passage], np.sqrt(known) / norms


def _dense_parts(terms, passage, values):
    """Some hundred passages at a time: (passages, terms they use, dense matrix of their values).

    Entries are sorted by passage; passages without entries are left out.
    """
    present = np.unique(passage)
    for at in range(0, len(present), PASSAGES_AT_ONCE):
        own = present[at:at + PASSAGES_AT_ONCE]
        lo, hi = np.searchsorted(passage, [own[0], own[-1] + 1])
        used, column = np.unique(terms[lo:hi], return_inverse=True)
        dense = np.zeros((len(own), len(used)), np.float32)
        dense[np.searchsorted(own, passage[lo:hi]), column] = values[lo:hi]
        yield own, used, dense


def _gram(shared):
    """Transposed passages times passages times the basis, by slices of terms."""
    def run(batches):
        idf, outside_weight, basis = shared.value
        total = np.zeros(basis.shape, np.float32)
        for batch in batches:
            # A row holds the passages of some texts of a bounded number of words.
            for terms, counts, sizes, outside in _unpacked(batch, PACKED):
                passage = np.repeat(np.arange(len(sizes)), sizes)
                heavy = idf[terms] > 0
                terms, counts, passage = terms[heavy], counts[heavy], passage[heavy]
                values, _ = _weighted(idf, outside_weight, terms, counts, passage, outside)
                for _, used, dense in _dense_parts(terms, passage, values):
                    total[used] += dense.T @ (dense @ basis[used])
        for number in range(0, -(-len(total) // TERMS_PER_SLICE)):
            part = total[number * TERMS_PER_SLICE:(number + 1) * TERMS_PER_SLICE]
            if part.any():
                yield pa.RecordBatch.from_pydict({"slice": pa.array([number], pa.int32()), "sums": [part.tobytes()]})
    return run


def _sum_slices(batches):
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, data in zip(batch.column("slice").to_pylist(), batch.column("sums").to_pylist()):
            totals[number] = totals.get(number, 0) + np.frombuffer(data, np.float32).astype(float)
    if totals:
        yield pa.RecordBatch.from_pydict({"slice": pa.array(list(totals), pa.int32()),
                                          "sums": [t.astype(np.float32).tobytes() for t in totals.values()]})


def _gram_product(passages: DataFrame, items: tuple, idf, outside_weight, basis: np.ndarray) -> np.ndarray:
    shared = passages.sparkSession.sparkContext.broadcast((idf, outside_weight, basis.astype(np.float32)))
    rows = passages.mapInArrow(_gram(shared), "slice int, sums binary")
    out = np.zeros(basis.shape)
    for _, used, dense in _dense_parts(*items):
        out[used] += dense.T @ (dense @ basis[used])
    for r in rows.repartition("slice").mapInArrow(_sum_slices, "slice int, sums binary").collect():
        part = np.frombuffer(r.sums, np.float32).reshape(-1, basis.shape[1])
        out[r.slice * TERMS_PER_SLICE:r.slice * TERMS_PER_SLICE + len(part)] += part
    return out


def _limits(lengths: np.ndarray, norms: np.ndarray, outside_weight: float) -> np.ndarray:
    """Candidate cosine of every item.

    Some passage holds all of a copied item, or ``PASSAGE - STRIDE`` words of a longer one; the rest
    of the passage is taken as words outside the vocabulary. A paraphrase may lack what
    ``ALIKE_WITH_ANSWER`` allows.
    """
    held = np.minimum(1, (PASSAGE - STRIDE) / np.maximum(lengths, 1))
    own = held * norms ** 2
    rest = np.maximum(0, PASSAGE - held * lengths) * outside_weight
    reached = np.sqrt(held * own / np.maximum(own + rest, 1e-12))
    return np.minimum(COSINE, ALIKE_WITH_ANSWER * reached)


def margin_of(length: int) -> int:
    """Words before and after a passage that are searched for an item as well."""
    return length // 2 + STRIDE


def needed_words(items: list[list[str]], vocabulary: dict[str, int], shares: np.ndarray) -> Words:
    """A rule for every item that no convictable text breaks.

    Of ``n`` words at least ``k``, by ``ALIKE_WITH_ANSWER``, are in a text that convicts the item.
    At most ``n - k`` are missing, so of any ``p`` words at least ``p - (n - k)`` are there; short items miss none. The rule
    takes the ``p`` rarest, with the ``p`` that makes the search cheapest; ``shares`` of the
    passages that hold a word only choose among rules that all lose nothing.
    """
    terms, owners, needed, reach = [], [], [], []
    for number, words in enumerate(items):
        n = len(words)
        missing = 0 if n < FEWEST_WORDS else n - next(k for k in range(n + 1) if k / n >= ALIKE_WITH_ANSWER)
        reach.append(2 + 2 * -(-margin_of(n) // STRIDE))
        coded = np.array([vocabulary[w] for w in words])
        coded = coded[np.lexsort((coded, shares[coded]))]
        found = np.maximum(np.cumsum(shares[coded])[missing:], 1e-9)
        wanted = np.arange(1, len(found) + 1)
        # Chance, as of rare events, that a text of this reach holds so many words of its own.
        mean = found * (reach[-1] + 1) / (PASSAGE // STRIDE)
        chance = np.where(wanted > mean, np.exp(wanted - mean - wanted * np.log(wanted / mean)), 1)
        best = int(np.argmin(found + CHECK_COST * chance))
        needed.append(best + 1)
        terms.append(coded[:missing + best + 1])
        owners.append(np.full(len(terms[-1]), number))
    terms, owners = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (terms, owners))
    first = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(vocabulary)))])
    return Words(first, owners[np.argsort(terms, kind="stable")], np.array(needed, np.int64), np.array(reach, np.int64))


def fit(docs: DataFrame, items: list[tuple], seed: int = 11) -> Model:
    """Weights and latent space for up to ``ITEMS_AT_ONCE`` items (id, text, and repeats if more than one).

    Frequencies and the SVD cover the passages of all documents, the SVD those of the items too.
    """
    listed = [(i, words_of(t), *n) for i, t, *n in items]
    listed = [x for x in listed if x[1]]
    repeats = [x[2] if len(x) > 2 else 1 for x in listed]
    listed = [x[:2] for x in listed]
    vocabulary = {w: n for n, w in enumerate(sorted({w for _, words in listed for w in words}))}
    passages = store(docs.select("text").mapInArrow(
        _passages(docs.sparkSession.sparkContext.broadcast(vocabulary)), ", ".join(f"{name} binary" for name in PACKED)), "passages")
    counts, total = np.zeros(len(vocabulary)), 0
    for r in passages.select("terms", "sizes").mapInArrow(_document_counts, "term int, n long").groupBy("term").agg(
            F.sum("n").alias("n")).collect():
        if r.term < 0:
            total = r.n
        else:
            counts[r.term] = r.n
    idf = np.log((1 + total) / (1 + counts)) + 1
    common = counts > max(COMMON_LEAST, COMMON_SHARE * total)
    for _, words in listed:
        common[sorted({vocabulary[w] for w in words}, key=lambda term: counts[term])[:RAREST]] = False
    idf[common] = 0
    outside = float(np.mean(idf[idf > 0] ** 2)) if (idf > 0).any() else 1.0

    # The items' vectors by entries: term, item, value.
    cells = [np.unique([vocabulary[w] for w in words], return_counts=True) for _, words in listed]
    of_item = np.repeat(np.arange(len(cells)), [len(c[0]) for c in cells])
    of_term = np.concatenate([np.zeros(0, np.int64), *(c[0] for c in cells)])
    values = (1 + np.log(np.concatenate([np.zeros(0), *(c[1] for c in cells)]))) * idf[of_term]
    norms = np.sqrt(np.bincount(of_item, values * values, minlength=len(listed)))
    values = values / np.maximum(norms, 1e-12)[of_item]
    limits = _limits(np.array([len(w) for _, w in listed]), norms, outside)

    # Together the items count as much as all passages, so that the space holds what they are made of.
    weight = np.sqrt(max(1.0, total / max(1, len(listed))))
    rank = min(len(vocabulary), RANK, -(-len(listed) // RANK_PART))
    latent = np.zeros((len(vocabulary), 0))
    if rank:
        # One pass: the product with a random draw gives the range, and with the draw again (Nyström)
        # the small matrix whose eigenvectors are the singular vectors inside it.
        width = min(len(vocabulary), rank + SPARE_RANK)
        draw, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(vocabulary), width)))
        product = _gram_product(passages, (of_term, of_item, values * weight), idf, outside, draw)
        basis, upper = np.linalg.qr(product)
        inner = upper @ np.linalg.pinv(draw.T @ product, rcond=1e-6) @ upper.T
        _, turn = np.linalg.eigh((inner + inner.T) / 2)
        latent = basis @ turn[:, ::-1][:, :rank]
    # Unit vectors again, so that what an item lost to the truncation does not lower its cosines.
    placed = np.zeros((len(listed), latent.shape[1]))
    for own, used, dense in _dense_parts(of_term, of_item, values):
        placed[own] = dense @ latent[used]
    placed /= np.maximum(np.linalg.norm(placed, axis=1, keepdims=True), 1e-12)
    return Model(vocabulary, idf, outside, latent.astype(np.float32), placed.astype(np.float32),
                 limits.astype(np.float32), [i for i, _ in listed], [w for _, w in listed],
                 [np.array([vocabulary[w] for w in words]) for _, words in listed], repeats,
                 needed_words([w for _, w in listed], vocabulary, counts / max(1, total)))


def _by_words(model: Model, numbers, terms, passage):
    """(text, passage starts, item) of all regions that may hold enough words of the item.

    Every second passage and the last of a text hold all its words. Words found in them are ordered
    by item and passage; so many in a row within reach are enough.
    """
    words, count = model.words, len(model.items)
    gap = int(words.reach.max(initial=0)) + 1
    first = np.cumsum(numbers) - numbers
    owner = np.repeat(np.arange(len(numbers)), numbers)
    local = np.arange(len(owner)) - first[owner]
    tile = (local % (PASSAGE // STRIDE) == 0) | (local == numbers[owner] - 1)
    held = words.first[terms + 1] - words.first[terms]
    seen = tile[passage] & (held > 0)
    terms, passage, held = terms[seen], passage[seen], held[seen]
    if not len(terms):
        return
    posting = np.arange(held.sum()) + np.repeat(words.first[terms] - (np.cumsum(held) - held), held)
    begins = first + np.arange(len(numbers)) * gap
    size = len(owner) + len(numbers) * gap
    keys = np.sort(words.items[posting] * size + np.repeat(passage + owner[passage] * gap, held))
    item = keys // size
    last = np.arange(len(keys)) + words.needed[item] - 1
    inside = last < len(keys)
    last, item, low = last[inside], item[inside], keys[inside]
    near = keys[last] - low <= words.reach[item]
    found = np.unique(np.stack([item[near], low[near] % size, keys[last][near] % size], 1), axis=0)
    of = np.searchsorted(begins, found[:, 1], side="right") - 1
    half = words.reach[found[:, 0]] // 2
    low = np.maximum(0, found[:, 2] - begins[of] - half)
    high = np.minimum(numbers[of] - 1, found[:, 1] - begins[of] + half)
    for text, lo, hi, number in zip(of.tolist(), low.tolist(), high.tolist(), found[:, 0].tolist()):
        yield text, range(lo, hi + 1), number


def _candidates(model: Model, codes: np.ndarray, lengths: np.ndarray) -> dict[tuple, float]:
    """Passages and items whose cosine reaches the item's limit, each with its cosine inside the latent
    space, where what the space does not hold is left out; zero in regions that may convict by their words alone."""
    # Words without weight that no item is looked up by change nothing here.
    wanted = (model.idf > 0) | (np.diff(model.words.first) > 0)
    numbers, terms, counts, passage, outside = code_passages(codes, lengths, len(model.vocabulary), wanted)
    values, known = _weighted(model.idf, model.outside, terms, counts, passage, outside)
    # A cosine cannot exceed the norm of the known part.
    possible = known >= model.limits.min(initial=COSINE)
    heavy = (values > 0) & possible[passage]
    found = {}
    first = np.cumsum(numbers) - numbers
    owner = np.repeat(np.arange(len(numbers)), numbers)
    for own, used, dense in _dense_parts(terms[heavy], passage[heavy], values[heavy]):
        turned = dense @ model.latent[used]
        inside = np.maximum(np.linalg.norm(turned, axis=1), 1e-12)
        for at in range(0, len(model.items), ITEMS_AT_A_TIME):
            cosines = turned @ model.placed[at:at + ITEMS_AT_A_TIME].T
            for p, item in zip(*(x.tolist() for x in np.nonzero(cosines >= model.limits[at:at + ITEMS_AT_A_TIME]))):
                text = int(owner[own[p]])
                found[text, int(own[p] - first[text]), at + item] = float(cosines[p, item] / inside[p])
    begins = np.cumsum(lengths) - lengths
    # The last stands for words outside.
    there = np.zeros(len(model.vocabulary) + 1, bool)
    for text, places, item in _by_words(model, numbers, terms, passage):
        words = model.coded[item]
        # What all regions together do not hold, none of them does.
        least = ALIKE_WITH_ANSWER * len(words) - 1e-9
        region = _region(words, codes[begins[text]:begins[text] + lengths[text]], places[0], places[-1])
        there[region] = True
        held = np.count_nonzero(there[words])
        there[region] = False
        if held >= least and common_subsequence(words.tolist(), region.tolist(), least) >= least:
            for place in places:
                found.setdefault((text, place, item), 0.0)
    return found


def _region(item: np.ndarray, text: np.ndarray, first: int, last: int) -> np.ndarray:
    """The words of passages ``first`` to ``last`` with the item's margin on both sides."""
    margin = margin_of(len(item))
    return text[max(0, first * STRIDE - margin):last * STRIDE + PASSAGE + margin]


def leaks(model: Model, texts: list[list[str]]) -> list[list[tuple]]:
    """Of every text its leaked items: (item id, share of the item in order, answer found, repeats)."""
    best: dict[tuple, tuple] = {}
    codes, lengths = code_texts(texts, model.vocabulary)
    begins = np.cumsum(lengths) - lengths
    for (text, place, item), cosine in _candidates(model, codes, lengths).items():
        words = model.coded[item].tolist()
        region = _region(words, codes[begins[text]:begins[text] + lengths[text]], place, place).tolist()
        if len(words) < FEWEST_WORDS:
            if any(region[at:at + len(words)] == words for at in range(len(region))):
                best[text, item] = 1.0, True
            continue
        wanted = ALIKE_WHEN_CLOSE if cosine >= CLOSE else ALIKE_WITH_ANSWER
        share = common_subsequence(words, region, wanted * len(words) - 1e-9) / len(words)
        if share < wanted:
            continue
        answer = answer_words(words)
        answered = common_subsequence(answer, region) >= ANSWER_ALIKE * len(answer)
        if share >= ALIKE or answered:
            best[text, item] = max(best.get((text, item), (0, False)), (share, answered))
    found: list[list[tuple]] = [[] for _ in texts]
    for (text, item), (share, answered) in sorted(best.items(), key=lambda x: (x[0][0], -x[1][0], str(model.item_ids[x[0][1]]))):
        found[text].append((model.item_ids[item], share, answered, model.repeats[item]))
    return found


LEAK = "array<struct<item_id:long,share:double,answered:boolean>>"
FOUND = "array<struct<item_id:long,share:double,answered:boolean,repeats:long>>"


def _search(shared):
    def run(batches):
        model = shared.value
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("share", pa.float64()), ("answered", pa.bool_()), ("repeats", pa.int64())]))
        for batch in batches:
            found = []
            column = batch.column("text") if "text" in batch.schema.names else batch.column("row").field("text")
            for texts in _cut_texts(column):
                found += leaks(model, texts)
            new = pa.array([[dict(zip(("item_id", "share", "answered", "repeats"), x)) for x in row] for row in found], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, new], names=[*batch.schema.names, "found"])
    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` (``columns``, by default doc_id) with ``leaks``: the benchmark items in it.

    ``benchmark`` has item_id and text; items without words or null are not searched, those with fewer
    than five words only word for word;
    repeated item ids are items of their own, repeated rows are found as often as they are there. Words are runs of letters and
    digits, lower-cased, and single signs in scripts without spaces.
    A null or empty document has no leaks. Up to ``ITEMS_AT_ONCE`` items are searched in one pass over all
    documents. A column of ``docs`` named leaks cannot be asked for.
    """
    columns = columns or ["doc_id"]
    return _searched(docs.select(F.struct(*columns).alias("row"), "text"), docs.select("text"), benchmark).select("row.*", "leaks")


def _searched(docs: DataFrame, texts: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` has row, and text next to or inside it; adds leaks. ``texts`` has its texts."""
    rows, turns = docs.withColumn("leaks", F.array().cast(LEAK)), 0
    # Equal rows are one item. The driver reads them a partition at a time and holds one turn's.
    distinct = benchmark.groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("repeats")).toLocalIterator()
    while items := [(r.item_id, r.text, r.repeats) for r in islice(distinct, ITEMS_AT_ONCE)]:
        model = docs.sparkSession.sparkContext.broadcast(fit(texts, items))
        schema = StructType([*rows.schema.fields, StructField("found", DataType.fromDDL(FOUND))])
        one = lambda x: F.struct(x["item_id"].alias("item_id"), x["share"].alias("share"), x["answered"].alias("answered"))
        each = F.flatten(F.transform("found", lambda x: F.array_repeat(one(x), x["repeats"].cast("int"))))
        rows = rows.mapInArrow(_search(model), schema).withColumn("leaks", F.concat("leaks", each)).drop("found")
        turns += 1
    return rows if turns < 2 else rows.withColumn("leaks", F.array_sort("leaks", _most_alike_first))


def _most_alike_first(a, b):
    name = lambda x: F.coalesce(x["item_id"].cast("string"), F.lit("None"))
    return (F.when(a["share"] > b["share"], -1).when(a["share"] < b["share"], 1)
            .when(name(a) < name(b), -1).when(name(a) > name(b), 1).otherwise(0))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found."""
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    return _searched(rows, docs.select("text"), benchmark).where(F.size("leaks") == 0).select("row.*")
