"""Token ids in binary files of patched frame-of-reference blocks.

File layout, little endian::

    magic    8 bytes
    blocks   each of 128 ids: minimum u32, width u8, exceptions u8, the ids less the minimum packed at
             that width, then of every exception its place u8 and of every exception its value u32
    tail     doc_ids i64 * docs, doc_nulls u8 * docs, lengths u64 * docs, block starts u64 * blocks
    end      docs u64, blocks u64, ids u64, tail start u64, magic 8 bytes

A block's width holds a percentile of its values; values that need more are exceptions. The last
block is filled up with its first id.
"""

from __future__ import annotations

import functools
import os
import re
import string
import uuid
import zlib
from array import array
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railtide.session import scratch_path, store

MAGIC = b"RTPFOR01"
BLOCK = 128
PERCENTILE = 90
BYTES_PER_FILE = 32_000_000
# Characters that the texts of one doc_id are told apart by when they are dealt to files.
RANGE_CHARACTERS = 128
# Ids packed at once, and words whose ids a Python worker remembers, twice: those of late and those before.
IDS_PER_PACK = 1 << 17
REMEMBERED = 400_000


def _bytes_of_eighth(width: int):
    """Eight values of a width fill as many bytes: (value, its first bit in its first byte, the bytes it lies in)."""
    for nth in range(8):
        bit = nth * width
        yield nth, bit % 8, range(bit // 8, (bit + width + 7) // 8)


def _pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of every value (u32), one after the other; a row per row of ``values``."""
    eights = (values & np.uint32((1 << width) - 1)).reshape(-1, 8)
    kind = np.uint32 if width <= 25 else np.uint64
    out = np.zeros((len(eights), width), np.uint8)
    for nth, first, places in _bytes_of_eighth(width):
        shifted = eights[:, nth].astype(kind) << kind(first)
        for n, place in enumerate(places):
            out[:, place] |= (shifted >> kind(8 * n)).astype(np.uint8)
    return out.reshape(len(values), -1)


def _unpack_bits(packed: np.ndarray, width: int) -> np.ndarray:
    """The values (u32) that ``_pack_bits`` made ``packed`` of."""
    eights = packed.reshape(-1, width)
    kind = np.uint32 if width <= 25 else np.uint64
    out = np.empty((len(eights), 8), np.uint32)
    for nth, first, places in _bytes_of_eighth(width):
        joined = eights[:, places[0]].astype(kind)
        for n, place in enumerate(places[1:], 1):
            joined |= eights[:, place].astype(kind) << kind(8 * n)
        out[:, nth] = (joined >> kind(first)) & kind((1 << width) - 1)
    return out.reshape(len(packed), -1)


def pack_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """Bytes of the blocks and the size of each; ``ids`` u32, a multiple of the block size."""
    values = ids.reshape(-1, BLOCK)
    least = values.min(axis=1)
    deltas = values - least[:, None]
    ranked = np.sort(deltas, axis=1)[:, -(-BLOCK * percentile // 100) - 1]
    widths = np.ceil(np.log2(ranked.astype(np.float64) + 1)).astype(np.int64)
    outlier = deltas > ((np.uint64(1) << widths.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    counts = np.count_nonzero(outlier, axis=1)
    sizes = 6 + widths * (BLOCK // 8) + counts * 5
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[starts[:, None] + np.arange(4)] = least.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[starts + 4], out[starts + 5] = widths, counts
    for width in np.unique(widths[widths > 0]):
        own = np.flatnonzero(widths == width)
        packed = _pack_bits(deltas[own], int(width))
        out[(starts[own] + 6)[:, None] + np.arange(packed.shape[1])] = packed
    block, place = np.nonzero(outlier)
    if len(block):
        lists = starts + 6 + widths * (BLOCK // 8)
        nth = np.arange(len(block)) - np.searchsorted(block, block)
        out[lists[block] + nth] = place
        wide = deltas[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
        out[(lists[block] + counts[block] + nth * 4)[:, None] + np.arange(4)] = wide
    return out.tobytes(), sizes


def unpack_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` in ``data`` (u8)."""
    head = data[starts[:, None] + np.arange(6)]
    least = np.ascontiguousarray(head[:, :4]).view("<u4").ravel()
    widths, counts = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
    deltas = np.zeros((len(starts), BLOCK), np.uint32)
    for width in np.unique(widths[widths > 0]):
        own = np.flatnonzero(widths == width)
        packed = data[(starts[own] + 6)[:, None] + np.arange(width * BLOCK // 8)]
        deltas[own] = _unpack_bits(packed, int(width))
    block = np.repeat(np.arange(len(starts)), counts)
    if len(block):
        lists = starts + 6 + widths * (BLOCK // 8)
        nth = np.arange(len(block)) - np.repeat(np.cumsum(counts) - counts, counts)
        place = data[lists[block] + nth]
        wide = np.ascontiguousarray(data[(lists[block] + counts[block] + nth * 4)[:, None] + np.arange(4)])
        deltas[block, place] = wide.view("<u4").ravel()
    return (deltas + least[:, None]).ravel()


def open_path(path: str):
    """File system and path of a URI or a plain absolute path."""
    return pafs.FileSystem.from_uri(path)


class TokenFile:
    """Writes one file; ids are packed as they come, so memory does not grow with the texts."""

    def __init__(self, path: str):
        system, place = open_path(path)
        system.create_dir(os.path.dirname(place), recursive=True)
        self.out = system.open_output_stream(place)
        self.out.write(MAGIC)
        self.doc_ids: list = []
        self.lengths: list[int] = []
        self.sizes: list[np.ndarray] = []
        self.waiting: list[np.ndarray] = []
        self.held = self.total = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= IDS_PER_PACK:
            self._pack(self.held // BLOCK * BLOCK)

    def _pack(self, count: int) -> None:
        ids = np.concatenate(self.waiting)
        for at in range(0, count, IDS_PER_PACK):
            data, sizes = pack_blocks(ids[at:min(at + IDS_PER_PACK, count)])
            self.out.write(data)
            self.sizes.append(sizes)
        self.total += count
        self.waiting, self.held = [ids[count:]], len(ids) - count

    def close(self) -> int:
        """Finish the file and return the number of ids in it."""
        rest = self.held
        if rest:
            self.waiting.append(np.repeat(self.waiting[0][:1] if len(self.waiting[0]) else self.waiting[-1][:1], -rest % BLOCK))
            self._pack(rest + -rest % BLOCK)
        total = sum(self.lengths)
        sizes = np.concatenate([np.zeros(0, np.int64), *self.sizes])
        starts = len(MAGIC) + np.cumsum(sizes) - sizes
        tail = len(MAGIC) + int(sizes.sum())
        self.out.write(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes())
        self.out.write(np.array([d is None for d in self.doc_ids], np.uint8).tobytes())
        self.out.write(np.array(self.lengths, "<u8").tobytes())
        self.out.write(starts.astype("<u8").tobytes())
        self.out.write(np.array([len(self.doc_ids), len(starts), total, tail], "<u8").tobytes() + MAGIC)
        self.out.close()
        return total


def read_token_file(path: str):
    """Yield (doc_id, ids) of every document of a file, unpacking only some blocks at a time."""
    system, place = open_path(path)
    with system.open_input_file(place) as file:
        size = file.size()
        end = file.read_at(40, size - 40)
        if end[32:] != MAGIC:
            raise ValueError(f"{path} is not a complete token file")
        docs, blocks, _, tail = (int(x) for x in np.frombuffer(end, "<u8", 4))
        index = file.read_at(size - 40 - tail, tail)
        doc_ids = np.frombuffer(index, "<i8", docs)
        nulls = np.frombuffer(index, np.uint8, docs, 8 * docs)
        lengths = np.frombuffer(index, "<u8", docs, 9 * docs).astype(np.int64)
        starts = np.append(np.frombuffer(index, "<u8", blocks, 17 * docs).astype(np.int64), tail)
        buffer, begin, step = np.zeros(0, np.uint32), 0, IDS_PER_PACK // BLOCK
        at = 0
        for doc_id, null, length in zip(doc_ids.tolist(), nulls, lengths.tolist()):
            parts, have = [buffer[begin:]], len(buffer) - begin
            while have < length:
                first, last = starts[at], starts[min(at + step, blocks)]
                data = np.frombuffer(file.read_at(int(last - first), int(first)), np.uint8)
                parts.append(unpack_blocks(data, starts[at:min(at + step, blocks)] - first))
                have += len(parts[-1])
                at += step
            if len(parts) > 1:
                buffer, begin = np.concatenate(parts), 0
            yield (None if null else doc_id), buffer[begin:begin + length]
            begin += length


def _byte_symbols() -> dict[int, str]:
    """Byte-level BPE writes printable bytes as themselves and the others as symbols from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(0x100 + n) for n, b in enumerate(hidden)}


# Letters up to here are letters in every version of Unicode.
_LAST_LATIN = "\u017f"
_SYMBOLS = _byte_symbols()
_LETTERS = {chr(c): chr(c).encode().decode("latin-1").translate(_SYMBOLS) for c in range(ord(_LAST_LATIN) + 1)}
_DOUBLE = ["  ", "\n\n", " \n", "\n "]
_id_of = attrgetter("id")


class _DoubleSpace(Exception):
    """A piece begins or ends with white space or has two in a row."""


class _Pieces(dict):
    """Ids of the pieces between spaces and line ends, worked out when first asked for.

    ``before`` is the space that belongs to every piece, or nothing. Pieces not asked for since the
    last but one call of ``age`` are forgotten.
    """

    def __init__(self, encoder: WordEncoder, before: str):
        super().__init__()
        self.encoder, self.before = encoder, before
        self.tokenize = encoder.tokenizer.model.tokenize
        self.lead = _LETTERS[before] if before else ""
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self._work_out(piece)
        self[piece] = ids
        return ids

    def age(self) -> None:
        self.older = dict(self)
        self.clear()

    def word(self, word: str) -> bytes:
        """Ids of a word of Latin letters and the space before it, which is one piece."""
        symbols = word if word.isascii() else "".join(map(_LETTERS.__getitem__, word))
        return array("I", map(_id_of, self.tokenize(self.lead + symbols))).tobytes()

    def _work_out(self, piece: str) -> bytes:
        if self.encoder.bytewise:
            base = piece.rstrip(self.encoder.punctuation)
            if base.isalpha() and (base.isascii() or max(base) <= _LAST_LATIN):
                return self.word(piece) if base == piece else self[base] + self.encoder.bare[piece[len(base):]]
        if self.encoder.double(piece):
            raise _DoubleSpace
        return self.encoder.plain([self.before + piece])[0]


class WordEncoder:
    """Ids of whole texts, remembering the ids of words.

    Byte-level BPE starts a new piece at a single space before a visible character, so what lies
    between spaces can be encoded on its own, with the space before it. A line end between visible
    characters is a piece, a run of Latin letters is one, and so is the punctuation after it. A text
    with two white space characters in a row is encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.double = re.compile(r"^\s|\s\s|\s\Z").search
        self.line_end = self.plain(["\n"])[0]
        self.spaced, self.bare = _Pieces(self, " "), _Pieces(self, "")
        probes = ["word", "É", "ñandú", "straße", "x"]
        self.bytewise = all(self.plain([p.before + w])[0] == p.word(w) for w in probes for p in (self.spaced, self.bare))
        # Signs that a word can be cut off before; those of tokens that are added as they are stay.
        added = "".join(t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not t.content.strip(string.punctuation))
        self.punctuation = "".join(c for c in string.punctuation if c not in added and self.bytewise
                                   and self.plain(["x" + c])[0] == self.bare.word("x") + self.plain([c])[0])

    def plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def encode(self, text: str) -> np.ndarray:
        if len(self.spaced) + len(self.bare) > REMEMBERED:
            self.spaced.age()
            self.bare.age()
        if not any(map(text.__contains__, _DOUBLE)):
            try:
                return np.frombuffer(self.line_end.join(map(self._line, text.split("\n"))), "<u4")
            except _DoubleSpace:
                pass
        return np.frombuffer(self.plain([text])[0], "<u4")

    def _line(self, line: str) -> bytes:
        first, *words = line.split(" ")
        return (self.bare[first] if first else b"") + b"".join(map(self.spaced.__getitem__, words))


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker."""
    return WordEncoder(path)


def _write_files(folder: str, tokenizer: str, end_id: int):
    def run(batches):
        encoder, file, docs, end = _encoder(tokenizer), None, 0, np.uint32(end_id)
        task = TaskContext.get()
        name = f"{folder}/tokens-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.rtk"
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                file = file or TokenFile(name)
                file.add(doc_id, np.append(encoder.encode(text.as_py() or ""), end))
                docs += 1
        if file:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([task.partitionId()], pa.int32()), "file": [name], "docs": pa.array([docs], pa.int64()),
                "ids": pa.array([file.close()], pa.int64())})
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2,
                      bytes_per_file: int = BYTES_PER_FILE) -> DataFrame:
    """Encode all texts and write them in ascending order of doc_id; the stored list of files.

    Nulls come first, a null text counts as empty, equal doc_ids are ordered by text. Returns part,
    file, docs, ids, start (ids in the files before). A task writes a file of its own name, and only
    files of finished tasks are listed, so a lost or repeated task leaves none that is read.
    """
    rows = docs.select("doc_id", "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-total // bytes_per_file))
    # Texts of one id are cut by how they begin, which keeps their order.
    ordered = rows.repartitionByRange(files, "doc_id", F.substring("text", 1, RANGE_CHARACTERS)).sortWithinPartitions("doc_id", "text")
    listed = store(ordered.mapInArrow(
        _write_files(folder, tokenizer, end_id), "part int, file string, docs long, ids long"), "token-files")
    # One row per file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return listed.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long"))


def _read_files(batches):
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
            rows: list = []
            for doc_id, ids in read_token_file(file):
                rows.append((doc_id, start, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())))
                start += len(ids)
                if len(rows) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the listed files."""
    parts = max(1, files.count())
    return files.select("part", "file", "start").repartitionByRange(parts, "part").mapInArrow(
        _read_files, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the token files and give back what they hold, one row per document.

    Ids ascend, nulls first, equal ones by text; a null text is empty and has the end alone; rows that repeat are
    rows of their own; an empty table writes no file; columns besides doc_id and text are not read.
    """
    return read_token_files(write_token_files(
        docs, folder or scratch_path(docs.sparkSession, "tokens"), tokenizer, end_id))
