"""Byte-level BPE with the ``tokenizers`` library over Arrow batches, and its inverse.

Texts are cut into units, white space followed by a word.  No match of the tokenizer's splitting pattern crosses the
end of a word into white space, so a text's ids are its units' ids in a row, and its bytes what its units' ids decode to.
Words repeat, so a worker encodes and decodes such a unit once and keeps both in a memo of bounded size.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import string
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from winnow.llm.batches import pieces

#: The code points that the splitting pattern takes as white space.
SPACE = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
UNITS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")

MEMO_BYTES = 40 << 20  # of each of the two halves of the memo, as counted; in the process it is about three times that
ENTRY_BYTES = 350  # counted for a unit, its ids and its bytes, beside their contents
#: A word of Latin letters with punctuation behind it; no match of the pattern crosses from one into the other.
MARKED = re.compile(rf"([{SPACE}]*[A-Za-zÀ-ÖØ-öø-ɏ]+)([!-/:-@\[-`{{-~]+)")
MARKS = frozenset(string.punctuation)
SIGHTS = 1 << 22  # marks of units that were seen once, a byte each
SLICE_CHARS = 1 << 20
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def byte_table() -> dict[str, int]:
    """The printable character that stands for each byte, as character to byte.

    Bytes that print in Latin-1 stand for themselves; the others follow from code point 256 on in order.
    """
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_tokenizer(definition: str):
    """A tokenizer that treats the strings of special tokens as ordinary text, without threads of its own.

    A task has one core; the library's thread pool would cost a third more time and memory that grows.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.encode_special_tokens = True
    return tokenizer


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def id_bytes(definition: str) -> list[bytes]:
    """The bytes of each id: the vocabulary's characters through the reversed byte table."""
    table = byte_table()
    vocabulary = json.loads(definition)["model"]["vocab"]
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, number in vocabulary.items():
        out[number] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
    return out


class Memo:
    """Units met at least twice, with (packed ids, decoded bytes).

    Two halves: when the younger one is full it becomes the older one, whose entries come back as they are met again.  A
    unit is let in at its second sight; half of all units never have one.
    """

    def __init__(self):
        self.young: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}
        self.size = self.marked = 0
        self.once = bytearray(SIGHTS)

    def get(self, unit: str) -> tuple[bytes, bytes] | None:
        found = self.young.get(unit)
        if found is None and (found := self.old.get(unit)) is not None:
            self.put(unit, found)
        return found

    def put(self, unit: str, made: tuple[bytes, bytes]) -> None:
        self.young[unit] = made
        self.size += ENTRY_BYTES + len(unit) + len(made[0]) + len(made[1])
        if self.size > MEMO_BYTES:
            self.young, self.old, self.size = {}, self.young, 0

    def offer(self, unit: str, made: tuple[bytes, bytes]) -> None:
        """Let in a unit that was offered before, or whose mark another unit has set."""
        at = hash(unit) % SIGHTS
        if self.once[at]:
            self.put(unit, made)
            return
        self.once[at] = 1
        self.marked += 1
        if self.marked > SIGHTS // 4:
            self.once, self.marked = bytearray(SIGHTS), 0


class Encoder:
    """Encodes texts unit by unit; ids are packed little-endian unsigned 32-bit integers."""

    def __init__(self, definition: str):
        self.tokenizer = load_tokenizer(definition)
        self.bytes_of = id_bytes(definition)
        self.memo = Memo()

    def decoded(self, packed: bytes) -> bytes:
        return b"".join([self.bytes_of[i] for i in np.frombuffer(packed, "<u4").tolist()])

    def coded(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """The packed ids of each text, and the bytes that they decode to."""
        cut = [UNITS.findall(t) for t in texts]
        known, new, marked = {}, set(), []
        for unit in set().union(*cut):
            parts = MARKED.fullmatch(unit) if unit[-1] in MARKS else None
            if parts is None:
                self._look_up(unit, known, new)
            else:  # a word is met far more often than a word with a certain mark behind it
                word, mark = parts.groups()
                marked.append((unit, word, mark))
                self._look_up(word, known, new)
                self._look_up(mark, known, new)
        todo = list(new)
        for unit, e in zip(todo, self.tokenizer.encode_batch_fast(todo, add_special_tokens=False)):
            ids = e.ids
            made = array("I", ids).tobytes(), b"".join([self.bytes_of[i] for i in ids])
            known[unit] = made
            self.memo.offer(unit, made)
        for unit, word, mark in marked:
            (a, b), (c, d) = known[word], known[mark]
            known[unit] = a + c, b + d
        found = [[known[u] for u in units] for units in cut]
        return [b"".join([m[0] for m in row]) for row in found], [b"".join([m[1] for m in row]) for row in found]

    def _look_up(self, unit: str, known: dict, new: set) -> None:
        if unit not in known:
            made = self.memo.get(unit)
            if made is None:
                new.add(unit)
            else:
                known[unit] = made

    def packed(self, texts: list[str]) -> list[bytes]:
        return self.coded(texts)[0]

    def offsets(self, text: str) -> np.ndarray:
        """Character offsets (start, end) of each id of a text; parts of one split character share its offsets."""
        out, base = [], 0
        for unit in UNITS.findall(text):
            out += [(base + a, base + b) for a, b in self.tokenizer.encode(unit, add_special_tokens=False).offsets]
            base += len(unit)
        return np.array(out, np.int64).reshape(-1, 2)


_encoders: dict[str, Encoder] = {}


def encoder_of(definition: str) -> Encoder:
    """The encoder of this process; workers are reused, and one tokenizer each is enough."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(definition)
    return _encoders[key]


def _slices(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of about ``SLICE_CHARS`` characters, one text at least."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SLICE_CHARS:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))


def _as_lists(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
    values = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _spans(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)])
    flat = np.concatenate(found) if found else np.empty((0, 2), np.int64)
    pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)


DECODED = [T.StructField("decoded", T.BinaryType()), T.StructField("ids_sha256", T.StringType())]
DIGESTS = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
    T.StructField("round_trip", T.BooleanType()),
]


def encode(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    offsets: bool = False,
    decoded: bool = False,
    ids: bool = True,
    digests: bool = False,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``ids`` (array of int) and, if asked, ``offsets`` (array of start, end), what
    ``decode`` makes of the ids (``decoded``, ``ids_sha256``), and ``digests``: ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and
    ``round_trip``, whether the ids decode to the text.  All come from one pass over the texts; with digests and without
    ids nothing but a few numbers leaves the worker.

    Whole texts are encoded, each match of the pattern by itself, without special tokens.  Null counts as empty and gives
    no ids.  Texts of any length are taken, a few at a time; repeated rows get the same answer each, and an empty table gives
    an empty result.  The tokenizer file is read on the driver and travels in the task, about 1.5 MB.  Map-only; columns
    named like a result are replaced.
    """
    definition = read_definition(tokenizer_path)
    more = [T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids
    more += [T.StructField("offsets", T.ArrayType(SPAN))] * offsets
    more += DECODED * decoded
    more += [f for f in DIGESTS if f not in more] * digests
    names = [f.name for f in more]
    docs = docs.drop(*names)
    schema = T.StructType([*docs.schema.fields, *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(definition)
        for batch in pieces(batches):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            for part in _slices(texts):
                rows = batch.slice(part.start, part.stop - part.start)
                packed, said = encoder.coded(texts[part])
                sha = lambda made: pa.array([hashlib.sha256(m).hexdigest() for m in made], pa.string())
                make = {
                    "ids": lambda: _as_lists(packed),
                    "offsets": lambda: _spans([encoder.offsets(t) for t in texts[part]]),
                    "decoded": lambda: pa.array(said, pa.binary()),
                    "n_tokens": lambda: pa.array([len(p) // 4 for p in packed], pa.int64()),
                    "ids_sha256": lambda: sha(packed),
                    "decoded_sha256": lambda: sha(said),
                    "round_trip": lambda: pa.array([t.encode() == m for t, m in zip(texts[part], said)], pa.bool_()),
                }
                yield pa.RecordBatch.from_arrays([*rows.columns, *(make[n]() for n in names)], schema.names)

    return docs.mapInArrow(run, schema)


def _decoded(encoder: Encoder, packed: list[bytes]) -> list[pa.Array]:
    digests = [hashlib.sha256(p).hexdigest() for p in packed]
    return [pa.array([encoder.decoded(p) for p in packed], pa.binary()), pa.array(digests, pa.string())]


def decode(docs: DataFrame, tokenizer_path: str, ids: str = "ids") -> DataFrame:
    """All rows and columns of ``docs`` with ``decoded`` (binary) and ``ids_sha256`` of the packed ids.

    The bytes of all ids are joined before anyone reads them as UTF-8, so a character split over several ids comes
    back whole; ids cut out of a longer row may begin or end within one, hence binary.  Null ids give no bytes; rows of any
    length are taken, repeated rows get the same answer each, and an empty table gives an empty result.  An id outside the
    vocabulary raises IndexError.
    """
    definition = read_definition(tokenizer_path)
    docs = docs.drop(*(f.name for f in DECODED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(definition)
        for batch in pieces(batches):
            packed = [np.array(row or [], "<u4").tobytes() for row in batch.column(ids).to_pylist()]
            columns = [*batch.columns, *_decoded(encoder, packed)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *(f.name for f in DECODED)])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *DECODED]))
