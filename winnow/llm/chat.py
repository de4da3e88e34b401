"""Chat formatting with loss masks that are aligned by offsets.

A conversation is rendered as a whole: control strings mark its turns, and where a text holds a control string it is
escaped so that it can be read back.  The rendered text is encoded once, with the offsets of every token, and the spans of
the turns that count for the loss are intersected with the token spans by binary search.  Control strings are tokens of
their own, so no token lies across the border of a turn.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from winnow.llm.bpe import Encoder, read_definition
from winnow.llm.turns import grouped, stream, together

#: Control strings: (before, after) the text of a turn by role; any other role is written out between the last three.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("[SYS]", "[/SYS]")}
ROLE, SAYS, DONE = "[ROLE]", "[SAYS]", "[/ROLE]"
CONTROLS = (*(m for pair in MARKS.values() for m in pair), ROLE, SAYS, DONE)
MARK = re.compile(f"({'|'.join(map(re.escape, CONTROLS))})")
LEARNT = ("assistant",)  # roles that count for the loss

ESCAPED = re.compile(r"\\(.)", re.S)
BATCH_CHARS = 1 << 22
ENCODE_CHARS = 1 << 18  # turns are encoded in pieces of about this size; pieces end between turns


class Template:
    """Renders turns to one text and reads them back; ``more`` are further strings that texts must not hold bare."""

    def __init__(self, more: tuple[str, ...] = ()):
        self.controls = (*CONTROLS, *(m for m in more if m))
        self.bare = re.compile("|".join(sorted(map(re.escape, self.controls), key=len, reverse=True)))
        known = "|".join(f"{re.escape(a)}(?P<{role}>.*?){re.escape(b)}" for role, (a, b) in MARKS.items())
        self.turn = re.compile(f"(?:{known}|{re.escape(ROLE)}(?P<role>.*?){re.escape(SAYS)}(?P<said>.*?){re.escape(DONE)})", re.S)

    def escape(self, text: str) -> str:
        """Backslashes doubled, and one put after the first character of each control string."""
        if "\\" in text:
            text = text.replace("\\", "\\\\")
        while self.bare.search(text):  # a control string may begin inside another one
            text = self.bare.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)
        return text

    @staticmethod
    def unescape(text: str) -> str:
        return ESCAPED.sub(r"\1", text) if "\\" in text else text

    def around(self, role: str) -> tuple[str, str]:
        return MARKS.get(role) or (f"{ROLE}{self.escape(role)}{SAYS}", DONE)

    def read(self, rendered: str) -> list[tuple[str, str]]:
        """(role, text) of every turn; text outside of turns is an error."""
        found, at = [], 0
        for m in self.turn.finditer(rendered):
            if m.start() != at:
                break
            at = m.end()
            role, text = (m["role"], m["said"]) if m.lastgroup == "said" else (m.lastgroup, m[m.lastgroup])
            found.append((self.unescape(role), self.unescape(text)))
        if at != len(rendered):
            raise ValueError(f"no turn begins at character {at}")
        return found


class Formatter:
    """Rendering, encoding and reading back with one tokenizer; control strings get ids after its vocabulary."""

    def __init__(self, definition: str, learnt: tuple[str, ...] = LEARNT):
        self.definition, self.learnt = definition, learnt
        self.template = Template(tuple(t["content"] for t in json.loads(definition)["added_tokens"]))

    @cached_property
    def encoder(self) -> Encoder:
        return Encoder(self.definition)

    @cached_property
    def bytes_of(self) -> list[bytes]:
        """The bytes of every id; control strings have the ids after the vocabulary and its own special tokens."""
        plain = self.encoder.bytes_of
        added = [b""] * (self.first_control - len(plain))
        return [*plain, *added, *(c.encode() for c in CONTROLS)]

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.array(list(map(len, self.bytes_of)), np.int64)

    def render(self, turns: list[tuple[str, str]]) -> tuple[list[str], np.ndarray]:
        """A piece of text for each turn, and (start, end) of each turn's text in all of them joined."""
        out, spans, at = [], np.empty((len(turns), 2), np.int64), 0
        for i, (role, text) in enumerate(turns):
            before, after = self.template.around(role)
            text = self.template.escape(text)
            spans[i] = at + len(before), at + len(before) + len(text)
            out.append(f"{before}{text}{after}")
            at += len(out[-1])
        return out, spans

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and (start, end) of the tokens of all pieces joined; each character is encoded once.

        Control strings part the text, as texts of turns hold none, and what is between them is encoded by itself.  Where a
        token begins and ends follows from the bytes of the tokens; parts of a split character have the offsets of the whole.
        """
        ids, spans, base = [], [], 0
        for part in self._parts(pieces):
            between = MARK.split(part)  # texts and control strings in turn
            texts = iter(self.encoder.coded(between[::2])[0])
            packed = [
                np.array([self.first_control + CONTROLS.index(s)], "<u4") if i % 2 else np.frombuffer(next(texts), "<u4")
                for i, s in enumerate(between)
            ]
            found = np.concatenate(packed)
            ids.append(found.astype(np.int32))
            spans.append(self._offsets(part, found) + base)
            base += len(part)
        if not ids:
            return np.empty(0, np.int32), np.empty((0, 2), np.int64)
        return np.concatenate(ids), np.concatenate(spans)

    @cached_property
    def first_control(self) -> int:
        own = [t["id"] + 1 for t in json.loads(self.definition)["added_tokens"]]
        return max(len(self.encoder.bytes_of), *own, 0)

    @staticmethod
    def _parts(pieces: list[str]) -> Iterator[str]:
        """The pieces joined up to about ``ENCODE_CHARS``, so that a long conversation is encoded a part at a time."""
        held, size = [], 0
        for piece in pieces:
            held.append(piece)
            size += len(piece)
            if size >= ENCODE_CHARS:
                yield "".join(held)
                held, size = [], 0
        if held:
            yield "".join(held)

    def _offsets(self, text: str, ids: np.ndarray) -> np.ndarray:
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        if not text.isascii():
            begins = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
            upto = np.cumsum(begins)  # characters that begin in the bytes up to each one
            starts, ends = upto[starts] - 1, upto[ends - 1]
        return np.stack([starts, ends], axis=1)

    def format(self, turns: list[tuple[str, str]]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """The rendered text, the ids, their (start, end), and whether each counts for the loss."""
        pieces, spans = self.render(turns)
        ids, tokens = self.encode(pieces)
        wanted = spans[[role in self.learnt for role, _ in turns]] if turns else spans
        return "".join(pieces), ids, tokens, loss_mask(tokens, wanted)

    def loss_text(self, ids: np.ndarray, mask: np.ndarray) -> str:
        """The texts under the mask, from the ids, unescaped, nothing between."""
        taken = np.asarray(ids)[np.asarray(mask, bool)]
        return self.template.unescape(b"".join(map(self.bytes_of.__getitem__, taken.tolist())).decode())


def loss_mask(tokens: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which tokens overlap one of the spans; both are sorted (start, end), spans apart from each other.

    Tokens of one split character share its offsets, so starts and ends are each in order and two binary searches a span
    give the tokens in it.
    """
    mask = np.zeros(len(tokens) + 1, np.int32)
    some = spans[spans[:, 0] < spans[:, 1]]
    first = np.searchsorted(tokens[:, 1], some[:, 0], "right")
    last = np.searchsorted(tokens[:, 0], some[:, 1], "left")
    np.add.at(mask, first, 1)
    np.add.at(mask, last, -1)
    return np.cumsum(mask[:-1]) > 0


_formatters: dict[tuple, Formatter] = {}


def formatter_of(definition: str, learnt: tuple[str, ...]) -> Formatter:
    """The formatter of this process; workers are reused, and one tokenizer each is enough."""
    if (definition, learnt) not in _formatters:
        _formatters.clear()
        _formatters[definition, learnt] = Formatter(definition, learnt)
    return _formatters[definition, learnt]


FORMATTED = "formatted string, ids array<int>, offsets array<struct<start:long,end:long>>, loss array<boolean>"
READ = "n_turns long, turns array<struct<role:string,text:string>>, loss_text string"


def format_conversations(
    rows: DataFrame,
    tokenizer_path: str,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learnt: tuple[str, ...] = LEARNT,
) -> DataFrame:
    """One row per conversation: the id, ``formatted``, ``ids``, ``offsets`` of the ids in it, and the ``loss`` mask.

    Rows go by turn, nulls first, ties by role, then text; repeated rows are turns like others.  Null texts and roles count
    as empty, null ids are a conversation of their own.  Texts of any length and content can be read back.  Other columns are
    left out, whatever their names; an empty table gives an empty result.  A conversation is one record of the result and is
    made by one task; conversations spread over tasks by their id.
    """
    definition = read_definition(tokenizer_path)
    schema = T.StructType([T.StructField(conversation, rows.schema[conversation].dataType), *T.StructType.fromDDL(FORMATTED).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        formatter, arrow, out, size = formatter_of(definition, learnt), to_arrow_schema(schema), [], 0
        for key, group in grouped(stream(batches)):
            out.append((key, *formatter.format([(r or "", x or "") for _, r, x in group])))
            size += len(out[-1][1])
            if size >= BATCH_CHARS:
                yield _formatted(out, arrow)
                out, size = [], 0
        if out:
            yield _formatted(out, arrow)

    ordered = together(rows, conversation, turn, role, text).sortWithinPartitions("c", "t", "r", "x")
    return ordered.mapInArrow(run, schema)


def _formatted(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    keys, texts, ids, spans, masks = zip(*rows)
    ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
    flat = np.concatenate(spans)
    pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "end"])
    columns = [
        pa.array(keys, schema.field(0).type),
        pa.array(texts, pa.string()),
        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids))),
        pa.ListArray.from_arrays(ends, pairs),
        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(masks))),
    ]
    return pa.RecordBatch.from_arrays(columns, schema.names)


def read_back(formatted: DataFrame, tokenizer_path: str, conversation: str = "conv_id", learnt: tuple[str, ...] = LEARNT) -> DataFrame:
    """The id with ``formatted`` and what it says: ``turns`` from the rendered text alone, ``loss_text`` from ids and mask alone.

    A rendered text that is not a row of turns raises ValueError.  Null columns count as empty.
    """
    definition = read_definition(tokenizer_path)
    columns = [conversation, "formatted", "ids", "loss"]
    text = T.StructField("formatted", T.StringType())
    schema = T.StructType([T.StructField(conversation, formatted.schema[conversation].dataType), text, *T.StructType.fromDDL(READ).fields])
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter = formatter_of(definition, learnt)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = batch.slice(at, 64)
                turns = [formatter.template.read(t or "") for t in rows.column(1).to_pylist()]
                masks = zip(rows.column(2).to_pylist(), rows.column(3).to_pylist())
                said = [formatter.loss_text(np.array(i or [], np.int32), np.array(m or [], bool)) for i, m in masks]
                named = [[{"role": r, "text": x} for r, x in t] for t in turns]
                counts = pa.array(list(map(len, turns)), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), counts, pa.array(named, pa.list_(turn)), pa.array(said, pa.string())], schema.names
                )

    return formatted.select(*columns).mapInArrow(run, schema)
