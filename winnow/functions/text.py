"""Text operators as Column expressions."""

from __future__ import annotations

import string
import unicodedata
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Generated text ends at this marker, and a serving reply keeps its text at this path.
STOP_TOKEN = "<|endoftext|>"
REPLY_TEXT_PATH = "$.predictions[0].candidates[0].text"
REPLY_SCHEMA = "predictions array<struct<candidates: array<struct<text: string>>>>"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def strip_punctuation(text: Column | str) -> Column:
    """Delete the 32 ASCII punctuation characters."""
    return F.translate(_col(text), string.punctuation, "")


def collapse_whitespace(text: Column | str) -> Column:
    """Every run of Unicode whitespace becomes one blank; none is left at the ends."""
    return F.trim(F.regexp_replace(_col(text), r"(?U)[\s\x1c-\x1f]+", " "))


def normalize(text: Column | str) -> Column:
    """Lower case, no punctuation, single blanks; null stays null."""
    return collapse_whitespace(strip_punctuation(F.lower(_col(text))))


def remove_bad_characters(text: Column | str) -> Column:
    """Drop control and format characters other than newline and tab."""
    return F.regexp_replace(_col(text), r"[\p{Cc}\p{Cf}&&[^\n\t]]", "")


@F.arrow_udf(StringType())
def _nfc(texts: pa.Array) -> pa.Array:
    return pa.array(
        [None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string()
    )


def nfc(text: Column | str) -> Column:
    """Unicode composition (NFC); Spark has no expression for it.

    ASCII texts are composed already: they stay in the JVM and Python gets nulls for them.  Arrow's own normaliser is no
    substitute, it differs on some 12,000 code points.
    """
    text = _col(text)
    return F.when(F.length(text) == F.octet_length(text), text).otherwise(
        _nfc(F.when(F.length(text) != F.octet_length(text), text))
    )


def longer_than(text: Column | str, threshold: int) -> Column:
    return F.length(_col(text)) > threshold


def cut_at_stop(text: Column | str, stop: str = STOP_TOKEN) -> Column:
    """The text before the first stop marker."""
    return F.substring_index(_col(text), stop, 1)


def reply_text(reply: Column | str) -> Column:
    """The answer inside a serving reply; null where the JSON is malformed or has no candidate."""
    return F.get_json_object(_col(reply), REPLY_TEXT_PATH)


def reply_texts(reply: Column | str) -> Column:
    """The texts of all candidates inside a serving reply, in order; null where the JSON is malformed or has none."""
    parsed = F.from_json(_col(reply), REPLY_SCHEMA)
    return F.transform(F.get(parsed["predictions"], 0)["candidates"], lambda c: c["text"])


def replace_patterns(
    text: Column | str, patterns: Mapping[str, str], needs: Mapping[str, str] | None = None
) -> Column:
    """Replace every match of each pattern by its label, in the order of ``patterns``.

    ``needs`` names, by label, a character without which a pattern cannot match; texts that lack it are
    passed over without running the expression.
    """
    out = _col(text)
    for label, pattern in patterns.items():
        plain = label.replace("\\", "\\\\").replace("$", "\\$")
        replaced = F.regexp_replace(out, pattern, plain)
        needed = (needs or {}).get(label)
        out = replaced if needed is None else F.when(out.contains(needed), replaced).otherwise(out)
    return out
