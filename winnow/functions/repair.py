"""Repair of text whose UTF-8 bytes were read as Latin-1 or Windows-1252, in native expressions.

A line was read wrongly if its characters, taken back to the bytes they were read from, are valid UTF-8 with characters
beyond ASCII in it.  A line in order does not pass: its accents are single bytes, which UTF-8 does not allow.  What
comes out may have been read wrongly before, so it is looked at again until nothing changes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _windows_1252() -> tuple[str, str]:
    """The characters that Windows-1252 has where Latin-1 has control characters, and the latter."""
    special, control = [], []
    for byte in range(0x80, 0xA0):
        try:
            special.append(bytes([byte]).decode("cp1252"))
        except UnicodeDecodeError:
            continue  # five bytes have no character and are read as the control character
        control.append(chr(byte))
    return "".join(special), "".join(control)


SPECIAL, CONTROL = _windows_1252()


def _once(line: Column) -> Column:
    """The line read rightly where it was read wrongly once; else as it is."""
    back = F.translate(line, SPECIAL, CONTROL)
    # only then can every character be a byte; the encoder would fail on others
    single = back.rlike(r"\A[\x00-\xFF]*[\xC2-\xF4][\x80-\xBF][\x00-\xFF]*\z")
    raw = F.when(single, F.encode(back, "ISO-8859-1")).cast("string")
    right = F.when(F.is_valid_utf8(raw), raw)
    return F.coalesce(right, line)


def repair_decoding(text: Column | str) -> Column:
    """The text with every line put right that was read as Latin-1 or Windows-1252, once or several times over.

    Lines are judged by themselves, so a damaged passage in a good text is found, and a damaged text with one good line
    too.  Every time a line is put right each of its characters beyond ASCII comes from two at least, so a line of n characters
    takes at most log2(n) rounds.  Null stays null; ASCII lines are passed over.
    """
    text = F.col(text) if isinstance(text, str) else text

    def whole(line: Column) -> Column:
        rounds = F.sequence(F.lit(1), F.floor(F.log2(F.length(line) + 1)).cast("int") + 1)
        return F.when(line.rlike(r"[\xC2-\xF4]"), F.aggregate(rounds, line, lambda t, _: _once(t))).otherwise(line)

    lines = F.transform(F.split(text, "\n", -1), whole)
    return F.when(text.rlike(r"[\xC2-\xF4]"), F.array_join(lines, "\n")).otherwise(text)


def misread(text: Column | str, charset: str = "windows-1252") -> Column:
    """The damage itself, for tests: UTF-8 bytes read as Latin-1 or Windows-1252."""
    if charset.lower() not in ("iso-8859-1", "windows-1252"):
        raise ValueError(f"not a charset of single bytes that is repaired: {charset}")
    wrong = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    return wrong if charset.lower() == "iso-8859-1" else F.translate(wrong, CONTROL, SPECIAL)
