"""Rows of conversations in order, as one stream a partition."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.batches import pieces


def together(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """``c``, ``t``, ``r``, ``x``: id, turn, role and text, the rows of a conversation in one partition."""
    names = {"c": conversation, "t": turn, "r": role, "x": text}
    return rows.select(*(F.col(f"`{old}`").alias(new) for new, old in names.items())).repartition("c")


def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of a partition as tuples, a small piece of a batch at a time."""
    for batch in pieces(batches):
        yield from zip(*(c.to_pylist() for c in batch.columns))


def grouped(rows: Iterator[tuple]) -> Iterator[tuple[Any, Iterator[tuple]]]:
    """Each run of rows with the same first field; a null is a value of its own.  Read each run before the next."""
    from itertools import groupby

    return ((key, (row[1:] for row in group)) for key, group in groupby(rows, key=lambda row: row[0]))
