"""Bring sources to (prompt, response, source, update_timestamp) and put them together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STANDARD_COLUMNS = ("prompt", "response", "source", "update_timestamp")


def standardize(
    df: DataFrame, mapping: Mapping[str, Column | str], source: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Map a source onto the standard columns; ``source`` tags every row, ``keep`` passes columns through."""
    columns = {name: F.col(c) if isinstance(c, str) else c for name, c in mapping.items()}
    if source is not None:
        columns["source"] = F.lit(source)
    for name in ("source", "update_timestamp"):
        columns.setdefault(name, F.col(name))
    return df.select(*keep, *(columns[name].alias(name) for name in STANDARD_COLUMNS))


def consolidate(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all sources, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def turn_pairs(conversations: DataFrame) -> DataFrame:
    """(prompt, response) pairs: a user turn and the assistant turn that follows it.

    An equi-join on the unique (conversation, turn) key, so one endless conversation does not end up
    in one task as it would with a window.
    """
    asked = conversations.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("prompt")
    )
    answered = conversations.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    return asked.join(answered, ["conv_id", "turn"])
