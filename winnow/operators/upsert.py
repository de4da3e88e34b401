"""Insert-only upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def not_matched(source: DataFrame, target: DataFrame, on: str | Sequence[str] = "id") -> DataFrame:
    """Rows of ``source`` whose key is not in ``target`` yet; only the key columns of the target are read.

    The key is the id, or the band columns to turn away near-duplicates of earlier batches.  It must be
    unique in the source, as it is after the duplicates of a batch have been set aside.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return source.join(target.select(*keys), keys, "left_anti")


def upsert(source: DataFrame, target: DataFrame, on: str | Sequence[str] = "id") -> DataFrame:
    """The target after inserting the rows that were not matched."""
    return target.unionByName(not_matched(source, target, on))
